"""Quality classifier: a convolutional network over bytes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffinmart.llm.frames import byte_view, hash_unit, in_blocks, pick

WIDTH, STRIDE, EMBED, FILTERS = 8, 2, 8, 16
CHUNK = 512  # bytes from one chunk to the next; filters reach into the next one
SPAN = CHUNK + WIDTH - STRIDE
PAD = 256


def chunk_matrix(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of each text as rows of bytes, `PAD` past its end, and the text of each. Every text has at least one, and
    each window of `WIDTH` bytes at an even place lies in a chunk."""
    lengths = np.diff(offsets)
    n = np.maximum(1, -(-lengths // CHUNK))
    owner = np.repeat(np.arange(len(n)), n)
    start = offsets[owner] + CHUNK * (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n))
    at = start[:, None] + np.arange(SPAN)
    padded = np.concatenate([data, [PAD]]).astype(np.int16)
    return np.where(at < offsets[owner + 1][:, None], padded[np.minimum(at, len(data))], PAD).astype(np.int16), owner


class ByteNet:
    """Byte embedding, filters over windows, maximum per chunk; maximum and mean over chunks; logistic output."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "embed": r.normal(0, 0.5, (PAD + 1, EMBED)).astype(np.float32),
            "filters": r.normal(0, 0.15, (WIDTH * EMBED, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": np.zeros(2 * FILTERS, np.float32),
            "base": np.zeros(1, np.float32),
        }
        self.p["embed"][PAD] = 0

    def windows(self, chunks: np.ndarray) -> np.ndarray:
        x = self.p["embed"][chunks].reshape(len(chunks), SPAN * EMBED)
        return np.lib.stride_tricks.sliding_window_view(x, WIDTH * EMBED, axis=1)[:, :: STRIDE * EMBED]

    def pooled(self, chunks: np.ndarray, where: bool = False):
        x = np.ascontiguousarray(self.windows(chunks))
        response = (x.reshape(-1, WIDTH * EMBED) @ self.p["filters"]).reshape(len(chunks), -1, FILTERS)
        best = response.max(axis=1)
        h = np.maximum(best + self.p["bias"], 0)
        return (h, response.argmax(axis=1), x) if where else h

    @staticmethod
    def combined(h: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = np.searchsorted(owner, np.arange(n))
        top = np.maximum.reduceat(h, first)
        count = np.bincount(owner, minlength=n)[:, None].astype(np.float32)
        return np.concatenate([top, np.add.reduceat(h, first) / count], axis=1), top, count

    def logits(self, features: np.ndarray) -> np.ndarray:
        return features @ self.p["out"] + self.p["base"][0]

    def gradients(self, chunks: np.ndarray, owner: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        h, at, x = self.pooled(chunks, where=True)
        f, top, count = self.combined(h, owner, len(y))
        error = (1 / (1 + np.exp(-self.logits(f))) - y).astype(np.float32) / len(y)
        df = error[:, None] * self.p["out"]
        dh = df[owner, FILTERS:] / count[owner] + df[owner, :FILTERS] * (h == top[owner])
        dh *= h > 0
        # Only the window at each maximum has a gradient.
        won = x[np.arange(len(chunks))[:, None], at]  # chunk, filter, window
        d_filters = np.einsum("cf,cfw->wf", dh, won)
        d_x = (dh[:, :, None] * self.p["filters"].T[None]).reshape(-1, EMBED)
        place = at[:, :, None] * STRIDE + np.arange(WIDTH)
        byte = chunks[np.arange(len(chunks))[:, None, None], place].reshape(-1)
        d_embed = np.zeros_like(self.p["embed"])
        for k in range(EMBED):
            d_embed[:, k] = np.bincount(byte, d_x[:, k], PAD + 1)
        d_embed[PAD] = 0
        return {"embed": d_embed, "filters": d_filters, "bias": dh.sum(0), "out": f.T @ error, "base": error.sum(keepdims=True)}

    def fit(self, texts: list[tuple[np.ndarray, int]], epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 7) -> ByteNet:
        """`texts`: chunks and label of each text. Adam over shuffled batches."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, steps = 0, epochs * -(-len(texts) // batch)
        for _ in range(epochs):
            order = r.permutation(len(texts))
            for i in range(0, len(order), batch):
                part = [texts[k] for k in order[i : i + batch]]
                owner = np.repeat(np.arange(len(part)), [len(c) for c, _ in part])
                g = self.gradients(np.concatenate([c for c, _ in part]), owner, np.array([y for _, y in part], np.float32))
                step += 1
                now = rate * (1 - step / (steps + 1))
                for k, v in g.items():
                    m[k] = 0.9 * m[k] + 0.1 * v
                    s[k] = 0.999 * s[k] + 0.001 * v * v
                    self.p[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def scores(self, texts: pa.Array, most_chunks: int = 256) -> np.ndarray:
        chunks, owner = chunk_matrix(*byte_view(texts))
        h = np.concatenate([self.pooled(chunks[i : i + most_chunks]) for i in range(0, len(chunks), most_chunks)] or [np.zeros((0, FILTERS), np.float32)])
        if not len(texts):
            return np.zeros(0)
        z = self.logits(self.combined(h, owner, len(texts))[0]).astype(np.float64)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fold_of(doc_id, folds: int):
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def training_chunks(docs: DataFrame, labels: DataFrame, per_class: int, most_bytes: int) -> list[tuple[np.ndarray, int]]:
    """All chunks and the label of at most `per_class` documents of each class, those with the least hash of their id
    among the labelled ones of up to `most_bytes` bytes. At most 4 * per_class * most_bytes bytes reach the driver."""
    # The labels are few against the texts; Spark broadcasts them by their size or shuffles.
    short = docs.filter(F.octet_length(F.coalesce("text", F.lit(""))) <= most_bytes).select("doc_id")
    known = labels.join(short, "doc_id", "left_semi")
    picked = [known.filter(F.col("quality") == y).orderBy(hash_unit(F.lit("fit"), F.col("doc_id")), "doc_id").limit(per_class) for y in (0, 1)]
    few = picked[0].unionAll(picked[1]).select(F.col("doc_id").alias("labelled_id"), "quality")
    # At most 2 * per_class short rows.
    joined = docs.join(F.broadcast(few), docs["doc_id"] == F.col("labelled_id")).select("doc_id", "text", "quality")
    joined = joined.filter(F.octet_length(F.coalesce("text", F.lit(""))) <= most_bytes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches):
            chunks, owner = chunk_matrix(*byte_view(batch.column("text")))
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            data = [chunks[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.string()), pa.array(data, pa.binary()), batch.column("quality").cast(pa.int32())], names=["id", "chunks", "y"])

    rows = joined.mapInArrow(cut, "id string, chunks binary, y int").collect()
    return [(np.frombuffer(r["chunks"], np.int16).reshape(-1, SPAN), r["y"]) for r in sorted(rows, key=lambda r: (r["id"], bytes(r["chunks"])))]


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: int = 1000, most_bytes: int = 1 << 16) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs`, from the bytes of its whole text alone.

    Learns from labelled documents outside the held-out fold (crc32 of the id as text, mod 3, is 1): at most
    `per_class` of each class, of up to `most_bytes` bytes, with all their chunks, so that a score of 0.5 treats both alike. A chunk is 512
    bytes and what filters need of the next; a document's features are maximum and mean over all its chunks. A null
    or empty text is one empty chunk and gets the score that the network gives it; without labels of both classes
    every score is 0.5. A null id is in no fold and counts as not held out; repeated rows each get a row; null labels
    are not used; other columns are not read.
    """
    picked = pick(docs, "doc_id", "text")
    allowed = pick(labels, "doc_id", "quality").filter((fold_of(F.col("doc_id"), 3) != 1) & F.col("quality").isin(0, 1))
    net = ByteNet()
    texts = training_chunks(picked, allowed, per_class, most_bytes)
    if {y for _, y in texts} == {0, 1}:
        net.fit(texts)
    weights = net.p

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ByteNet()
        own.p = weights
        for batch in in_blocks(batches):
            s = own.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    kind = picked.schema["doc_id"].dataType.simpleString()
    folded = picked.withColumn("held_out", F.coalesce(fold_of(F.col("doc_id"), 3) == 1, F.lit(False)))
    return folded.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")
