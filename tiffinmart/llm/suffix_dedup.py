"""Removal of repeated byte strings: shared places by sampled anchors, exact repeats by suffix arrays around them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffinmart.llm.frames import byte_view, in_blocks, pick
from tiffinmart.llm.storage import settled
from tiffinmart.llm.suffix_array import DEPTH, Packed, common_prefixes, two_stage
from tiffinmart.llm.tokens import _BASE, _INVERSE, byte_values, mixed, powers

#: Bytes of an anchor.
GRAM = 32
#: Key of a null id: behind all others.
LAST = (1 << 63) - 1
_POSITION = np.uint64(0xFFFFFFFF)


class Prints:
    """Karp-Rabin hashes of any span of a block of bytes."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(byte_values(data) * powers(_BASE, len(data))[:-1], out=self.sums[1:])
        self.back = powers(_INVERSE, len(data))

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` neighbours, from running minima of blocks in both directions."""
    n = len(x) - width + 1
    padded = np.concatenate([x, np.full(-len(x) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    forth = np.minimum.accumulate(padded, axis=1).reshape(-1)
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], forth[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, hash of the context, text, place, and first and last window start of each run of windows.

    The anchor of a window of `length` bytes is its run of `GRAM` bytes with the least hash, the first of equal ones:
    equal windows have equal anchors at the same place within them. The context is all that the windows cover.
    """
    none = tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    if len(data) < length:
        return none
    prints = Prints(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = prints.of(at, at + GRAM)
    least = sliding_least((grams & ~_POSITION) | at.astype(np.uint64), length - GRAM + 1)
    place = (least & _POSITION).astype(np.int64)
    start = np.arange(len(place))
    row = np.searchsorted(offsets, start, "right") - 1
    inside = start + length <= offsets[row + 1]
    change = np.concatenate([[True], (place[1:] != place[:-1]) | (inside[1:] != inside[:-1]) | (row[1:] != row[:-1])])
    first = np.flatnonzero(change)
    last = np.concatenate([first[1:], [len(place)]]) - 1
    good = inside[first]
    first, last = first[good], last[good]
    p, row = place[first], row[first]
    context = prints.of(first, last + length) + mixed(((p - first) * 1024 + last - first + 1).astype(np.uint64))
    begin = offsets[row]
    return mixed(grams[p] + np.uint64(0x5851F42D4C957F2D)), mixed(context), row, p - begin, first - begin, last - begin


def runs(start: np.ndarray, end: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of spans within each group, as start, end and group."""
    order = np.lexsort((start, group))
    start, end, group = start[order], end[order], group[order]
    if not len(start):
        return start, end, group
    fresh = np.concatenate([[True], group[1:] != group[:-1]])
    number = np.cumsum(fresh) - 1
    # The furthest end so far within each group; groups are lifted above each other to share one running maximum.
    lift = number * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    new = fresh | np.concatenate([[True], start[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return start[at], reach[np.concatenate([at[1:], [len(start)]]) - 1], group[at]


def keyed(docs: DataFrame, few: int = 100_000) -> DataFrame:
    """doc (id, or `LAST`), th, doc_id, text. th is the hash of the text where several texts have one id, and 0 where
    the id says it all; of ids with several texts, up to `few` are broadcast."""
    text = F.coalesce("text", F.lit(""))
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), "doc_id", text.alias("text"))
    texts = d.groupBy("doc").agg(F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b"))
    several = settled(texts.filter("a <> b").select(F.col("doc").alias("several")), "several")
    n = several.count()
    if not n:
        return d.select("doc", F.lit(0).cast("long").alias("th"), "doc_id", "text")
    d = d.join(F.broadcast(several) if n <= few else several, F.col("doc") == F.col("several"), "left")
    return d.select("doc", F.when(F.col("several").isNotNull(), F.xxhash64("text")).otherwise(0).alias("th"), "doc_id", "text")


def anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """h, ctx, doc, th, meta of the first occurrence of each context within a block of documents. Spans of later ones in
    the block are repeats already: they come with a null `ctx`, and h holds their start and end."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches):
            doc, th = (batch.column(c).to_numpy() for c in ("doc", "th"))
            order = np.lexsort((th, doc))
            fresh = np.concatenate([[True], (np.diff(doc[order]) != 0) | (np.diff(th[order]) != 0)])
            rank = np.empty(len(doc), np.int64)
            rank[order] = np.cumsum(fresh) - 1
            batch = batch.take(pa.array(order[fresh]))  # by rank, repeated rows once
            doc, th = (batch.column(c).to_numpy() for c in ("doc", "th"))
            h, ctx, row, p, lo, hi = anchors(*byte_view(batch.column("text")), length)
            order = np.lexsort((p, row, ctx, h))
            same = np.concatenate([[False], (np.diff(h[order]) == 0) & (np.diff(ctx[order]) == 0)])[: len(order)]
            one, more = order[~same], order[same]
            meta = (p[one] << 14) | ((p[one] - lo[one]) << 7) | (hi[one] - lo[one])
            start, end, owner = runs(lo[more], hi[more] + length, row[more])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([h[one].view(np.int64), (start << 31) | end])),
                    pa.array(np.concatenate([ctx[one].view(np.int64), start]), mask=np.concatenate([np.zeros(len(one), bool), np.ones(len(start), bool)])),
                    pa.array(np.concatenate([doc[row[one]], doc[owner]])),
                    pa.array(np.concatenate([th[row[one]], th[owner]])),
                    pa.array(np.concatenate([meta, np.zeros(len(owner), np.int64)])),
                ],
                names=["h", "ctx", "doc", "th", "meta"],
            )

    return docs.select("doc", "th", "text").mapInArrow(scan, "h long, ctx long, doc long, th long, meta long")


def shared_places(rows: DataFrame, length: int) -> DataFrame:
    """h, doc, th, p, start, stop (last window start), n and piece: contexts to compare (`piece`: the first occurrences
    of `n` different contexts around one anchor) and later occurrences of a context, which are repeats as a whole."""
    by_anchor = Window.partitionBy("h")
    dealt = rows.repartition("h").withColumn("rank", F.rank().over(Window.partitionBy("h", "ctx").orderBy("doc", "th", "meta")))
    n = F.sum((F.col("ctx").isNotNull() & (F.col("rank") == 1)).cast("int")).over(by_anchor)
    done = F.col("ctx").isNull()
    p = F.shiftright("meta", 14)
    lo = p - F.shiftright("meta", 7).bitwiseAND(F.lit(127))
    hi = lo + F.col("meta").bitwiseAND(F.lit(127))
    kept = dealt.withColumn("n", n).filter(done | (F.col("rank") > 1) | (F.col("n") > 1))
    return kept.select(
        "h",
        "doc",
        "th",
        p.alias("p"),
        F.when(done, F.shiftright("h", 31)).otherwise(lo).alias("start"),
        F.when(done, F.col("h").bitwiseAND(F.lit((1 << 31) - 1)) - length).otherwise(hi).alias("stop"),
        "n",
        (~done & (F.col("rank") == 1)).alias("piece"),
    )


def cut_pieces(docs: DataFrame, pieces: DataFrame, length: int) -> DataFrame:
    """h, n, doc, th, start, shift (of the anchor) and the bytes of each piece."""
    wanted = pieces.groupBy("doc", "th").agg(F.collect_list(F.struct("h", "n", "p", "start", "stop")).alias("cuts"))
    joined = docs.select("doc", "th", "text").join(wanted, ["doc", "th"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches):
            data, offsets = byte_view(batch.column("text"))
            cuts = batch.column("cuts")
            rows = np.repeat(np.arange(batch.num_rows), cuts.value_lengths().to_numpy())
            h, n, p, start, stop = (cuts.flatten().field(k).to_numpy() for k in range(5))
            begin = offsets[rows] + start
            raw = data.tobytes()
            bytes_ = [raw[a:b] for a, b in zip(begin.tolist(), (begin + stop - start + length).tolist(), strict=True)]
            doc, th = (batch.column(c).to_numpy()[rows] for c in ("doc", "th"))
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, (h, n, doc, th, start, p - start)), pa.array(bytes_, pa.binary())],
                names=["h", "n", "doc", "th", "start", "shift", "bytes"],
            )

    return joined.mapInArrow(cut, "h long, n long, doc long, th long, start long, shift long, bytes binary")


def may_repeat(h: np.ndarray, data: np.ndarray, offsets: np.ndarray, shift: np.ndarray, length: int) -> np.ndarray:
    """Whether a piece can share a window with another of its anchor: half of what a window has besides the anchor
    must agree on one side."""
    half = (length - GRAM) // 2
    prints = Prints(data)
    at = offsets[:-1] + shift
    out = np.zeros(len(h), bool)
    for start, end in ((at - half, at), (at + GRAM, at + GRAM + half)):
        whole = (start >= offsets[:-1]) & (end <= offsets[1:])
        side = np.flatnonzero(whole)
        key = mixed(prints.of(start[side], end[side]) ^ h[side].view(np.uint64))
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        out[side[count[which] > 1]] = True
    return out


def repeated_windows(doc, th, start, data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (piece, start, end) of windows that occur in an earlier piece, or earlier in the same one's document."""
    lengths = np.diff(offsets)
    s = np.zeros(len(data) + len(lengths), np.uint16)
    piece = np.repeat(np.arange(len(lengths)), lengths + 1)
    s[np.arange(len(data)) + np.repeat(np.arange(len(lengths)), lengths)] = data.astype(np.uint16) + 1
    packed = Packed(s)
    sa = two_stage(s, packed)
    sa = sa[packed.left[sa] >= length]
    if not len(sa):
        return (np.zeros(0, np.int64),) * 3
    fresh = common_prefixes(sa, packed, length) < length
    group = np.flatnonzero(fresh)
    base = offsets[:-1] + np.arange(len(lengths))
    owner = piece[sa]
    where = start[owner] + sa - base[owner]
    order = np.lexsort((th, doc))
    rank = np.empty(len(doc), np.int64)
    rank[order] = np.cumsum(np.concatenate([[False], (np.diff(doc[order]) != 0) | (np.diff(th[order]) != 0)]))
    key = (rank[owner] << 31) | where
    later = key != np.minimum.reduceat(key, group)[np.cumsum(fresh) - 1]
    begin, end, owner = runs(where[later], where[later] + length, owner[later])
    return owner, begin, end


def compared(pieces: DataFrame, length: int, block: int = 1 << 20) -> DataFrame:
    """doc, th, start, end of repeats among the pieces of each anchor. A task holds about `block` bytes at a time."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, block):
            at = [batch.column(c).to_numpy() for c in ("h", "doc", "th", "start")]
            order = np.lexsort(at)
            fresh = np.any([np.diff(x[order], prepend=x[order[0]] - 1) != 0 for x in at], axis=0)
            batch = batch.take(pa.array(order[fresh]))  # pieces of repeated rows once
            h, doc, th, start, shift = (batch.column(c).to_numpy() for c in ("h", "doc", "th", "start", "shift"))
            data, offsets = byte_view(batch.column("bytes"))
            good = np.flatnonzero(may_repeat(h, data, offsets, shift, length))
            if not len(good):
                continue
            data, offsets = byte_view(batch.column("bytes").take(pa.array(good)))
            owner, begin, end = repeated_windows(doc[good], th[good], start[good], data, offsets, length)
            yield pa.RecordBatch.from_arrays([*map(pa.array, (doc[good][owner], th[good][owner], begin, end))], names=["doc", "th", "start", "end"])

    dealt = pieces.repartition("h").sortWithinPartitions("h")
    return dealt.mapInArrow(compare, "doc long, th long, start long, end long")


def whole_groups(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by `h`, in batches of about `block` bytes that end where a group ends."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        while batch.num_rows:
            ends = np.flatnonzero(np.diff(batch.column("h").to_numpy())) + 1
            lengths = np.cumsum(np.diff(byte_view(batch.column("bytes"))[1]))
            if held and held[-1].column("h")[-1] != batch.column("h")[0]:
                ends = np.concatenate([[0], ends])
            enough = ends[size + np.concatenate([[0], lengths])[ends] >= block]
            if not len(enough):
                held.append(batch)
                size += int(lengths[-1])
                break
            if at := int(enough[0]):
                held.append(batch.slice(0, at))
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size, batch = [], 0, batch.slice(at)
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def crowded(pieces: DataFrame, length: int) -> DataFrame:
    """As `compared`, for anchors with too many contexts for one task: window by window, by their MD5."""
    each = pieces.withColumn("k", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)))
    windows = each.select("doc", "th", (F.col("start") + F.col("k")).alias("start"), F.md5(F.substring("bytes", F.col("k") + 1, F.lit(length))).alias("w"))
    first = windows.groupBy("w").agg(F.min(F.struct("doc", "th", "start")).alias("first"))
    later = windows.join(first, "w").filter(F.struct("doc", "th", "start") != F.col("first"))
    return later.select("doc", "th", "start", (F.col("start") + length).alias("end"))


def repeated_spans(docs: DataFrame, length: int, most_contexts: int) -> DataFrame:
    """doc, th, start, end of `keyed` documents: together exactly the bytes to remove."""
    places = settled(shared_places(anchor_rows(docs, length), length), "places")
    pieces = settled(cut_pieces(docs, places.filter("piece"), length), "pieces")
    whole = places.filter("not piece").select("doc", "th", "start", (F.col("stop") + length).alias("end"))
    few = compared(pieces.filter(F.col("n") <= most_contexts), length)
    return whole.unionAll(few).unionAll(crowded(pieces.filter(F.col("n") > most_contexts), length))


def remove_repeats(docs: DataFrame, length: int = 100, most_contexts: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row, with the bytes that remain as `kept`.

    Removes each byte covered by a string of `length` bytes that also starts earlier: in a document of smaller
    doc_id, or before in the same one. Every window of `length` bytes has an anchor, a short run that equal windows
    share. Later occurrences of an anchor's whole context are repeats; different contexts of one anchor come together
    in one task, which sorts their suffixes and finds equal windows among neighbours. Anchors with more than
    `most_contexts` contexts go window by window through a join instead, with the same result.

    A null or empty text has nothing to remove; a null doc_id comes after all others. Rows of one doc_id are one
    document if their texts are equal, else they follow each other in an order of their hashes. Other columns are not
    read. Strings are told apart by 64-bit hashes.
    """
    if not GRAM + 2 <= length <= min(DEPTH, GRAM + 127):
        raise ValueError(f"length must be {GRAM + 2} to {min(DEPTH, GRAM + 127)}")
    picked = keyed(pick(docs, "doc_id", "text"))
    spans = repeated_spans(picked, length, most_contexts)
    listed = spans.groupBy("doc", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = picked.join(listed, ["doc", "th"], "left").select("doc_id", "text", "spans")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches):
            n_bytes, n_removed, n_spans, digest, kept = [], [], [], [], []
            for text, found in zip(batch.column("text"), batch.column("spans"), strict=True):
                raw, spans_ = text.as_buffer().to_pybytes(), found.values
                start = end = np.zeros(0, np.int64)
                if spans_ is not None and len(spans_):
                    start, end = (spans_.field(k).to_numpy() for k in (0, 1))
                    start, end, _ = runs(start, end, np.zeros(len(start), np.int64))
                cuts = [0, *np.stack([start, end], 1).reshape(-1).tolist(), len(raw)]
                rest = b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                n_bytes.append(len(raw))
                n_removed.append(len(raw) - len(rest))
                n_spans.append(len(start))
                digest.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(digest), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    kind = picked.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(remove, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
