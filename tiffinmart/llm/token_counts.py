"""Token counts by a prefix table, for sentencepiece BPE models."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tiffinmart.llm.frames import in_blocks, pick

BLANK = "▁"


class PrefixCounter:
    """Exact token counts of every prefix of a text.

    No piece of the model holds a blank behind another character, so a text falls into chunks (blanks, then the
    characters up to the next one) that are encoded independently. Within a chunk the tokens of a prefix are those of
    a shorter prefix and one last piece; of the pieces that end there exactly one is compatible with the last piece
    of what is before it. So count[i] = count[i - len(piece)] + 1, without encoding anything twice. Prefix counts of
    chunks are kept for reuse, `most` of them at a time; a chunk longer than `long` characters is not kept.
    """

    def __init__(self, model: bytes, most: int = 1_000_000, long: int = 64):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto.FromString(model)
        blanks = spec.normalizer_spec
        if spec.trainer_spec.model_type != spec.trainer_spec.BPE or blanks.precompiled_charsmap or blanks.remove_extra_whitespaces or not blanks.add_dummy_prefix:
            raise ValueError("a BPE model without normalisation and with a leading blank is needed")
        blanks.add_dummy_prefix = False  # chunks bring their own blank
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        ids = range(self.sp.get_piece_size())
        special = lambda i: self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_byte(i) or self.sp.is_unused(i)
        pieces = [self.sp.id_to_piece(i) for i in ids if not special(i)]
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a piece holds a blank inside: texts cannot be cut at blanks")
        # A piece that does not encode to itself is never a last piece.
        whole = self.sp.encode(pieces, out_type=str, num_threads=1)
        pieces = [p for p, e in zip(pieces, whole, strict=True) if e == [p]]
        #: Every ending of a piece, and whether it is a piece itself.
        self.endings = {p[i:]: False for p in pieces for i in range(len(p))} | dict.fromkeys(pieces, True)
        self.most, self.long = most, long
        self.pairs: dict[tuple[str, str], bool] = {}
        self.totals: dict[str, int] = {}
        self.chunk = re.compile(f"{BLANK}+[^{BLANK}]*")

    def follows(self, left: str, right: str) -> bool:
        """Whether the encoding of the two strings in a row is these two pieces."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= 2 * self.most:
                self.pairs.clear()
            known = self.pairs[left, right] = self.sp.encode(left + right, out_type=str) == [left, right]
        return known

    def extend(self, chunk: str, counts: list[int], last: list[str]) -> None:
        """Goes on with the prefix counts of `chunk` from the prefix that `counts` and `last` already cover."""
        endings, pairs = self.endings, self.pairs
        for i in range(len(counts), len(chunk) + 1):
            ends, at = [], i - 1
            while at >= 0 and (whole := endings.get(chunk[at:i])) is not None:
                if whole:
                    ends.append(at)
                at -= 1
            for at in reversed(ends):
                left, piece = last[at], chunk[at:i]
                # An unknown character has no piece; nothing merges across it.
                if not left or pairs.get((left, piece)) or self.follows(left, piece):
                    counts.append(counts[at] + 1)
                    last.append(piece)
                    break
            else:
                counts.append(counts[i - 1] + len(chunk[i - 1].encode()))
                last.append("")

    def chunk_counts(self, chunk: str) -> list[int]:
        """Tokens of chunk[:i] for i = 0 to its length."""
        counts, last = [0], [""]
        self.extend(chunk, counts, last)
        return counts

    def learn(self, chunks: set[str]) -> None:
        """Counts for chunks not met before. In order, each goes on from what it shares with the one before."""
        if len(self.totals) >= self.most:
            self.totals.clear()
        counts, last, before = [0], [""], ""
        for chunk in sorted(chunks - self.totals.keys()):
            shared = 0
            for x, y in zip(before, chunk, strict=False):
                if x != y:
                    break
                shared += 1
            del counts[shared + 1 :], last[shared + 1 :]
            self.extend(chunk, counts, last)
            self.totals[chunk] = counts[-1]
            before = chunk

    def chunks(self, text: str) -> list[str]:
        return self.chunk.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def prefix_sums(self, texts: list[str]) -> Iterator[list[int]]:
        """For each text the tokens up to the end of each of its chunks."""
        split = [self.chunks(t) for t in texts]
        self.learn({c for chunks in split for c in chunks if len(c) <= self.long})
        known = self.totals
        for chunks in split:
            yield list(accumulate(known[c] if len(c) <= self.long else self.chunk_counts(c)[-1] for c in chunks))

    def table(self, text: str) -> PrefixTable:
        return PrefixTable(self, text)


class PrefixTable:
    """Answers about one text after one pass over it."""

    def __init__(self, counter: PrefixCounter, text: str):
        self.counter, self.text = counter, text
        self.parts = counter.chunks(text)
        # Before each chunk: characters, with the leading blank that the model adds, and tokens.
        self.at = [0, *accumulate(map(len, self.parts))]
        self.counts = [0, *next(counter.prefix_sums([text]))]

    def count(self, n_chars: int | None = None) -> int:
        """Tokens of the first `n_chars` characters."""
        if n_chars is None or n_chars >= len(self.text):
            return self.counts[-1]
        if n_chars <= 0:
            return 0
        k = bisect_right(self.at, n_chars + 1) - 1
        rest = n_chars + 1 - self.at[k]
        return self.counts[k] + (self.counter.chunk_counts(self.parts[k][:rest])[-1] if rest else 0)

    def fits(self, budget: int) -> int:
        """Length of the longest prefix of at most `budget` tokens."""
        if self.counts[-1] <= budget:
            return len(self.text)
        for k in range(min(bisect_right(self.counts, budget), len(self.parts)) - 1, -1, -1):
            inner = self.counter.chunk_counts(self.parts[k])
            best = max((i for i, n in enumerate(inner) if self.counts[k] + n <= budget), default=0)
            if best:
                return max(0, self.at[k] + best - 1)
        return 0


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than `limit` tokens) of every row of `docs`.

    Tokens are those of the sentencepiece BPE model at `model_path`, without begin, end or special tokens. A null or
    empty text has no bytes and no tokens; repeated rows each get a row; other columns are not read.
    """
    with open(model_path, "rb") as f:
        model = f.read()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter(model)
        for batch in in_blocks(batches, 4 << 20):
            texts = pc.fill_null(batch.column("text"), "")
            n = pa.array([sums[-1] if sums else 0 for sums in counter.prefix_sums(texts.to_pylist())], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), n, pc.greater(n, limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    picked = pick(docs, "doc_id", "text")
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
