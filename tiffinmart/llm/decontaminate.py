"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffinmart.llm.frames import in_blocks, pick
from tiffinmart.llm.tokens import span_hashes, words

#: Bytes of benchmark text that a task holds at a time; larger benchmarks take several passes.
BLOCK_BYTES = 8 << 20
FILTER_BITS = 22
#: Equal pairs of seeds that are listed at a time; a text with more of them goes item by item, place by place.
MOST_PAIRS = 1 << 21


class Seeds(NamedTuple):
    """Runs of `size` words of benchmark items: sorted hashes, and item and place of each."""

    size: int
    hashes: np.ndarray
    items: np.ndarray
    places: np.ndarray
    ids: list
    words: list[np.ndarray]
    filter: np.ndarray

    @classmethod
    def of(cls, items: list[tuple], size: int) -> Seeds:
        w = words(pa.array([t for _, t in items], pa.large_string()))
        first = np.concatenate([[0], np.cumsum(w.counts)])
        at = np.flatnonzero(np.arange(len(w.rows)) + size <= first[w.rows + 1])
        h = span_hashes(w.hashes, at, at + size)
        order = np.argsort(h, kind="stable")
        at, h = at[order], h[order]
        seen = np.zeros(1 << FILTER_BITS, bool)
        seen[h >> np.uint64(64 - FILTER_BITS)] = True
        each = [w.hashes[first[i] : first[i + 1]] for i in range(len(items))]
        return cls(size, h, w.rows[at], at - first[w.rows[at]], [i for i, _ in items], each, seen)

    def near(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in `h` with equal seeds, and the range of these."""
        near = np.flatnonzero(self.filter[h >> np.uint64(64 - FILTER_BITS)])
        low, high = np.searchsorted(self.hashes, h[near], "left"), np.searchsorted(self.hashes, h[near], "right")
        some = high > low
        return near[some], low[some], high[some]


def listed(near: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place with each seed of its range."""
    n = high - low
    ours = np.repeat(near, n)
    return ours, np.arange(len(ours)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def runs(p: np.ndarray, t: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Seed matches (place in item, place in text) joined along diagonals to maximal matches (place, place, length)."""
    order = np.lexsort((p, t - p))
    p, t = p[order], t[order]
    new = np.flatnonzero(np.concatenate([[True], (np.diff(p) != 1) | (np.diff(t) != 1)]))
    lengths = np.diff(np.concatenate([new, [len(p)]])) + size - 1
    return list(zip(p[new].tolist(), t[new].tolist(), lengths.tolist(), strict=True))


def long_runs(seeds: np.ndarray, places: np.ndarray, h: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """What `runs` gives for the item's seeds at `places` (in order) and all places of a text with seeds `h`, without a
    list of their pairs: diagonals that go on are carried from place to place."""
    order = np.argsort(h, kind="stable")
    sorted_h = h[order]
    out, before = [], -2
    diagonals = begun = np.zeros(0, np.int64)

    def ended(which: np.ndarray) -> None:
        for d, b in zip(diagonals[which].tolist(), begun[which].tolist(), strict=True):
            out.append((b, b + d, before - b + size))

    for p, seed in zip(places.tolist(), seeds.tolist(), strict=True):
        here = order[np.searchsorted(sorted_h, np.uint64(seed), "left") : np.searchsorted(sorted_h, np.uint64(seed), "right")] - p
        if p != before + 1:
            ended(np.ones(len(diagonals), bool))
            diagonals = begun = np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(diagonals, here), max(len(diagonals) - 1, 0))
        goes_on = diagonals[at] == here if len(diagonals) else np.zeros(len(here), bool)
        still = np.zeros(len(diagonals), bool)
        still[at[goes_on]] = True
        ended(~still)
        starts = np.full(len(here), p)
        starts[goes_on] = begun[at[goes_on]]
        diagonals, begun, before = here, starts, p
    ended(np.ones(len(diagonals), bool))
    return out


def tiles(matches: list[tuple[int, int, int]], n_item: int, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: again and again the longest match over unmarked words of both sides is marked as a tile,
    down to `least` words. Equally long ones go by place in the item, then in the text."""
    marked_item, marked_text = np.zeros(n_item, bool), set()
    heap = [(-n, p, t) for p, t, n in matches]
    heapq.heapify(heap)
    out = []
    while heap:
        n, p, t = heapq.heappop(heap)
        n = -n
        free = [not marked_item[p + k] and (t + k) not in marked_text for k in range(n)]
        if all(free):
            out.append((p, t, n))
            marked_item[p : p + n] = True
            marked_text.update(range(t, t + n))
            if marked_item.all():
                break
            continue
        k = 0
        while k < n:
            end = k
            while end < n and free[end]:
                end += 1
            if end - k >= least:
                heapq.heappush(heap, (k - end, p + k, t + k))
            k = end + 1
    return out


def covered_pairs(batch: pa.RecordBatch, seeds: Seeds, share: float) -> Iterator[tuple]:
    """(row, item, words, tiles, covered words, longest tile) of each text and item with a covered share of at least `share`."""
    w = words(batch.column("text"))
    first = np.concatenate([[0], np.cumsum(w.counts)])
    at = np.flatnonzero(np.arange(len(w.rows)) + seeds.size <= first[w.rows + 1])
    h = span_hashes(w.hashes, at, at + seeds.size)
    near, low, high = seeds.near(h)
    owner = w.rows[at[near]]
    # Texts in order, as many at a time as have few enough pairs.
    ends = np.searchsorted(owner, np.arange(len(w.counts) + 1))
    pairs = np.concatenate([[0], np.cumsum(high - low)])[ends]
    row = 0
    while row < len(w.counts):
        to = max(row + 1, int(np.searchsorted(pairs, pairs[row] + MOST_PAIRS, "right")) - 1)
        some = slice(ends[row], ends[to])
        if pairs[to] - pairs[row] > MOST_PAIRS:
            own = np.flatnonzero(w.rows[at] == row)
            yield from _crowded(row, h[own], low[some], high[some], seeds, share)
        elif ends[to] > ends[row]:
            ours, theirs = listed(near[some], low[some], high[some])
            yield from _paired(w.rows[at[ours]], seeds.items[theirs], at[ours] - first[w.rows[at[ours]]], seeds.places[theirs], seeds, share)
        row = to


def _reachable(places: np.ndarray, n: int, size: int) -> int:
    """Words of an item that seeds at these places cover: tiles are made of seed matches, so these bound them."""
    reach = np.zeros(n + 1, np.int64)
    reach[places] += 1
    reach[places + size] -= 1
    return np.count_nonzero(np.cumsum(reach))


def _told(row: int, item: int, matches, n: int, seeds: Seeds, share: float) -> Iterator[tuple]:
    found = tiles(matches, n, seeds.size)
    covered = sum(k for _, _, k in found)
    if covered >= share * n:
        yield row, item, n, len(found), covered, max(k for _, _, k in found)


def _paired(rows, items, t, p, seeds: Seeds, share: float) -> Iterator[tuple]:
    order = np.lexsort((items, rows))
    rows, items, t, p = rows[order], items[order], t[order], p[order]
    starts = np.flatnonzero(np.concatenate([[True], (np.diff(rows) != 0) | (np.diff(items) != 0)]))
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(rows)], strict=True):
        n = len(seeds.words[items[a]])
        if _reachable(np.unique(p[a:b]), n, seeds.size) >= share * n:
            yield from _told(int(rows[a]), int(items[a]), runs(p[a:b], t[a:b], seeds.size), n, seeds, share)


def _crowded(row: int, h: np.ndarray, low: np.ndarray, high: np.ndarray, seeds: Seeds, share: float) -> Iterator[tuple]:
    """A text whose seeds have very many equal ones: each item by itself. `h` are the seeds at its places, from 0."""
    ranges = np.unique(np.stack([low, high]), axis=1)
    _, which = listed(ranges[0], ranges[0], ranges[1])
    for item in np.unique(seeds.items[which]).tolist():
        own = which[seeds.items[which] == item]
        own = own[np.argsort(seeds.places[own])]
        n = len(seeds.words[item])
        if _reachable(seeds.places[own], n, seeds.size) >= share * n:
            yield from _told(row, item, long_runs(seeds.hashes[own], seeds.places[own], h, seeds.size), n, seeds, share)


def benchmark_blocks(benchmark: DataFrame, size: int, block_bytes: int) -> Iterator[Seeds]:
    """The benchmark's seeds, in blocks of about `block_bytes` of text: the driver holds one block at a time."""
    items = pick(benchmark, "item_id", "text").filter("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = math.ceil(total / block_bytes)
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield Seeds.of(sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda x: (str(x[0]), x[1])), size)


def contamination(
    docs: DataFrame, benchmark: DataFrame, share: float = 0.5, min_match: int = 5, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row for each document and benchmark item of which tiles cover `share` of the words or more.

    Words are lowered in A-Z. Seeds, runs of `min_match` words that both sides share, are found by their rolling hash;
    joined to maximal matches they are tiled greedily, longest first and without overlap on either side, so passages
    are caught in any order. Returns doc_id, item_id, n_words (of the item), n_tiles, n_covered, longest_tile and
    coverage. Null or empty texts on either side and items of fewer than `min_match` words match nothing; repeated
    documents each give rows, repeated items count once; ties go by place; other columns are not read. Every document
    is read once for each block of the benchmark, and no document is shuffled.
    """
    picked = pick(docs, "doc_id", "text")
    doc_type, item_type = (f.schema[n].dataType.simpleString() for f, n in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {doc_type}, item_id {item_type}, n_words long, n_tiles long, n_covered long, longest_tile long, coverage double"

    def passes(seeds):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = seeds.value
            for batch in in_blocks(batches):
                if found := list(covered_pairs(batch, held, share)):
                    rows, items, *counts = zip(*found, strict=True)
                    coverage = [c / n for n, c in zip(counts[0], counts[2], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(rows)), pa.array([held.ids[i] for i in items]), *[pa.array(c, pa.int64()) for c in counts], pa.array(coverage)],
                        names=["doc_id", "item_id", "n_words", "n_tiles", "n_covered", "longest_tile", "coverage"],
                    )

        return scan

    sc = docs.sparkSession.sparkContext
    found = [picked.mapInArrow(passes(sc.broadcast(s)), schema) for s in benchmark_blocks(benchmark, min_match, block_bytes)]
    return reduce(DataFrame.unionAll, found) if found else picked.limit(0).mapInArrow(lambda batches: iter(()), schema)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, share: float = 0.5, min_match: int = 5, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of `docs` of which `contamination` finds nothing, as they were: null and empty texts stay, repeated rows
    stay or go together, and an empty benchmark leaves all."""
    names = list(docs.columns)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text_at = names.index("text")

    out, schema = plain, plain.schema
    sc = docs.sparkSession.sparkContext
    for seeds in benchmark_blocks(benchmark, min_match, block_bytes):
        out = out.mapInArrow(_keeping(sc.broadcast(seeds), text_at, list(plain.columns), share), schema)
    return out.toDF(*names)


def _keeping(seeds, text_at: int, names: list[str], share: float):
    inner = ["text" if i == text_at else n for i, n in enumerate(names)]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = seeds.value
        for batch in in_blocks(pa.RecordBatch.from_arrays(b.columns, names=inner) for b in batches):
            good = np.ones(batch.num_rows, bool)
            good[[row for row, *_ in covered_pairs(batch, held, share)]] = False
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good)) for c in batch.columns], names=names)

    return keep
