"""Language-model scores from a probabilistic suffix tree over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffinmart.llm.byte_cnn import fold_of
from tiffinmart.llm.frames import in_blocks, pick
from tiffinmart.llm.sieves import passes, sieve
from tiffinmart.llm.storage import dropped, settled
from tiffinmart.llm.tokens import mixed, words
from tiffinmart.session import empty_frame

#: Stands for the end of a text among the hashes of words. Not 0, which would vanish in hashes of runs.
END = np.uint64(1)


class Tokens:
    """Tokens of a column of texts in one run, each text followed by its end, and hashes of runs of them."""

    def __init__(self, texts: pa.Array):
        # Hashing takes many bytes for each byte of text, so a little text at a time.
        pieces = map(words, (b.column("text") for b in in_blocks([pa.RecordBatch.from_arrays([texts], names=["text"])], 1 << 18)))
        counts, hashes = (np.concatenate(x) for x in zip(*((w.counts, w.hashes) for w in pieces), strict=True))
        n = len(counts)
        self.counts = counts + 1
        self.rows = np.repeat(np.arange(n), self.counts)
        self.hashes = np.full(len(hashes) + n, END)
        self.hashes[np.arange(len(hashes)) + np.repeat(np.arange(n), counts)] = hashes
        #: Tokens from each place to the end of its text.
        self.left = np.repeat(np.cumsum(self.counts), self.counts) - np.arange(len(self.rows))

    def runs(self, longest: int) -> list[np.ndarray]:
        """Hashes of the runs of 1, 2, ... tokens that start at each place; those that reach past a text mean nothing."""
        out = [self.hashes]
        for _ in range(longest - 1):
            out.append(joined(out[-1], np.concatenate([out[-1][1:], out[-1][:1]])))
        return out


def joined(first: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Hash of runs by the hashes of all but their last and all but their first token: Spark's `xxhash64` of both."""
    p = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]
    turned = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    h = np.uint64(42)
    for part in (first, rest):
        h = (h + p[4] + np.uint64(8)) ^ (turned(part * p[1], 31) * p[0])
        h = turned(h, 27) * p[0] + p[3]
        h = (h ^ (h >> np.uint64(33))) * p[1]
        h = (h ^ (h >> np.uint64(29))) * p[2]
        h = h ^ (h >> np.uint64(32))
    return h


def found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    # Sorted keys find their places in the cache.
    order = np.argsort(keys)
    at = np.empty(len(keys), np.int64)
    at[order] = np.minimum(np.searchsorted(table, keys[order]), len(table) - 1)
    return at, table[at] == keys


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def sorted_table(df: DataFrame, value: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes `h` of all rows, sorted, and their values."""
    table = df.select("h", value).toArrow()
    h, x = table.column("h").to_numpy().view(np.uint64), table.column(value).to_numpy()
    by = np.argsort(h)
    return h[by], x[by]


def counted_words(docs: DataFrame) -> DataFrame:
    """h, n and c: every token, by its hash, with its count in all and in training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, 4 << 20):
            t = Tokens(batch.column("text"))
            trains = ~batch.column("held_out").to_numpy(zero_copy_only=False)[t.rows]
            h, which = np.unique(t.hashes, return_inverse=True)
            n, c = np.bincount(which, minlength=len(h)), np.bincount(which, trains, len(h)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([_signed(h), pa.array(n), pa.array(c)], names=["h", "n", "c"])

    return docs.mapInArrow(count, "h long, n long, c long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


def counted_runs(docs: DataFrame, longest: int, common: np.ndarray) -> DataFrame:
    """ord, first, rest and n: every run of 2 to `longest` tokens of the training texts whose last word but one is in
    `common`, by the hashes of all but its last and of all but its first token."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, 4 << 20):
            t = Tokens(batch.column("text"))
            trains = ~batch.column("held_out").to_numpy(zero_copy_only=False)[t.rows]
            before = found(shared.value, t.hashes)[1]
            for order, part in enumerate(t.runs(longest - 1), 2):
                at = np.flatnonzero(trains & (t.left >= order))
                at = at[before[at + order - 2]]
                first, rest = part[at], part[at + 1]
                _, place, times = np.unique(joined(first, rest), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(place), order, np.int32)), _signed(first[place]), _signed(rest[place]), pa.array(times)], names=["ord", "first", "rest", "n"]
                )

    return docs.mapInArrow(count, "ord int, first long, rest long, n long").groupBy("ord", "first", "rest").agg(F.sum("n").alias("n"))


def kept_words(
    docs: DataFrame, vocab: DataFrame, common: np.ndarray, word_share: float, least_count: int, least_bits: float, weight: float, most_alike: int
) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], DataFrame]:
    """Words of `common` that are kept as contexts on their own account and stand behind no word more than `most_alike`
    times: hashes, counts in training texts and numbers of parts for their places. And `first`, `rest` and `n` of the pairs
    that begin with them and occur often enough, with the count `c` of the token."""
    counted = settled(counted_runs(docs, 2, common), "pairs")
    pairs = counted.filter(F.col("n") >= least_count).join(vocab.select(F.col("h").alias("rest"), "c"), "rest")
    told = F.col("n") * F.log2(F.col("n") / F.greatest("below", F.lit(1e-12)))
    sums = pairs.withColumn("below", F.col("c") * word_share).groupBy("first").agg(F.sum("n").alias("seen"), F.sum("below").alias("below"), F.sum(told).alias("told"))
    sums = sums.join(vocab.select(F.col("h").alias("first"), "n", "c"), "first").toArrow()
    h, n, c, *of_runs = (sums.column(x).to_numpy() for x in ("first", "n", "c", "seen", "below", "told"))
    # Such a word before is frequent itself, so its pairs are among the counted ones.
    alike = counted.filter(F.col("n") > most_alike).select("rest").distinct().toArrow().column("rest").to_numpy()
    kept = (divergence(c, *of_runs, weight)[0] >= least_bits) & ~np.isin(h, alike)
    by = np.flatnonzero(kept)[np.argsort(h[kept].view(np.uint64))]
    by_hash = docs.sparkSession.createDataFrame(pa.table({"first": h[by]}))
    return (h[by].view(np.uint64), c[by], -(-2 * n[by] // most_alike)), pairs.join(F.broadcast(by_hash), "first", "left_semi").select("first", "rest", "n", "c")


def tree(docs: DataFrame, vocab: DataFrame, common: np.ndarray, word_share: float, max_depth: int, least_count: int, least_bits: float, weight: float) -> DataFrame:
    """h, ord, n and own of runs: what each occurrence of it in a text adds to the score beyond its words alone. Of the
    tree this is the part of the contexts that end in a word of `common`; no other part has a say in it.

    Contexts of words are kept by divergence, closed under suffixes, and smoothed by their suffixes. A kept context
    adds its back-off to the token behind it. A run that it stores takes that and what the suffix says back, and adds
    its own probability: along the suffixes the sum leaves the longest stored run and the back-offs of longer contexts.
    """
    h = F.xxhash64("first", "rest").alias("h")
    lower = vocab.filter(F.col("c") >= least_count).select("h", F.col("c").alias("n"), (F.col("c") * word_share).alias("p"))
    runs, contexts = {}, {}
    every = settled(counted_runs(docs, max_depth + 1, common), "counted")
    for d in range(1, max_depth + 1):
        counted = every.filter(F.col("ord") == d + 1)
        # All but the first token of a run are at least as frequent, so the join finds them.
        x = counted.filter(F.col("n") >= least_count).select("first", "rest", "n").join(lower.select(F.col("h").alias("rest"), F.col("p").alias("below")), "rest")
        x = settled(x, f"runs{d + 1}")
        told = F.col("n") * F.log2(F.col("n") / F.greatest("below", F.lit(1e-12)))
        per = x.groupBy("first").agg(F.sum("n").alias("seen"), F.sum("below").alias("b"), F.sum(told).alias("told"), F.min("rest").alias("tail"))
        # A token follows every word, so those behind a context add up to its own count.
        per = per.join(counted.groupBy("first").agg(F.sum("n").alias("m")), "first")
        share = F.col("seen") / F.col("m")
        left, left_below = 1 - share, F.greatest(1 - F.col("b"), F.lit(1e-9))
        gain = F.col("told") / F.col("m") - share * F.log2("m") + F.when(left > 1e-9, left * F.log2(left / left_below)).otherwise(0.0)
        back = (F.col("m") - F.col("seen") + weight) / (F.col("m") + weight)
        contexts[d] = settled(per.select("first", "tail", "m", back.alias("back"), (gain >= least_bits).alias("keep")), f"contexts{d}")
        y = x.join(contexts[d].select("first", "m", "back"), "first").withColumn("p", F.col("n") / (F.col("m") + weight) + F.col("back") * F.col("below"))
        own = F.log10("p") - F.log10("back") - F.log10("below")
        runs[d] = settled(y.select("first", "rest", "n", "p", own.cast("float").alias("own")), f"stored{d + 1}")
        dropped(x)
        lower = runs[d].select(h, "n", "p")
    dropped(every)
    values, longer = [], None
    for d in range(max_depth, 0, -1):
        kept = contexts[d].filter("keep").select("first")
        if longer is not None:
            # A run behind a context tells its suffix: that is the context of the run without its first token.
            suffixes = longer.select(F.col("tail").alias("h")).distinct().join(runs[d].select(h, "first"), "h").select("first")
            kept = kept.union(suffixes)
        longer = settled(contexts[d].join(kept, "first", "left_semi").select("first", "tail"), f"kept{d}")
        stored = runs[d].join(longer, "first", "left_semi").select(h, F.lit(d + 1).alias("ord"), "n", F.col("own").cast("double").alias("own"))
        turns = contexts[d].join(longer, "first", "left_semi").select(F.col("first").alias("h"), F.lit(d).alias("ord"), F.col("m").alias("n"), F.log10("back").alias("own"))
        values.append(settled(stored.union(turns), f"values{d}"))
        for done in (runs[d], contexts[d]):
            dropped(done)
    out = values[0]
    for more in values[1:]:
        out = out.union(more)
    out = settled(out.groupBy("h").agg(F.max("ord").alias("ord"), F.max("n").alias("n"), F.sum("own").alias("own")), "tree")
    for done in values:
        dropped(done)
    return out


def packed(columns: list[np.ndarray]) -> bytes:
    """Arrays of uint32 as compressed bytes, the lowest bytes of all first."""
    planes = [np.ascontiguousarray(c, np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpacked(data: bytes, lengths: list[int]) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(data, 4 * sum(lengths), codec="zstd", asbytes=True), np.uint8)
    ends = np.cumsum([4 * n for n in lengths])
    return [np.ascontiguousarray(raw[e - 4 * n : e].reshape(4, n).T).view(np.uint32).reshape(-1) for e, n in zip(ends, lengths, strict=True)]


def two_halves(x: np.ndarray) -> list[np.ndarray]:
    return [x >> np.uint64(32), x & np.uint64(0xFFFFFFFF)]


#: Rows on their way to a part: places of a block, the keys of its texts, and tokens that follow a word (`block` is then
#: how often the word occurs); besides, `h` and `c` of words that were asked for.
PLACES, KEYS, PAIRS = range(3)
DEALT = "kind int, part int, n int, docs int, others int, block long, data binary, h long, c long"


def dealt_rows(rows: list[tuple], block: int) -> pa.RecordBatch:
    ints = [pa.array([int(r[i]) for r in rows], pa.int32()) for i in range(5)]
    none = pa.nulls(len(rows), pa.int64())
    return pa.RecordBatch.from_arrays(
        [*ints, pa.array([block] * len(rows), pa.int64()), pa.array([r[5] for r in rows], pa.binary()), none, none], names=[c.split()[0] for c in DEALT.split(", ")]
    )


def steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=0)


def divergence(m, seen, below, told, weight: float):
    """Bits by which contexts diverge from their suffixes, and their back-offs, from sums over the runs they store: `m` is
    how often a context occurs, `seen` and `below` how often its runs do and what the suffix gives them."""
    total = np.maximum(m, 1)
    share = seen / total
    left = 1 - share
    more = left * np.log2(np.where(left > 1e-9, left / np.maximum(1 - below, 1e-9), 1.0))
    return told / total - share * np.log2(total) + np.where(left > 1e-9, more, 0.0), (m - seen + weight) / (m + weight)


def context_values(
    w: list[np.ndarray], trains: np.ndarray, below: np.ndarray, stored: np.ndarray, depth: int, max_depth: int, least_count: int, least_bits: float, weight: float
) -> tuple[np.ndarray, bool]:
    """What each place adds to the score by contexts of `depth` words and more, from all places of these contexts, and
    whether any of them is kept. The places share the words nearer than that.

    `w` has numbers of the token of each place and of the words before it, the nearest first; 0 stands for none and for
    words that occur less than `least_count` times. `below` is the probability of the token behind the shared words;
    `stored` tells whether it is found there often enough.
    """
    size = len(below)
    levels, below = [], below.copy()
    # Places whose context and token are still looked at, and numbers of their contexts.
    at, c = np.arange(size, dtype=np.int32), np.zeros(size, np.int64)
    for d in range(depth, max_depth + 1):
        name, c = np.unique(c.astype(np.uint64) << np.uint64(32) | w[d][at], return_inverse=True)
        m = np.bincount(c, trains[at], len(name))
        # A run occurs often enough only if what is left without its first token does.
        may = np.flatnonzero(stored)
        place = at[may]
        run, r = np.unique(c[may].astype(np.uint64) << np.uint64(32) | w[0][place], return_inverse=True)
        n = np.bincount(r, trains[place], len(run))
        of, p0, often = (run >> np.uint64(32)).astype(np.int64), np.empty(len(run)), n >= least_count
        p0[r] = below[place]
        known = np.where(often, n, 0.0)
        seen, b = np.bincount(of, known, len(name)), np.bincount(of, np.where(often, p0, 0.0), len(name))
        told = np.bincount(of, known * np.log2(np.where(often, n / np.maximum(p0, 1e-12), 1.0)), len(name))
        gain, back = divergence(m, seen, b, told, weight)
        p = n / (m[of] + weight) + back[of] * p0
        own = np.where(often, np.log10(p) - np.log10(back[of]) - np.log10(p0), 0.0)
        value = np.log10(back)[c]
        value[may] += own[r]
        levels.append((at, c.astype(np.int32), value, (seen > 0) & (gain >= least_bits)))
        if d == max_depth:
            break
        # The next longer contexts, where there are such.
        stored = np.zeros(len(at), bool)
        stored[may] = often[r]
        below[place] = p[r]
        longer = np.flatnonzero((w[d + 1][at] != 0) & (m[c] >= least_count))
        at, c, stored = at[longer], c[longer], stored[longer]
    out = np.zeros(size)
    keeps = np.zeros(size, bool)
    for at, c, value, keep in reversed(levels):
        # A context is kept on its own account or as the suffix of a longer one.
        all_of = keep.copy()
        all_of[c[keeps[at]]] = True
        keeps = np.zeros(size, bool)
        keeps[at] = all_of[c]
        out[at] += np.where(all_of[c], value, 0.0)
    return out, bool(keeps.any())


def text_values(
    w: list[np.ndarray], doc: np.ndarray, trains: np.ndarray, below: np.ndarray, max_depth: int, least_count: int, least_bits: float, weight: float, at_once: int,
    counted: tuple[np.ndarray, int] | None = None,
) -> np.ndarray:
    """Sums by text of what contexts add, from all places behind some words. `doc` is the text of each place, `trains`
    tells of a text whether it trains, `below` has the probability of each token by its number (0: none).

    Words before do not meet, so some of them at a time are looked at. Those with more than `at_once` places are
    counted alone, by the number of the token, and their places are then taken apart by the next word before, and so on.
    With `counted` all places are behind one word that is kept: how often each token follows it, and how often it occurs,
    at these places and at others.
    """
    out = np.zeros(len(trains))

    def alone(places: np.ndarray, d: int, below: np.ndarray, n: np.ndarray, m: int, keep: bool = False) -> bool:
        """The same for `places` behind one context of `d` words, which occurs `m` times, `n` times with each token."""
        often = np.flatnonzero((n >= least_count) & (below > 0))
        n, p0 = n[often], below[often]
        gain, back = divergence(m, n.sum(), p0.sum(), (n * np.log2(n / np.maximum(p0, 1e-12))).sum(), weight)
        p, value = np.zeros(len(below)), np.full(len(below), np.log10(back))
        p[often] = n / (m + weight) + back * p0
        value[often] += np.log10(p[often]) - np.log10(back) - np.log10(p0)
        if d < max_depth and m >= least_count:
            keep |= deeper(places, d + 1, p)
        keep |= bool(len(often) > 0 and gain >= least_bits)
        if keep:
            out[:] += np.bincount(doc[places], value[w[0][places]], len(out))
        return keep

    def deeper(places: np.ndarray, d: int, below: np.ndarray) -> bool:
        """Adds what contexts of `d` words and more give to `places`, which share the words nearer. Is any of them kept?"""
        places = places[w[d][places] != 0]
        sizes = np.bincount(w[d][places])
        large = np.flatnonzero(sizes > at_once)
        some = places[sizes[w[d][places]] <= at_once] if len(large) else places
        some = some[np.argsort(w[d][some])]
        starts = np.flatnonzero(np.diff(w[d][some], prepend=np.uint32(0)))
        cuts = starts[np.flatnonzero(np.diff(starts // at_once, prepend=-1))]
        kept = False
        cuts = [*cuts, len(some)]
        for start, end in zip(cuts, cuts[1:]):
            o = some[start:end]
            p0 = below[w[0][o]]
            value, any_kept = context_values([x[o] for x in w], trains[doc[o]], p0, p0 > 0, d, max_depth, least_count, least_bits, weight)
            out[:] += np.bincount(doc[o], value, len(out))
            kept |= any_kept
        del some, starts
        for name in large:
            o = places[w[d][places] == name]
            trained = trains[doc[o]]
            kept |= alone(o, d, below, np.bincount(w[0][o][trained], minlength=len(below)), int(trained.sum()))
        return kept

    every = np.arange(len(doc), dtype=np.int32)
    if counted is None:
        deeper(every, 1, below)
    else:
        alone(every, 1, below, *counted, keep=True)
    return out


def context_scores(
    texts: DataFrame, vocab: DataFrame, table: tuple, common: np.ndarray, n_all: int, word_share: float, max_depth: int, least_count: int, least_bits: float, weight: float, whole: bool, part_tokens: int, at_once: int,
    split: tuple[np.ndarray, np.ndarray, np.ndarray], pairs: DataFrame | None,
) -> DataFrame:
    """key and more: what contexts that end in a word outside `common` add to the scores of the texts of each key.

    Every place goes, with the tokens before it, to the part of the word before it. There all contexts that end in this
    word are counted, kept and smoothed at once, and give the places their values. Places travel compressed, a block
    of texts for a part in one row, and so do the sums by text on their way back to the block, where they meet the keys.
    `table` has hashes, counts and numbers of words; `whole` tells that no other counts.

    Words of `split`, by hashes with counts and numbers of parts, are kept. Their places go to parts of their own by the
    word before, and all of these get the `pairs`, how often each token follows the word in the training texts.
    """
    parts = max(128, -(-n_all // part_tokens))
    split_first = parts + np.cumsum(split[2]) - split[2]
    all_parts = parts + int(split[2].sum())
    shared, counted = table
    shared_common = texts.sparkSession.sparkContext.broadcast((common, *split, split_first))
    rare = np.uint32(1 << 31)

    def places(batch: pa.RecordBatch):
        """Tokens; number of each (0: too rare, from 2^31: not in the table); places of a word before, and their parts."""
        hashes, _, numbers = shared.value
        t = Tokens(batch.column("text"))
        at, there = found(hashes, t.hashes)
        number = np.where(there, numbers[at], np.uint32(0) if whole else rare)
        word = (t.left >= 2) & (number > 0)
        frequent, split_words, _, split_parts, first = shared_common.value
        if len(frequent):
            word &= ~found(frequent, t.hashes)[1]
        place = np.flatnonzero(word)
        part = (t.hashes[place] >> np.uint64(17)) % np.uint64(parts)
        if len(split_words):
            at, there = found(split_words, t.hashes[place])
            at, where = at[there], place[there]
            # The first word of a text has none before it; such places may go anywhere.
            begins = np.concatenate([[True], t.left[:-1] == 1])
            other = t.hashes[np.where(begins[where], where + 1, where - 1)]
            part[there] = first[at].astype(np.uint64) + (other >> np.uint64(17)) % split_parts[at].astype(np.uint64)
        return t, number, place, part

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, 8 << 20):
            t, number, place, part = places(batch)
            before = number[place - (place > 0)]
            # Equal words beside each other take less room.
            order = np.argsort(part << np.uint64(40) | (number[place].astype(np.uint64) & np.uint64(0xFFFFF)) << np.uint64(20) | (before & np.uint32(0xFFFFF)).astype(np.uint64))
            ends = np.searchsorted(part[order], np.arange(all_parts + 1, dtype=np.uint64))
            del before, part
            place = place[order]
            begin = (np.cumsum(t.counts) - t.counts)[t.rows[place]]
            back = [-1, 0, *range(1, max_depth)]
            columns = [np.where(place - k >= begin, number[np.maximum(place - k, 0)], np.uint32(0)) for k in back]
            held = batch.column("held_out").to_numpy(zero_copy_only=False)
            keys = batch.column("key").to_numpy().view(np.uint64)
            # Blocks of the same texts have the same name, and give each key its sum over all of them.
            block = int(mixed(keys + mixed(np.arange(len(keys), dtype=np.uint64))).sum().view(np.int64))
            rows = [(KEYS, block % parts, 0, len(keys), 0, packed(two_halves(keys)))]
            for k in range(all_parts):
                o = slice(ends[k], ends[k + 1])
                if ends[k] == ends[k + 1]:
                    continue
                docs, doc = np.unique(t.rows[place[o]], return_inverse=True)
                own = [x[o] for x in columns]
                # Words outside the table go as hashes, numbered in this row.
                mine = [np.flatnonzero(x == rare) for x in own] if not whole else []
                met = [t.hashes[place[o][x] - i] for x, i in zip(mine, back)]
                others = np.unique(np.concatenate([np.zeros(0, np.uint64), *met]))
                for x, i, h in zip(own, mine, met):
                    x[i] = rare + np.searchsorted(others, h).astype(np.uint32)
                data = packed([*own, doc, steps(docs), held[docs], *two_halves(others)])
                rows.append((PLACES, k, len(doc), len(docs), len(others), data))
            yield dealt_rows(rows, block)

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, _, numbers = shared.value
        _, split_words, counts, split_parts, first = shared_common.value
        for batch in batches:
            word, token = (batch.column(c).to_numpy().view(np.uint64) for c in ("first", "rest"))
            at, there = found(hashes, token)
            number = np.where(there, numbers[at], rare)
            for h in np.unique(word):
                k = np.searchsorted(split_words, h)
                o = np.flatnonzero(word == h)
                o = o[np.argsort(number[o])]
                n, c = (batch.column(name).to_numpy()[o].view(np.uint64) for name in ("n", "c"))
                # Words outside the table go as hashes, with their counts.
                x, mine = number[o], np.flatnonzero(number[o] == rare)
                x[mine] = rare + np.arange(len(mine), dtype=np.uint32)
                others = token[o][mine]
                data = packed([x, *two_halves(n), *two_halves(others), *two_halves(c[mine])])
                yield dealt_rows([(PAIRS, first[k] + i, len(o), 0, len(others), data) for i in range(split_parts[k])], int(counts[k]))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, 4 << 20):
            t, number, place, part = places(batch)
            mine = number[place + 1] == rare
            asked = np.unique(np.stack([part[mine], t.hashes[place[mine] + 1]]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(asked[0].astype(np.int32)), _signed(asked[1])], names=["part", "h"])

    def give(table: pa.Table) -> pa.Table:
        count = counted.value
        told = table.filter(table.column("h").is_valid()).select(["h", "c"])
        table = table.filter(table.column("data").is_valid())
        kind = np.asarray(table.column("kind"))
        back = table.filter(pa.array(kind == KEYS)).select(["block", "docs", "data"])
        of_pairs = table.filter(pa.array(kind == PAIRS))
        table = table.filter(pa.array(kind == PLACES))
        lengths = list(zip(*(table.column(x).to_pylist() for x in ("n", "docs", "others")), strict=True))
        size = sum(n for n, _, _ in lengths)
        w, doc = [np.empty(size, np.uint32) for _ in range(max_depth + 1)], np.empty(size, np.uint32)
        rows, held, others = [], [np.zeros(0, np.uint32)], [np.zeros(0, np.uint64)]
        start = n_docs = n_others = 0
        for (n, docs, more), data in zip(lengths, table.column("data"), strict=True):
            *own, doc_of, row, held_out, high, low = unpacked(data.as_buffer(), [n] * (max_depth + 2) + [docs] * 2 + [more] * 2)
            for x, y in zip(w, own, strict=True):
                if more:
                    y = np.where(y >= rare, y + np.uint32(n_others), y)
                x[start : start + n] = y
            doc[start : start + n] = doc_of + np.uint32(n_docs)
            rows.append(row)
            held.append(held_out)
            others.append(high.astype(np.uint64) << np.uint64(32) | low)
            start, n_docs, n_others = start + n, n_docs + docs, n_others + more
        followers, other_counts = [], []
        for n, more, data in zip(*(of_pairs.column(c).to_pylist() for c in ("n", "others")), of_pairs.column("data"), strict=True):
            x, n_high, n_low, high, low, c_high, c_low = unpacked(data.as_buffer(), [n] * 3 + [more] * 4)
            followers.append((np.where(x >= rare, x + np.uint32(n_others), x), n_high.astype(np.int64) << 32 | n_low))
            other_counts.append((n_others, c_high.astype(np.int64) << 32 | c_low))
            others.append(high.astype(np.uint64) << np.uint64(32) | low)
            n_others += more
        # Words outside the table get the numbers behind it.
        other, which = np.unique(np.concatenate(others), return_inverse=True)
        for x in [*w, *(x for x, _ in followers)] if n_others else ():
            mine = np.flatnonzero(x >= rare)
            x[mine] = which[x[mine] - rare] + len(count)
        below = np.concatenate([count, np.zeros(len(other), count.dtype)])
        if told.num_rows:
            at, there = found(other, told.column("h").to_numpy().view(np.uint64))
            below[len(count) + at[there]] = told.column("c").to_numpy()[there]
        for start, c in other_counts:
            below[len(count) + which[start : start + len(c)]] = c
        below = np.where(below >= least_count, below * word_share, 0.0)
        counted_pairs = None
        if followers:
            counted_pairs = np.zeros(len(below), np.int64), of_pairs.column("block")[0].as_py()
            for x, n in followers:
                counted_pairs[0][x] = n
        # Contexts end where a word is missing.
        for k in range(2, max_depth + 1):
            w[k][w[k - 1] == 0] = 0
        value = text_values(w, doc, np.concatenate(held) == 0, below, max_depth, least_count, least_bits, weight, at_once, counted_pairs)
        ends = np.cumsum([len(x) for x in rows])
        sums = [packed([x, *two_halves(value[e - len(x) : e].view(np.uint64))]) for x, e in zip(rows, ends)]
        given = pa.table({"block": table.column("block"), "docs": table.column("docs"), "data": pa.array(sums, pa.binary())})
        none = [pa.array(np.full(len(x), k)) for x, k in ((back, True), (given, False))]
        return pa.concat_tables([x.append_column("of_keys", k) for x, k in zip((back, given), none)])

    def add(table: pa.Table) -> pa.Table:
        keys, sums = None, None
        for of_keys in (True, False):
            some = table.filter(pa.array(np.asarray(table.column("of_keys")) == of_keys))
            for docs, data in zip(some.column("docs").to_pylist(), some.column("data"), strict=True):
                if of_keys:
                    high, low = unpacked(data.as_buffer(), [docs] * 2)
                    keys, sums = high.astype(np.uint64) << np.uint64(32) | low, np.zeros(docs)
                else:
                    row, high, low = unpacked(data.as_buffer(), [docs] * 3)
                    sums[np.cumsum(row, dtype=np.int64)] += (high.astype(np.uint64) << np.uint64(32) | low).view(np.float64)
        return pa.table({"key": _signed(keys), "more": pa.array(sums)})

    dealt = texts.mapInArrow(deal, DEALT)
    if len(split[0]):
        dealt = dealt.unionByName(pairs.mapInArrow(tell, DEALT))
    if not whole:
        asked = texts.mapInArrow(ask, "part int, h long").distinct().join(vocab.filter(F.col("c") >= least_count).select("h", "c"), "h")
        dealt = dealt.unionByName(asked, allowMissingColumns=True)
    sums = dealt.groupBy("part").applyInArrow(give, "block long, docs int, data binary, of_keys boolean")
    return sums.groupBy("block").applyInArrow(add, "key long, more double").groupBy("key").agg(F.sum("more").alias("more"))


def text_scores(
    docs: DataFrame,
    max_depth: int = 3,
    least_count: int = 2,
    least_bits: float = 0.1,
    weight: float = 2.0,
    hot_share: float = 5e-7,
    most_alike: int = 2_500_000,
    part_tokens: int = 1_000_000,
    at_once: int = 200_000,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Tokens are words (A-Z lowered) and one end. Rows whose id's crc32 as text is 2 modulo 7 are held out; the others
    train. `base_score` is the add-one unigram log10 probability. `score` is that of a suffix tree: a token is
    predicted from the longest kept run of at most `max_depth` tokens before it. A context is kept if its next-token
    distribution diverges from that of its suffix by `least_bits`, or if a longer kept one ends in it; it gives what
    follows it `least_count` times or more in the training texts, and leaves the rest, with the weight of `weight`
    tokens, to its suffix. Without context a token has its share of the training tokens, less what the ones seen once
    say about unseen ones; as in the base score, all tokens outside the training texts are one event.

    Contexts that end in the same word make one part of the tree. Words of up to `most_alike` occurrences are dealt out
    to parts of about `part_tokens` places, which count and score them (`context_scores`), `at_once` places at a time if
    they are behind different words. More frequent words have several parts, by the word before them, if they are kept
    on their own account and stand behind no word more than `most_alike` times (`kept_words`). For
    others the tree is a table (`tree`): runs above `hot_share` of all tokens for each order are looked up where the
    texts are, the rest in a join. So are words, of which 1 / hot_share at most are looked up; if
    those are all that occur twice, any other has its only place where it is met. A null or empty text has
    the end alone; a null id trains; repeated rows each train and get a row; no documents give no rows; other columns
    are not read. Words and texts are told apart by 64-bit hashes.
    """
    held = F.coalesce(fold_of(F.col("doc_id"), 7) == 2, F.lit(False))
    picked = pick(docs, "doc_id", "text").withColumn("held_out", held)
    # Texts are known again by what they say, whatever the order in which they are read a second time.
    picked = picked.withColumn("key", F.xxhash64(F.coalesce("text", F.lit(""))))
    texts = picked.select("text", "held_out")
    vocab = settled(counted_words(texts), "vocabulary")
    sums = vocab.agg(F.sum("n"), F.sum("c"), F.sum((F.col("c") > 0).cast("long")), F.sum((F.col("c") == 1).cast("long"))).first()
    n_all, n_train, n_distinct, n_once = (x or 0 for x in sums)
    unknown = (n_once + 1) / (n_train + 2)
    word_share = (1 - unknown) / max(n_train, 1)
    # The smallest count of which there are not too many words.
    least_known, n_words = max(65.0, hot_share * n_all), 0
    for times, n in sorted(map(tuple, vocab.groupBy(F.least("n", F.lit(64))).count().collect()), reverse=True):
        n_words += n
        if n_words > 1 / hot_share:
            break
        least_known = float(times)
    least_known = least_known if least_known > 2 else 2.0
    common = vocab.filter((F.col("n") > most_alike) & (F.col("h") != int(END))).select("h").toArrow().column("h").to_numpy()
    common = np.sort(common.view(np.uint64))
    split, pairs = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)), None
    if len(common):
        split, pairs = kept_words(texts, vocab, common, word_share, least_count, least_bits, weight, most_alike)
        common = common[~found(split[0], common)[1]]
    if len(common):
        runs = tree(texts, vocab, common, word_share, max_depth, least_count, least_bits, weight)
    else:
        runs = empty_frame(docs.sparkSession, T._parse_datatype_string("h long, ord int, n long, own double"))

    base = F.log10((F.col("c") + 1) / F.lit(float(n_train + n_distinct + 1)))
    plain = F.when(F.col("c") > 0, F.log10(F.col("c") * F.lit(word_share))).otherwise(F.lit(float(np.log10(unknown))))
    scored = vocab.select("h", (F.col("c") > 0).cast("long").alias("known"), base.alias("base"), plain.alias("own"))
    all_twice = least_known <= 2
    # known, base and own of words of one occurrence, in a training text or else.
    once = [(1.0, 0.0), tuple(float(np.log10((c + 1) / (n_train + n_distinct + 1))) for c in (1, 0)), (float(np.log10(word_share or 1.0)), float(np.log10(unknown)))]
    send = docs.sparkSession.sparkContext.broadcast
    hashes, counts = sorted_table(vocab.filter((F.col("n") >= least_known) | (F.col("h") == int(END))), "c")
    if not len(counts) or counts.max() < 1 << 32:
        counts = counts.astype(np.uint32)
    # Frequent words have small numbers, which take less room; those that occur too rarely have 0.
    numbers, by_count = np.zeros(len(counts), np.uint32), np.argsort(counts)[::-1]
    by_count = by_count[counts[by_count] >= least_count]
    numbers[by_count] = np.arange(1, len(by_count) + 1)
    table = send((hashes, counts, numbers)), send(np.concatenate([np.zeros(1, counts.dtype), counts[by_count]]))
    # What the tree of tables gives, if there is one, to places behind its words, to their frequent runs and to others.
    backs, runs = sorted_table(runs.filter("ord = 1"), "own"), runs.filter("ord > 1")
    hot_runs = sorted_table(runs.filter(F.col("n") >= max(1.0, hot_share * (max_depth + 1) * n_all)), "own")
    looked_at = send((backs, hot_runs, sieve(runs) if len(common) else None))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (hashes, counts, _), (back_hashes, backs), (run_hashes, run_own), stored = table[0].value, *looked_at.value
        uid = TaskContext.get().partitionId() << 40
        for batch in in_blocks(batches):
            t, n = Tokens(batch.column("text")), batch.num_rows
            by_context = np.zeros(n)
            others, owners = [], []
            for order, h in enumerate(t.runs(max_depth + 1)[1:] if len(common) else (), 2):
                place = np.flatnonzero((t.left >= order) & passes(stored, h))
                h = h[place]
                at, there = found(run_hashes, h)
                by_context += np.bincount(t.rows[place[there]], run_own[at[there]], n)
                others.append(h[~there].view(np.int64))
                owners.append(t.rows[place[~there]])
            if len(back_hashes):
                at, there = found(back_hashes, t.hashes)
                by_context += np.bincount(t.rows[there], backs[at[there]], n)
            h = t.hashes.view(np.int64)
            at, there = found(hashes, t.hashes)
            row, c = t.rows[there], counts[at[there]].astype(float)
            own = np.log10(np.where(c > 0, c * word_share, unknown))
            sums = [np.bincount(row, x, n) for x in (c > 0, np.log10((c + 1) / (n_train + n_distinct + 1)), own)]
            if all_twice:
                # What is not looked up occurs once in all: here.
                single = np.bincount(t.rows[~there], minlength=n)
                trained = ~batch.column("held_out").to_numpy(zero_copy_only=False)
                sums = [x + single * np.where(trained, *v) for x, v in zip(sums, once, strict=True)]
                there |= True
            schema = arrow_schema(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(uid, uid + n)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), batch.column("doc_id"), batch.column("held_out"),
                    batch.column("key"), pa.array(t.counts), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2] + by_context),
                ],
                schema=schema,
            )
            # Tokens that are not looked up here, and runs that may be in the tree.
            rest, row = np.concatenate([*others, h[~there]]), np.concatenate([*owners, t.rows[~there]])
            order = np.lexsort((rest, row))
            rest, row = rest[order], row[order]
            first = np.flatnonzero(np.concatenate([[True], (np.diff(rest) != 0) | (np.diff(row) != 0)])[: len(rest)])
            times = np.diff(np.concatenate([first, [len(rest)]]))
            empty = [pa.nulls(len(first), f.type) for f in list(schema)[3:]]
            yield pa.RecordBatch.from_arrays([pa.array(uid + row[first]), pa.array(rest[first]), pa.array(times), *empty], schema=schema)
            uid += n

    kind = picked.schema["doc_id"].dataType.simpleString()
    rows = picked.mapInArrow(score, f"uid long, h long, times long, doc_id {kind}, held_out boolean, key long, n_tokens long, known long, base double, own double")
    rows = settled(rows, "scores")
    whole = rows.filter("h is null").drop("h", "times")
    if len(common) or not all_twice:
        others = scored.union(runs.select("h", F.lit(0).cast("long"), F.lit(0.0), "own"))
        looked_up = rows.filter("h is not null").select("uid", "h", "times").join(others, "h")
        rest = looked_up.groupBy("uid").agg(*[F.sum(F.col("times") * F.col(c)).alias(f"rest_{c}") for c in ("known", "base", "own")])
        whole = whole.join(rest, "uid", "left").fillna(0, ["rest_known"]).fillna(0.0, ["rest_base", "rest_own"])
        whole = whole.withColumns({c: F.col(c) + F.col(f"rest_{c}") for c in ("known", "base", "own")})
    # Equal texts have added up under one key.
    more = context_scores(picked.drop("doc_id"), vocab, table, common, n_all, word_share, max_depth, least_count, least_bits, weight, least_known <= least_count, part_tokens, at_once, split, pairs)
    more = more.join(rows.filter("h is null").groupBy("key").count(), "key").select("key", (F.col("more") / F.col("count")).alias("more"))
    out = whole.join(more, "key", "left").fillna(0.0, ["more"])
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        F.col("known").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        (F.col("own") + F.col("more")).alias("score"),
    )


def arrow_schema(batch: pa.RecordBatch) -> pa.Schema:
    long, double = pa.int64(), pa.float64()
    return pa.schema(
        [("uid", long), ("h", long), ("times", long), ("doc_id", batch.column("doc_id").type), ("held_out", pa.bool_()), ("key", long), ("n_tokens", long), ("known", long), ("base", double), ("own", double)]
    )
