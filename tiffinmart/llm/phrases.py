"""Phrase collocations by counts from a weighted de Bruijn graph of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffinmart.llm.frames import ascii_lower, byte_view, in_blocks, pick
from tiffinmart.llm.sieves import passes, sieve
from tiffinmart.llm.storage import dropped, settled
from tiffinmart.llm.tokens import byte_values, mixed, span_hashes

#: Bytes between words, and bytes that end a piece (and a word).
BLANKS = b" \t"
ENDS = b".,;:!?\n\x0b\x0c\r"
#: Words of an edge of the graph; its nodes are one word shorter.
LONGEST = 5
#: Bytes of the hash of a word in the key of a phrase.
WIDE = 8


class Pieces:
    """Words of a column of texts: where they lie, their hash within their language, and where a piece ends."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        self.data, offsets = byte_view(texts)
        kind = np.zeros(256, np.uint8)
        kind[list(BLANKS)] = 1
        kind[list(ENDS)] = 2
        gap = kind[self.data] > 0
        edge = np.zeros(len(gap) + 1, bool)
        edge[offsets] = True
        before = np.concatenate([[True], gap[:-1]]) if len(gap) else gap
        after = np.concatenate([gap[1:], [True]]) if len(gap) else gap
        self.starts = np.flatnonzero(~gap & (before | edge[:-1]))
        self.ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
        self.rows = np.searchsorted(offsets, self.starts, "right") - 1
        stops = np.concatenate([[0], np.cumsum(kind[self.data] == 2)])
        n = len(self.starts)
        #: Whether each word is the last of its piece.
        self.last = np.ones(n, bool)
        if n:
            self.last[:-1] = (self.rows[1:] != self.rows[:-1]) | (stops[self.starts[1:]] != stops[self.ends[:-1]])
        self.langs = langs.dictionary_encode()
        if isinstance(self.langs, pa.ChunkedArray):
            self.langs = self.langs.combine_chunks()
        names, places = byte_view(self.langs.dictionary)
        seeds = span_hashes(byte_values(names), places[:-1], places[1:])
        self.lang = self.langs.indices.to_numpy(zero_copy_only=False)[self.rows]
        plain = span_hashes(byte_values(self.data), self.starts, self.ends)
        self.hashes = mixed(plain + seeds[self.lang] * np.uint64(0x9E3779B97F4A7C15))

    def told(self, at: np.ndarray) -> pa.Array:
        """The words at these places, as strings."""
        lengths = self.ends[at] - self.starts[at]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        inside = np.arange(offsets[-1]) - np.repeat(offsets[:-1], lengths)
        data = self.data[np.repeat(self.starts[at], lengths) + inside]
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        return pa.Array.from_buffers(pa.large_binary(), len(at), buffers).cast(pa.large_string()).cast(pa.string())

    def pairs(self, at: np.ndarray) -> np.ndarray:
        """Hash of the word at each place and the next one."""
        return mixed(self.hashes[at] * np.uint64(0xD1342543DE82EF95) + self.hashes[at + 1])


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def counted_words(docs: DataFrame) -> DataFrame:
    """h, lang, word and n of every word of every language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, 2 << 20):
            p = Pieces(batch.column("text"), batch.column("lang"))
            h, first, n = np.unique(p.hashes, return_index=True, return_counts=True)
            lang = pc.take(p.langs.dictionary, pa.array(p.lang[first]))
            yield pa.RecordBatch.from_arrays([_signed(h), lang, p.told(first), pa.array(n)], names=["h", "lang", "word", "n"])

    return docs.mapInArrow(count, "h long, lang string, word string, n long").groupBy("h", "lang", "word").agg(F.sum("n").alias("n"))


def counted_pairs(docs: DataFrame, frequent) -> DataFrame:
    """h and n of every pair of neighbours in a piece, if the sieve lets both words through."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, 2 << 20):
            p = Pieces(batch.column("text"), batch.column("lang"))
            known = passes(frequent.value, p.hashes)
            h, n = np.unique(p.pairs(np.flatnonzero(known[:-1] & known[1:] & ~p.last[:-1])), return_counts=True)
            yield pa.RecordBatch.from_arrays([_signed(h), pa.array(n)], names=["h", "n"])

    return docs.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def edges_and_tails(docs: DataFrame, words, pairs) -> DataFrame:
    """lang, g and w: runs of five words (edges of the graph) and the shorter ones that end a piece, with their counts.

    A piece is cut where it holds a word or a pair that no candidate can hold. g has the hashes of the words, eight
    bytes each, in order. A phrase of a cut piece occurs as often as rows start with it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, 2 << 20):
            p = Pieces(batch.column("text"), batch.column("lang"))
            known = passes(words.value, p.hashes)
            on = np.zeros(len(known), bool)  # the next word goes on with the run
            at = np.flatnonzero(known[:-1] & known[1:] & ~p.last[:-1])
            on[at] = passes(pairs.value, p.pairs(at))
            at = np.flatnonzero(known)
            lengths, going = np.ones(len(at), np.int64), on[at]
            for k in range(1, LONGEST):
                lengths[going] += 1
                going = going & on[np.minimum(at + k, len(on) - 1)]
            big = p.hashes.byteswap()  # so that the bytes of a key are in the order of their weight
            for k in range(1, LONGEST + 1):
                own = at[lengths == k]
                if len(own):
                    _, first, n = np.unique(span_hashes(p.hashes, own, own + k), return_index=True, return_counts=True)
                    own = own[first]
                    keys = np.ascontiguousarray(big[own[:, None] + np.arange(k)])
                    g = pa.Array.from_buffers(pa.binary(WIDE * k), len(own), [None, pa.py_buffer(keys)]).cast(pa.binary())
                    lang = pc.take(p.langs.dictionary, pa.array(p.lang[own]))
                    yield pa.RecordBatch.from_arrays([lang, g, pa.array(n)], names=["lang", "g", "w"])

    return docs.mapInArrow(count, "lang string, g binary, w long").groupBy("lang", "g").agg(F.sum("w").alias("w"))


def first_words(g, n: int):
    return F.substring(g, 1, WIDE * n)


def last_words(g, n: int):
    return F.substring(g, -WIDE * n, WIDE * n)


def _number(word):
    """The eight bytes of a word as a long, and back."""
    return F.conv(F.hex(word), 16, -10).cast("long")


def _bytes(number):
    return F.unhex(F.lpad(F.hex(number), 2 * WIDE, "0"))


def flow_nodes(graph: DataFrame) -> DataFrame:
    """lang, g, n and edge figures of every node (run of four words) of the graph.

    n is what flows out of the node and what ends in it. A node is `unary` if nothing begins or ends in it, one edge
    leads in and one out; `following` is then the last word of the latter."""
    inner, none = LONGEST - 1, F.lit(0).cast("long")
    edges = graph.filter(F.length("g") == WIDE * LONGEST)
    out = edges.select("lang", first_words("g", inner).alias("g"), none.alias("ins"), none.alias("flow_in"), F.lit(1).alias("outs"), F.col("w").alias("flow_out"), none.alias("end"), _number(last_words("g", 1)).alias("following"))
    into = edges.select("lang", last_words("g", inner).alias("g"), F.lit(1).cast("long"), "w", F.lit(0), none, none, F.lit(None).cast("long"))
    tails = graph.filter(F.length("g") == WIDE * inner).select("lang", "g", none, none, F.lit(0), none, "w", F.lit(None).cast("long"))
    sums = [F.sum(c).alias(c) for c in ("ins", "flow_in", "outs", "flow_out", "end")]
    nodes = out.union(into).union(tails).groupBy("lang", "g").agg(*sums, F.max("following").alias("following"))
    unary = (F.col("ins") == 1) & (F.col("outs") == 1) & (F.col("end") == 0) & (F.col("flow_in") == F.col("flow_out"))
    return nodes.select("lang", "g", (F.col("flow_out") + F.col("end")).alias("n"), unary.alias("unary"), "following")


def compacted(nodes: DataFrame, least: int) -> DataFrame:
    """g, path and size: unary nodes with a flow of `least` or more, by the unary path they lie on.

    `path` is the last node of the path and `size` the number of its nodes, all of one flow. Each round doubles the
    reach of every node and is a written table. A path has an end: a run that went round for ever would never end, and
    the node where it ends is not unary."""
    here = nodes.filter(F.col("unary") & (F.col("n") >= least))
    ahead = F.concat(last_words("g", LONGEST - 2), _bytes(F.col("following")))
    reach = settled(here.select("g", ahead.alias("to"), F.col("g").alias("path"), F.lit(1).cast("long").alias("d")), "reach")
    while True:
        jump = reach.select(F.col("g").alias("to"), F.col("to").alias("to2"), F.col("path").alias("path2"), F.col("d").alias("d2"))
        far = reach.join(jump, "to", "left")
        went = F.col("to2").isNotNull()
        new = settled(
            far.select("g", F.coalesce("to2", "to").alias("to"), F.coalesce("path2", "path").alias("path"), (F.col("d") + F.coalesce("d2", F.lit(0))).alias("d"), went.alias("went")),
            "reach",
        )
        dropped(reach)
        reach = new
        if new.filter("went").isEmpty():
            sizes = reach.groupBy("path").agg(F.max("d").alias("size"))
            return reach.select("g", "path").join(sizes, "path")


def counted_phrases(graph: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """lang, g and n of the phrases of one to five words that occur `least` times or more.

    Edges have their own count and nodes their flow. A shorter phrase is the sum of the phrases one word longer that
    start with it, and of the pieces that end in it."""
    level = nodes.select("lang", "g", "n")
    levels = [graph.filter(F.length("g") == WIDE * LONGEST).select("lang", "g", F.col("w").alias("n")), level]
    for k in range(LONGEST - 2, 0, -1):
        tails = graph.filter(F.length("g") == WIDE * k).select("lang", "g", "w")
        level = level.select("lang", first_words("g", k).alias("g"), "n").union(tails).groupBy("lang", "g").agg(F.sum("n").alias("n"))
        levels.append(level)
    out = levels[0]
    for more in levels[1:]:
        out = out.union(more)
    return out.filter(F.col("n") >= least)


def outermost(phrases: DataFrame, percent: int) -> DataFrame:
    """The phrases of two words or more that lie in no longer phrase with `percent` of their count or more.

    What holds for a longer phrase holds for the one between them, so only phrases one word longer are looked at."""
    longer = phrases.filter(F.length("g") > 2 * WIDE)
    shorter = F.explode(F.array(*[F.substring(F.col("g"), F.lit(start), F.length("g") - WIDE) for start in (1, WIDE + 1)]))
    inside = longer.select("lang", shorter.alias("g"), F.lit(None).cast("long").alias("n"), F.col("n").alias("around"))
    own = phrases.filter(F.length("g") > WIDE).select("lang", "g", "n", F.lit(None).cast("long").alias("around"))
    both = own.union(inside).groupBy("lang", "g").agg(F.max("n").alias("n"), F.max("around").alias("around"))
    return both.filter(F.col("around").isNull() | (100 * F.col("around") < percent * F.col("n"))).select("lang", "g", "n")


def scored(candidates: DataFrame, phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, g, a, l, r, n and score of every candidate, at its lowest-scoring cut."""
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = [F.struct(F.lit(k).alias("k"), first_words("g", k).alias("left"), F.substring(F.col("g"), F.lit(WIDE * k + 1), F.length("g")).alias("right")) for k in range(1, LONGEST)]
    some = F.slice(F.array(*cuts), F.lit(1), (F.length("g") / WIDE - 1).cast("int"))
    parts = candidates.select("lang", "g", F.col("n").alias("a"), F.explode(some).alias("cut")).select("lang", "g", "a", "cut.*")
    parts = parts.join(phrases.select(F.col("g").alias("left"), F.col("n").alias("l")), "left")
    parts = parts.join(phrases.select(F.col("g").alias("right"), F.col("n").alias("r")), "right").join(totals, "lang")
    # Products have up to 38 digits: exact while a * n stays below 10^34 and l * r below 10^38.
    up, down = whole("a") * whole("n") * F.lit(1000).cast("decimal(4,0)"), whole("l") * whole("r")
    score = F.call_function("div", up, down)
    return parts.groupBy("lang", "g", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")).select("lang", "g", "a", "n", "best.*")


def ranked(found: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """`found` with phrase and rank: the first `top` of each language. Phrases are written out, to tell ties apart, only
    for those that can be among them."""
    best = [F.desc("score"), F.desc("a")]
    # First within parts of a language, so that no task sorts a whole one.
    near = found.withColumn("part", F.pmod(F.xxhash64("g"), F.lit(64))).withColumn("place", F.rank().over(Window.partitionBy("lang", "part").orderBy(*best)))
    near = near.filter(F.col("place") <= top).withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("place") <= top)
    near = near.drop("part", "place")
    at = F.sequence(F.lit(0), (F.length("g") / WIDE - 1).cast("int"))
    places = near.select("g", F.posexplode(F.transform(at, lambda i: F.substring(F.col("g"), i * WIDE + 1, F.lit(WIDE)))).alias("i", "h"))
    spelt = places.join(words.select(_bytes(F.col("h")).alias("h"), "word"), "h").groupBy("g").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("ws"))
    spelt = spelt.select("g", F.array_join(F.col("ws.word"), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(*best, "phrase")
    return near.join(spelt, "g").withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, percent: int = 100) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score and path_words of the first `top` phrases of each language.

    Texts (A-Z lowered) are cut into pieces at `.,;:!?` and line breaks, and these into words at spaces and tabs. All
    counts are per language: n of all words, a of a phrase within pieces, overlaps included. A phrase of two to five
    words with a >= `least` scores floor(1000 * a * n / (l * r)) at its lowest cut into two phrases with counts l and
    r, the first of equal ones. Phrases inside a longer one that has `percent` of their count or more are dropped.
    Order: score and a descending, then phrase by its bytes. `path_words` is the number of words of the longest run
    that has no branch at the phrase (five words of a phrase that stands alone, its own length for a shorter one).
    A null or empty text has no words; a null language is `und`; repeated rows each count; no documents give no rows;
    other columns are not read. Words are told apart by 64-bit hashes.

    Counts come from a graph whose edges are runs of five words and whose nodes are runs of four. Pieces are first cut
    at words and at pairs of words that occur less than `least` times, which no candidate can hold: two sieves of 16 MB
    know them (a full sieve lets more through and changes no result). Words of the sieves are counted in passes of
    their own, phrases only by the graph.
    """
    spark = docs.sparkSession
    texts = pick(docs, "text", "lang").select(ascii_lower(F.coalesce("text", F.lit(""))).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    vocabulary = settled(counted_words(texts), "vocabulary")
    words = vocabulary.filter(F.col("n") >= least)
    known = spark.sparkContext.broadcast(sieve(words))
    frequent = settled(counted_pairs(texts, known).filter(F.col("n") >= least), "pairs")
    pairs = spark.sparkContext.broadcast(sieve(frequent))
    dropped(frequent)
    graph = settled(edges_and_tails(texts, known, pairs), "graph")
    nodes = settled(flow_nodes(graph), "nodes")
    paths = compacted(nodes, least)
    phrases = settled(counted_phrases(graph, nodes, least), "phrases")
    totals = vocabulary.groupBy("lang").agg(F.sum("n").alias("n"))
    if totals.count() <= 10_000:
        totals = F.broadcast(totals)
    found = scored(outermost(phrases, percent), phrases, totals)
    out = ranked(found, words, top)
    # An edge of five words lies on the path of its first or its last node.
    inner = LONGEST - 1
    for side, node in (("first", first_words), ("last", last_words)):
        sizes = paths.select(F.col("g").alias(side), F.col("size").alias(f"{side}_size"))
        out = out.withColumn(side, F.when(F.length("g") == WIDE * LONGEST, node("g", inner))).join(sizes, side, "left")
    size = F.coalesce("first_size", "last_size", F.lit(0))
    long = F.when(F.length("g") == WIDE * LONGEST, size + LONGEST).otherwise((F.length("g") / WIDE).cast("long"))
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", long.alias("path_words"))
