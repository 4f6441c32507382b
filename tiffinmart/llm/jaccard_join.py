"""N-gram Jaccard join: sets of word shingles that overlap enough, by universe partition and pigeonhole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffinmart.llm.components import components
from tiffinmart.llm.frames import in_blocks, pick
from tiffinmart.llm.storage import settled
from tiffinmart.llm.tokens import mixed, shingles, words

#: Roles of a signature: others may find the set by it; the set looks for others by it.
INDEX, PROBE = 1, 2
#: A node id keeps its last two bits free for roles.
ROLES = 3
#: Segments beyond those that the bound needs, in percent.
SPARE = 15
PARITIES = tuple(f"s{i}" for i in range(16))


class Bands:
    """Size bands, and into how many segments the universe falls for each.

    Sets that link differ by a factor of 100/percent in size at most, so a set meets only its own band and the one
    below. Two linked sets of n and k elements differ in (100 - percent) * (n + k) / (100 + percent) elements at most;
    a band has more segments than the largest such number for a set in it and a larger one, so that linked sets
    agree on a whole segment, whichever of them as many as that number plus one are looked at.
    """

    def __init__(self, percent: int, largest: int):
        edges = [1]
        while edges[-1] <= largest:
            edges.append(max(edges[-1] + 1, -(-edges[-1] * 100 // percent)))
        self.percent = percent
        self.edges = np.array(edges, np.int64)
        top = self.edges[1:] - 1
        self.top = np.concatenate([top, [top[-1]]])
        self.segments = self.differ(self.top, self.top * 100 // percent) + 1
        # Some to spare: with fewer of them small segments, which many sets share, would have to be looked for.
        self.segments += self.segments * SPARE // 100

    def differ(self, n, k):
        return (100 - self.percent) * (n + k) // (100 + self.percent)

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, n, "right") - 1


def element_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles in order of text and hash, the text of each, the number of each text, and its node: a hash of
    the whole set with the role bits cleared."""
    h, rows = shingles(words(texts), size)
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])]) if len(h) else np.zeros(0, bool)
    h, rows = h[new], rows[new]
    n = np.bincount(rows, minlength=len(texts))
    total = exact_sums(rows, mixed(h + np.uint64(0x632BE59BD9B4E019)), len(texts))
    node = mixed(total + n.astype(np.uint64)) & ~np.uint64(ROLES)
    return h, rows, n, node


def exact_sums(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of uint64 values by group modulo 2^64, from exact float sums of their halves."""
    low = np.bincount(group, (values & np.uint64(0xFFFFFFFF)).astype(np.float64), n).astype(np.uint64)
    high = np.bincount(group, (values >> np.uint64(32)).astype(np.float64), n).astype(np.uint64)
    return low + (high << np.uint64(32))


def signatures(h: np.ndarray, rows: np.ndarray, n: np.ndarray, bands: Bands, below: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(signature, text, role) of sets against their own band (`below` 0) or the band below it (1).

    Every set is found by all its segments of its own band, and by segment 0 with any one element left out. It looks
    for smaller sets by as many segments as elements can differ, plus one: the largest ones, which fewest others
    share, so small segments go first where the bound leaves room. Where it would still need an empty segment,
    segment 0 stands for two, as its sets with one element less or more are looked for too.
    """
    band = bands.of(n) - below
    can = (n > 0) & (band >= 0)
    can[can] &= bands.top[band[can]] * 100 >= bands.percent * n[can]
    if below == 0:
        can = n > 0
    keep = can[rows]
    h, rows = h[keep], rows[keep]
    if not len(h):
        return
    m = np.where(can, bands.segments[np.maximum(band, 0)], 0)
    base = np.concatenate([[0], np.cumsum(m)])
    place = mixed(h ^ np.uint64(0x9FB21C651E98DF25))
    segment = base[rows] + (place % m[rows].astype(np.uint64)).astype(np.int64)
    element = mixed(h)
    total, size = exact_sums(segment, element, base[-1]), np.bincount(segment, minlength=base[-1])
    owner = np.repeat(np.arange(len(n)), m)
    number = np.arange(base[-1]) - base[owner]
    salt = mixed((band[owner].astype(np.uint64) << np.uint64(34)) + number.astype(np.uint64) * np.uint64(2))
    exact = mixed(total + salt)

    needed = bands.differ(n, np.minimum(n, bands.top[np.maximum(band, 0)])) + 1
    order = np.argsort(owner * 64 + 63 - np.minimum(size, 63), kind="stable")
    chosen = np.zeros(base[-1], bool)
    chosen[order] = (np.arange(base[-1]) - base[owner]) < needed[owner]
    # One empty segment less for a segment 0 that has elements.
    empty = np.flatnonzero(chosen & (size == 0))
    first_empty = empty[np.concatenate([[True], owner[empty][1:] != owner[empty][:-1]])] if len(empty) else empty
    traded = first_empty[size[base[owner[first_empty]]] > 0]
    chosen[traded] = False
    twofold = np.zeros(len(n), bool)
    twofold[owner[traded]] = True

    if below == 0:
        yield exact, owner, np.where(chosen, INDEX | PROBE, INDEX)
    else:
        yield exact[chosen], owner[chosen], np.full(np.count_nonzero(chosen), PROBE)
    # Segment 0 with one element left out, to be found by and to look for.
    zero = np.flatnonzero(segment == base[rows])
    at = base[rows[zero]]
    less = total[at] - element[zero]
    if below == 0:
        yield mixed(less + salt[at] + np.uint64(1)), rows[zero], np.full(len(zero), INDEX)
    looks = twofold[rows[zero]]
    yield mixed(less[looks] + salt[at[looks]]), rows[zero][looks], np.full(np.count_nonzero(looks), PROBE)
    whose = np.flatnonzero(twofold)
    yield mixed(total[base[whose]] + salt[base[whose]] + np.uint64(1)), whose, np.full(len(whose), PROBE)


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def row_key(doc_id, text):
    """Tells rows of one id apart by their texts."""
    return F.xxhash64(doc_id, text)


def set_sizes(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, key (of the row), n_shingles, node and, as 16 numbers, the parities of its elements by place modulo 1024
    of every row. Two sets differ in at least as many elements as their parities do, whatever the elements are."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches):
            h, rows, n, node = element_sets(batch.column("text"), size)
            place = rows * 1024 + (mixed(h) >> np.uint64(54)).astype(np.int64)
            odd = np.bincount(place, minlength=1024 * len(n)).reshape(len(n), 1024) & 1
            parts = np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(n.astype(np.int64)), _longs(node), *(pa.array(np.ascontiguousarray(p)) for p in parts.T)],
                names=["doc_id", "key", "n_shingles", "node", *PARITIES],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, key long, n_shingles long, node long, " + ", ".join(f"{c} long" for c in PARITIES)
    return docs.withColumn("key", row_key("doc_id", "text")).mapInArrow(measure, schema)


def signature_rows(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """sig, node (with roles in its last bits): one set of rows for the copies within a block."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches):
            h, rows, n, node = element_sets(batch.column("text"), size)
            one = np.zeros(len(n), bool)
            one[np.unique(node, return_index=True)[1]] = True
            keep = one[rows]
            n = np.where(one, n, 0)
            bands = Bands(percent, max(int(n.max(initial=1)), 1))
            for below in (0, 1):
                for sig, text, role in signatures(h[keep], rows[keep], n, bands, below):
                    if len(sig):
                        yield pa.RecordBatch.from_arrays([_longs(sig), _longs(node[text] | role.astype(np.uint64))], names=["sig", "node"])

    return docs.select("text").mapInArrow(sign, "sig long, node long")


def stored_sets(docs: DataFrame, size: int, wanted: DataFrame, most_broadcast: int) -> DataFrame:
    """node and shingles (sorted 64-bit hashes as bytes) of the wanted nodes."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches):
            h, rows, n, node = element_sets(batch.column("text"), size)
            first = np.concatenate([[0], np.cumsum(n)])
            one = np.unique(node, return_index=True)[1]
            yield pa.RecordBatch.from_arrays([_longs(node[one]), pa.array([h[first[i] : first[i + 1]].tobytes() for i in one.tolist()], pa.binary())], names=["node", "elements"])

    sets = docs.select("text").mapInArrow(collect, "node long, elements binary")
    # Ids of 8 bytes each: a list of known, small size is sent to the sets, a longer one meets them in a shuffle.
    wanted = F.broadcast(wanted) if wanted.count() <= most_broadcast else wanted
    return sets.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("elements").alias("elements"))


def may_link(x: str, y: str, percent: int):
    """Whether sizes and parities leave room for a link between the rows of two aliases."""
    n, k = F.col(f"{x}.n"), F.col(f"{y}.n")
    differ = sum((F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))) for c in PARITIES[1:]), start=F.bit_count(F.col(f"{x}.s0").bitwiseXOR(F.col(f"{y}.s0"))))
    return (differ * (100 + percent) <= (100 - percent) * (n + k)) & (F.least(n, k) * 100 >= F.greatest(n, k) * percent)


def linked(docs: DataFrame, pairs: DataFrame, percent: int, size: int, most_broadcast: int, group: int = 500) -> DataFrame:
    """The pairs (a, b) whose sets overlap enough.

    Only sets of pairs are made and moved. Each `b` brings its set to `a`, where one task holds one set at a time; an
    `a` with many partners is dealt to as many places as it has groups of partners.
    """
    pairs = settled(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    sets = settled(stored_sets(docs, size, wanted, most_broadcast), "sets")
    places = pairs.groupBy("a").agg(F.count("*").alias("n")).select("a", F.ceil(F.col("n") / group).alias("places"))
    b = sets.withColumnRenamed("node", "b")
    brought = pairs.join(places, "a").join(b, "b").select("a", F.pmod(F.xxhash64("b"), F.col("places")).alias("place"), "b", "elements")
    held = places.join(sets.withColumnRenamed("node", "a"), "a").select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("places") - 1)).alias("place"), F.lit(None).cast("long").alias("b"), "elements"
    )
    met = held.unionAll(brought).repartition("a", "place").sortWithinPartitions("a", "place", F.col("b").asc_nulls_first())

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, whose = np.zeros(0, np.uint64), None
        for batch in batches:
            found = []
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            for i, elements in enumerate(batch.column("elements")):
                other = np.frombuffer(elements.as_py(), np.uint64)
                if b[i] is None:
                    own, whose = other, a[i]
                    continue
                assert whose == a[i]
                small, large = (own, other) if len(own) <= len(other) else (other, own)
                if 100 * len(small) < percent * len(large):
                    continue
                at = np.searchsorted(large, small)
                both = int(np.count_nonzero(large[np.minimum(at, len(large) - 1)] == small))
                if 100 * both >= percent * (len(own) + len(other) - both):
                    found.append((a[i], b[i]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])

    return met.mapInArrow(verify, "a long, b long")


def _pair(x, y):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def classes(docs: DataFrame, percent: int, size: int, most_broadcast: int) -> DataFrame:
    """doc_id, key, n_shingles and comp (a number of the component; each text without words has its own) of every row."""
    docs = pick(docs, "doc_id", "text")
    sizes = settled(set_sizes(docs, size), "sizes")
    each = Window.partitionBy("sig")
    plain = F.col("node").bitwiseAND(F.lit(~ROLES))
    role = F.col("node").bitwiseAND(F.lit(ROLES)).cast("int")
    shared = signature_rows(docs, size, percent).withColumns(
        {"low": F.min(plain).over(each), "high": F.max(plain).over(each), "roles": F.max(role).over(each)}
    )
    met = shared.filter((F.col("low") != F.col("high")) & (F.col("roles") >= PROBE)).select("sig", plain.alias("node"), role.alias("role"))
    buckets = settled(met.groupBy("sig", "node").agg(F.bit_or("role").alias("role")), "buckets")
    parities = sizes.filter("n_shingles > 0").withColumnRenamed("n_shingles", "n").drop("doc_id", "key").dropDuplicates(["node"])
    parities = settled(parities.join(buckets.select("node").distinct(), "node", "left_semi"), "parities")

    counts = buckets.groupBy("sig").agg(F.count("*").alias("size"))
    shares = buckets.join(counts, "sig").groupBy("node").agg(F.sum("size").alias("shares"))
    best = buckets.join(shares, "node").groupBy("sig").agg(F.max(F.struct("shares", "node")).alias("best")).select("sig", F.col("best.node").alias("centre"))
    pairs = buckets.join(best, "sig").filter("node <> centre").select(*_pair(F.col("node"), F.col("centre"))).distinct()
    x, y = parities.alias("x"), parities.alias("y")
    pairs = pairs.join(x, F.col("a") == F.col("x.node")).join(y, (F.col("b") == F.col("y.node")) & may_link("x", "y", percent)).select("a", "b")
    links = settled(linked(docs, pairs, percent, size, most_broadcast), "links")
    comps = components(links)

    placed = buckets.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    several = placed.groupBy("sig").agg(F.min("comp").alias("least"), F.max("comp").alias("greatest"), F.count("*").alias("size"))
    several = several.filter("least <> greatest and size > 2").select("sig")
    rest = settled(placed.join(several, "sig", "left_semi").join(parities, "node"), "undecided")
    if not rest.isEmpty():
        x, y = rest.alias("x"), rest.alias("y")
        meets = (F.col("x.role").bitwiseAND(F.shiftright("y.role", 1)) + F.shiftright("x.role", 1).bitwiseAND(F.col("y.role"))) > 0
        apart = (F.col("x.node") < F.col("y.node")) & (F.col("x.comp") != F.col("y.comp"))
        more = x.join(y, (F.col("x.sig") == F.col("y.sig")) & apart & meets & may_link("x", "y", percent))
        pairs = more.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
        links = settled(links.unionAll(linked(docs, pairs, percent, size, most_broadcast)), "links")
        comps = components(links)

    named = sizes.drop(*PARITIES).join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    # Texts without words share no component, and must not meet in one place.
    return named.select("doc_id", "key", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("comp")).otherwise(F.col("key")).alias("comp"))


def jaccard_components(docs: DataFrame, percent: int = 85, size: int = 4, most_broadcast: int = 1_000_000) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: the least doc_id reachable by links.

    A text's set holds its distinct shingles of `size` words (A-Z lowered), or its whole word sequence where that is
    shorter. Texts link when 100 * |intersection| >= percent * |union|. Copies of a set are one node from the start.
    Nodes that share a signature are a bucket. First all of a bucket meet the member that shares most; then, where a
    bucket still holds several components, its nodes of different ones meet. Only pairs whose sizes and parities leave
    room for a link leave the join, to be verified exactly: no link between different texts is lost, and a group of
    copies never meets pair by pair.

    A null or empty text has no set, n_shingles 0 and itself as component. A null doc_id is never the least; the
    component of nulls alone is null. Repeated rows each get a row. No documents give no rows; other columns are not
    read. Shingles and sets are told apart by 64-bit hashes.
    """
    found = classes(docs, percent, size, most_broadcast)
    least = found.filter("n_shingles > 0").groupBy("comp").agg(F.min("doc_id").alias("least"))
    own = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return found.join(least, "comp", "left").select("doc_id", "n_shingles", own.alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = 80, size: int = 5, most_broadcast: int = 1_000_000) -> DataFrame:
    """One row of `docs` for each component, as it was: the one of least doc_id (null after all others), of several with
    that id one by a hash of the text. Of repeated rows one stays. Texts without words are no copies of each other."""
    names = list(docs.columns)
    found = classes(docs, percent, size, most_broadcast)
    first = found.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("first"))
    keep = first.select(F.col("first.key").alias("key")).distinct()
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    keyed = plain.withColumn("key", row_key(f"c{names.index('doc_id')}", f"c{names.index('text')}"))
    one = keyed.join(keep, "key", "left_semi").withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(F.lit(1))))
    return one.filter("n = 1").drop("key", "n").toDF(*names)
