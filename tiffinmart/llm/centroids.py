"""Clustering around centroids in exact integers, with dot products kept and updated from round to round."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffinmart.llm.frames import pick
from tiffinmart.llm.storage import dropped, settled

#: Components beyond this give squared distances that a long may not hold.
LARGEST = 1 << 27


def whole_vectors(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """vec_id and v, the components times `scale`, rounded down, of the vectors with `size` finite components."""
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))  # noqa: E731  (a NaN is no less)
    kept = pick(vectors, "vec_id", "embedding").filter((F.size("embedding") == size) & F.forall("embedding", finite))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    too_large = F.exists("v", lambda x: F.abs(x) > LARGEST)
    checked = kept.select("vec_id", scaled.alias("v"))
    return checked.select("vec_id", F.when(too_large, F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}"))).otherwise(F.col("v")).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The `k` vectors with the smallest SHA-256 of seed and id, in this order; of one id the smaller vector first."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(named.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def assigned(state: DataFrame, changes: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """The state after the centroids moved by `changes`: dot products with them, the nearest one, and its distance.

    Only components that changed are multiplied. Each partition adds a row of sums per cluster behind its vectors
    (`sums`: count, distance and components), so that one pass gives both.
    """
    moved = [(k, np.flatnonzero(change)) for k, change in enumerate(changes)]
    moved = [(k, at, changes[k, at]) for k, at in moved if len(at)]
    norms = (centroids * centroids).sum(axis=1)
    k, size = centroids.shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, schema = np.zeros((k, size + 2), np.int64), None
        for batch in batches:
            n = batch.num_rows
            v = batch.column("v").flatten().to_numpy().reshape(n, size)
            dots = batch.column("dots").flatten().to_numpy().reshape(n, k).copy()
            for c, at, by in moved:
                dots[:, c] += v[:, at] @ by
            beyond = norms - 2 * dots  # the distance to each, less the square of the vector itself
            cluster = beyond.argmin(axis=1)  # the first of equal ones
            distance = beyond[np.arange(n), cluster] + (v * v).sum(axis=1)
            for c in range(k):
                own = cluster == c
                totals[c, 0] += own.sum()
                totals[c, 1] += distance[own].sum()
                totals[c, 2:] += v[own].sum(axis=0)
            columns = [
                batch.column("vec_id"), batch.column("v"), pa.FixedSizeListArray.from_arrays(pa.array(dots.reshape(-1)), k).cast(pa.list_(pa.int64())),
                pa.array(cluster.astype(np.int32)), pa.array(distance), pa.nulls(n, pa.list_(pa.int64())),
            ]
            out = pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "dots", "cluster", "distance", "sums"])
            schema = out.schema
            yield out
        if schema is not None:
            there = np.flatnonzero(totals[:, 0])
            columns = [pa.nulls(len(there), schema.field(i).type) for i in range(6)]
            columns[3] = pa.array(there.astype(np.int32))
            columns[5] = pa.array(totals[there].tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    kind = state.schema["vec_id"].dataType.simpleString()
    return state.select("vec_id", "v", "dots").mapInArrow(step, f"vec_id {kind}, v array<long>, dots array<long>, cluster int, distance long, sums array<long>")


def sums_of(state: DataFrame, size: int) -> dict[int, list[int]]:
    """Count, distance and components summed over each cluster: at most k rows reach the driver."""
    sums = state.filter("sums is not null").groupBy("cluster").agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(size + 2)])
    return {r["cluster"]: list(r)[1:] for r in sums.collect()}


def centroid_clusters(
    vectors: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector.

    Kept are vectors (`embedding`) with `size` components, all finite; null, shorter and longer ones give no row. They
    become whole numbers (floor of `scale` times the component), so all arithmetic is exact; a component beyond 2^27
    raises an error, since its distances need more than 64 bits. The first centroids are the `k` vectors with the
    smallest SHA-256 of `seed:vec_id` (fewer vectors: all of them); a null id counts as empty, and repeated rows and
    rows of one id each stand for themselves. A round assigns each vector to the nearest centroid, the first of equal
    ones, and moves every centroid that has vectors to the floor of their mean. No vectors give no rows; other columns
    are not read.

    A round is one pass that writes a table: each vector's dot products with all centroids, brought up to date with
    the components by which each centroid moved. Rounds in which none moves change nothing and are left out.
    """
    whole = whole_vectors(vectors, size, scale)
    kind = whole.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(whole, k, seed)
    if not len(centroids):
        none = whole.select("vec_id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")])
        return none.withColumn("centroid_sha256", F.lit("")).filter(F.lit(False))
    state = whole.select("vec_id", "v", F.array_repeat(F.lit(0).cast("long"), len(centroids)).alias("dots"))
    changes, before = centroids.copy(), None
    for left in range(rounds, -1, -1):
        stored = settled(assigned(state, changes, centroids), "assigned")
        sums, state = sums_of(stored, size), stored.filter("sums is null")
        if before is not None:
            dropped(before)
        before = stored
        moved = centroids.copy()
        for c, (n, _, *total) in sums.items():
            moved[c] = [t // n for t in total]
        changes = moved - centroids
        if not left or not changes.any():
            break
        centroids = moved
    inertia = sum(s[1] for s in sums.values())
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    told = state.sparkSession.createDataFrame([(c, s[1], inertia, digest[c]) for c, s in sums.items()], "c int, cluster_inertia long, inertia long, centroid_sha256 string")
    # At most k rows.
    out = state.join(F.broadcast(told), F.col("cluster") == F.col("c"))
    return out.select(F.col("vec_id").cast(kind), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
