"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffinmart.llm.frames import hash_unit, kept_columns

#: A mean above this is drawn as a sum of several Poisson variables.
PART = 32.0
SPACE = 1 << 52
#: The greatest mean.
MOST = 1_000_000


def poisson_steps(mean: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... until it no longer grows in double precision."""
    p = total = math.exp(-mean)
    out, k = [total], 0
    while True:
        k += 1
        p = p * mean / k
        if total + p == total and k > mean:
            return out
        total += p
        out.append(total)


def source_rates(docs: DataFrame, weights: Mapping[str, float], other: float, epochs: float) -> dict[str | None, float]:
    """Mean repetitions of a document by source, under None that of every source without a weight.

    The result is to hold `epochs` times the bytes of all texts, split over the groups by weight. One row per
    configured source reaches the driver, so its size is that of the configuration.
    """
    group = F.when(F.col("source").isin(list(weights)), F.col("source"))
    sizes = docs.groupBy(group.alias("g")).agg(F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("n"))
    found = {r["g"]: r["n"] for r in sizes.collect()}
    wanted = {g: weights.get(g, 0.0) if g is not None else other for g, n in found.items() if n}
    total, whole = sum(found.values()), sum(wanted[g] for g in sorted(wanted, key=str))
    rates = {g: epochs * total * w / whole / found[g] for g, w in wanted.items() if w > 0}
    for g, mean in rates.items():
        if mean > MOST:
            raise ValueError(f"source {g!r} holds so little that each of its documents would be repeated {mean:.0f} times; {MOST} is the most")
    return rates


def mix_sources(
    docs: DataFrame, weights: Mapping[str, float], other: float = 0.0, epochs: float = 1.0, seed: str = "mix"
) -> DataFrame:
    """Every document repeated a Poisson number of times, so that sources meet their target weights, in random order.

    A document's count inverts the Poisson distribution of its source's mean at a uniform value hashed from seed and
    `doc_id`; it depends on nothing else and any run repeats it. Weights are shares of bytes; sources without one
    (null among them) share `other`. Returns the columns of `docs` with `copy` (1, 2, ...) and `shuffle_key`;
    partitions are consecutive ranges of `shuffle_key` and sorted by it. A null `doc_id` counts as the empty string,
    repeated rows get equal counts, groups without bytes or weight get none, no documents give no rows. Input columns
    named `copy` or `shuffle_key` are replaced. A mean above `MOST` repetitions raises an error.
    """
    spark = docs.sparkSession
    plain, inner, outer = kept_columns(docs, ("copy", "shuffle_key"))
    at = {n: F.col(c) for c, n in zip(inner, outer, strict=True)}
    rates = source_rates(plain.select(at["source"].alias("source"), at["text"].alias("text")), weights, other, epochs)

    def draw(steps, j):
        u = hash_unit(F.lit(seed), F.concat(F.lit("count"), j.cast("string")), at["doc_id"]) / F.lit(float(SPACE))
        return F.size(F.filter(steps, lambda s: s <= u))

    count = F.lit(0)
    for g, mean in sorted(rates.items(), key=lambda x: str(x[0])):
        parts = max(1, math.ceil(mean / PART))
        steps = F.array(*[F.lit(s) for s in poisson_steps(mean / parts)])
        drawn = F.aggregate(F.sequence(F.lit(0), F.lit(parts - 1)), F.lit(0), lambda n, j: n + draw(steps, j))  # noqa: B023
        named = at["source"].isin(list(weights))
        count = F.when((at["source"] == g) if g is not None else ~F.coalesce(named, F.lit(False)), drawn).otherwise(count)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    copies = plain.withColumn("n", count).filter("n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n"))))
    keyed = copies.withColumn("shuffle_key", hash_unit(F.lit(seed), F.lit("place"), at["doc_id"], F.col("copy")))
    slot = F.floor(F.col("shuffle_key") / F.lit(SPACE / n)).cast("int")
    placed = keyed.repartitionById(n, F.least(slot, F.lit(n - 1))).sortWithinPartitions("shuffle_key")
    return placed.select(*[at[o].alias(o) for o in outer], "copy", "shuffle_key")
