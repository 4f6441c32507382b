"""Equi-join that splits hot keys of the big side over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def skew_join(
    big: DataFrame, other: DataFrame, key: str, hot_rows: int = HOT_ROWS, count_on: DataFrame | None = None
) -> DataFrame:
    """Inner join on `key`. A key with n > `hot_rows` rows in `big` is cut into ceil(n / hot_rows)
    salted parts and its rows of `other` are repeated once per part.

    The list of hot keys is broadcast: it holds at most rows / `hot_rows` keys, a million even for
    10^12 rows. Counting the keys, over `count_on` or else `big`, reads one column and combines
    before it shuffles. The salt is a hash of the row, so a recomputed task salts the same way.
    """
    hot = (
        (big if count_on is None else count_on).groupBy(F.col(key).alias("_hot"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select("_hot", F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts"))
    )
    part = F.pmod(F.xxhash64(*big.columns), F.col("_parts")).cast("int")
    salted = (
        big.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
        .withColumn("_salt", F.coalesce(part, F.lit(0)))
        .drop("_hot", "_parts")
    )
    repeats = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    spread = (
        other.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
        .withColumn("_salt", repeats)
        .drop("_hot", "_parts")
    )
    return salted.join(spread, [key, "_salt"]).drop("_salt")
