"""Data-quality checks; every check returns a small report frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffinmart import entities
from tiffinmart.entities import Entity
from tiffinmart.session import empty_frame
from tiffinmart.store import SnapshotTable


def _unpivot(row: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias(value)) for n in names])
    return row.select(F.explode(pairs).alias("p")).select("p.*")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _unpivot(counts, columns, "null_count")


def check_lengths(df: DataFrame, entity: Entity | str) -> DataFrame:
    """Values longer than the entity allows, per column."""
    limits = {f.name: f.max_len for f in entities.get(entity).fields if f.max_len}
    counts = df.agg(*[F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()])
    return _unpivot(counts, list(limits), "too_long")


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


class UniqueIndex:
    """Values of `columns` that a table holds, each with the key of its row, sliced by the values.

    A delta is checked against the slices its own values fall into; the rest of the index, and the table, stay unread.
    """

    def __init__(self, spark: SparkSession, root: str, columns: Sequence[str], key: Sequence[str], buckets: int = 64):
        self.columns, self.key = list(columns), list(key)
        self.table = SnapshotTable(spark, root, self.columns, buckets)

    def _values(self, rows: DataFrame) -> DataFrame:
        """Rows without a value in some column break no rule of uniqueness."""
        return rows.dropna(subset=self.columns).select(*self.columns, F.to_json(F.struct(*self.key)).alias("row_key"))

    def violations(self, delta: DataFrame) -> DataFrame:
        """`columns`, new_rows and stored_rows of each value of `delta` that would not be unique: held by several of its
        rows, or by a stored row of another key."""
        new = self._values(delta)
        counted = new.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("new_rows"), F.min("row_key").alias("row_key"))
        stored = self.table.read(slices=self.table.touched_slices(new)) if self.table.exists() else empty_frame(delta.sparkSession, new.schema)
        # A stored value has one row; a new row of the same key is that row once more.
        held = stored.select(*self.columns, F.col("row_key").alias("held_by"))
        both = counted.join(held, self.columns, "left")
        other = (F.col("held_by").isNotNull() & ((F.col("held_by") != F.col("row_key")) | (F.col("new_rows") > 1))).cast("bigint")
        return both.withColumn("stored_rows", other).filter((F.col("new_rows") > 1) | (F.col("stored_rows") > 0)).select(*self.columns, "new_rows", "stored_rows")

    def add(self, delta: DataFrame, batch_id: int) -> int | None:
        """Take the values of `delta` in as batch `batch_id`, the first row of each; a repeated batch does nothing."""
        done = self.table.batch_id()
        if done is not None and done >= batch_id:
            return None
        new = self._values(delta).groupBy(*self.columns).agg(F.min("row_key").alias("row_key"))
        if not self.table.exists():
            return self.table.commit(new, batch_id)
        touched = self.table.touched_slices(new)
        stored = self.table.read(slices=touched)
        return self.table.commit(stored.unionByName(new.join(stored, self.columns, "left_anti")), batch_id, touched)


def check_foreign_keys(df: DataFrame, references: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per foreign key that point nowhere; `references` maps a column to (frame, its key).

    The big side is reduced to one row per distinct value before it meets the other table, so a
    frequent value is neither shuffled in full nor joined more than once.
    """
    reports = []
    for fk, (ref, ref_key) in references.items():
        values = df.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
        known = ref.select(F.col(ref_key).alias("_value"))
        orphans = values.join(known, "_value", "left_anti")
        reports.append(
            orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows")).select(
                F.lit(fk).alias("foreign_key"), "orphan_rows"
            )
        )
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def null_rates(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Share of NULLs per column and whether it stays within its limit."""
    columns = list(limits)
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    limit = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(float(limits[c])))])
    report = _unpivot(rates, columns, "null_rate").withColumn("max_rate", limit[F.col("column_name")])
    return report.withColumn("within_limit", F.col("null_rate") <= F.col("max_rate"))


def reconcile_counts(layers: Mapping[str, DataFrame], by: Sequence[Column | str]) -> DataFrame:
    """Row counts per layer side by side, for example stage against clean per file.

    Each layer is aggregated on its own; only the counts meet.
    """
    counted = [
        df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).withColumn("layer", F.lit(name))
        for name, df in layers.items()
    ]
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    keys = [c for c in out.columns if c not in ("n", "layer")]
    return out.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("layer") == name, F.col("n"))), F.lit(0)).alias(f"{name}_rows")
            for name in layers
        ]
    )


def lineage_by_file(df: DataFrame) -> DataFrame:
    """Rows of a stage or clean table per source file."""
    return df.groupBy("_stg_file_name", "_stg_file_md5").agg(F.count(F.lit(1)).alias("row_count"))


def on_time_by_tier(deliveries: DataFrame, locations: DataFrame, location_key: str) -> DataFrame:
    """Share of deliveries within the estimate per city tier.

    `deliveries` has `location_key`, `estimated_time` as free text whose first number is minutes,
    and `actual_minutes`; rows without a number are left out. Deliveries to a location that is not in
    the table have the tier `unknown`.
    """
    estimate = F.regexp_extract("estimated_time", r"(\d+)", 1).try_cast("int")
    rows = deliveries.select(location_key, (F.col("actual_minutes") <= estimate).alias("on_time")).filter(
        F.col("on_time").isNotNull()
    )
    # Combine per location first: only one row per location meets the location table.
    per_location = rows.groupBy(location_key).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("on_time").alias("ok")
    )
    return (
        per_location.join(
            locations.select(F.col("location_id").alias(location_key), F.coalesce("city_tier", F.lit("")).alias("_tier")), location_key, "left"
        )
        .withColumn("city_tier", F.when(F.col("_tier").isNull(), "unknown").when(F.col("_tier") != "", F.col("_tier")))
        .groupBy("city_tier")
        .agg(
            F.sum("n").alias("deliveries"),
            F.sum("ok").alias("on_time"),
            (F.sum("ok") / F.sum("n")).alias("on_time_rate"),
        )
    )
