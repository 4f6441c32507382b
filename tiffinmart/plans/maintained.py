"""KPIs kept up to date with the fact: aggregates by day, recomputed only for slices of the fact that changed."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiffinmart.plans.fact import LAYOUT
from tiffinmart.plans.kpis import MEASURES, _ratio
from tiffinmart.session import materialized
from tiffinmart.store import BUCKET, SnapshotTable

#: Lines of the fact that one task sorts and sums at a time.
TASK_ROWS = 500_000
#: Whose distinct orders a row counts: all of a day, those of a status, those of a status and a restaurant.
GRAINS = ("day", "status", "restaurant")


def day_aggregates(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per fact slice, grain and day: revenue, orders, items and the largest line.

    An order lies in one slice and has one day, so distinct orders of longer times and of several slices add up.
    `tasks` is the number of shuffle partitions, by default left to Spark.
    """
    place = [*LAYOUT, BUCKET, "order_date_dim_key"]
    # One shuffle, by slice and day, serves the mark of each order's first lines and the sums of all grains.
    rows = rows.select(*place, "delivery_status", F.col("restaurant_dim_key").cast("bigint").alias("restaurant_dim_key"), "order_id", "order_item_id", "subtotal")
    rows = rows.repartition(*([tasks] if tasks else []), *place)
    lines = Window.partitionBy(*place, "order_id").orderBy("delivery_status", "restaurant_dim_key")
    same = lambda c: F.col(c).eqNullSafe(F.lag(c).over(lines))
    known, begins = F.col("order_id").isNotNull(), F.row_number().over(lines) == 1
    marked = rows.withColumns({"_d": known & begins, "_s": known & (begins | ~same("delivery_status")), "_r": known & (begins | ~same("delivery_status") | ~same("restaurant_dim_key"))})
    none_s, none_r = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    status, restaurant = F.col("delivery_status"), F.col("restaurant_dim_key")
    grains = zip(GRAINS, ((none_s, none_r, "_d"), (status, none_r, "_s"), (status, restaurant, "_r")), strict=True)
    each = F.explode(F.array(*[F.struct(F.lit(g).alias("grain"), s.alias("status"), r.alias("restaurant"), F.col(n).alias("first")) for g, (s, r, n) in grains]))
    keyed = marked.select(*place, each.alias("g"), "order_item_id", "subtotal").select("*", "g.*").drop("g")
    return keyed.groupBy(*LAYOUT, BUCKET, "grain", "order_date_dim_key", "status", "restaurant").agg(
        F.sum("subtotal").cast("decimal(38,2)").alias("revenue"), F.count_if("first").alias("orders"), F.count("order_item_id").alias("items"), F.max("subtotal").alias("largest")
    ).withColumnRenamed(BUCKET, "fact_bucket")


class KpiTable:
    """Day aggregates of a fact table below `root`, by year and month. The number of the fact's version that they stand
    for is in the table's log, so a step repeated after a failure does nothing twice."""

    def __init__(self, spark: SparkSession, root: str, fact: SnapshotTable):
        self.fact = fact
        self.table = SnapshotTable(spark, root, [], 0, LAYOUT)

    def refresh(self) -> list[str]:
        """Recomputes what changed in the fact since the last refresh; returns the slices of the fact that were read."""
        done, latest = self.table.batch_id(), self.fact.version()
        if latest is None or done == latest:
            return []
        changed = self.fact.changed_slices(done, latest)
        rows = self.fact.read(latest, changed)
        # The footers of the files give the count.
        tasks = max(ceil(rows.count() / TASK_ROWS), self.table.spark.sparkContext.defaultParallelism)
        fresh = day_aggregates(self.fact.with_slices(rows), tasks)
        if not self.table.exists():
            self.table.commit(fresh, latest)
            return changed
        months = sorted({s.rsplit("/", 1)[0] for s in changed})
        # A changed slice counts by its new rows alone, whatever it was before; others of its month stay.
        gone = self.table.spark.createDataFrame([(s,) for s in changed], "slice string")
        named = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))) for c in LAYOUT], F.concat(F.lit(f"{BUCKET}="), F.col("fact_bucket")))
        kept = self.table.read(slices=months).withColumn("slice", named).join(gone, "slice", "left_anti").drop("slice")
        with materialized(kept.unionByName(fresh), "kpi-days") as rows:
            self.table.commit(rows, latest, months)
        return changed

    def kpis(self, dates: DataFrame, by: Sequence[str], status: str | None = "Delivered", restaurants: DataFrame | None = None) -> DataFrame:
        """What `revenue_kpis` gives over the fact, from the day aggregates."""
        grain = "restaurant" if restaurants is not None else "day" if status is None else "status"
        rows = self.table.read().filter(F.col("grain") == grain)
        if status is not None:
            rows = rows.filter(F.col("status") == status)
        same = (F.col("order_date_dim_key") == F.col("date_dim_hk")) & (F.col("order_year") == F.col("year")) & (F.col("order_month") == F.col("month"))
        rows = rows.join(F.broadcast(dates), same).withColumn("delivery_status", F.col("status"))
        if restaurants is not None:
            names = restaurants.select("restaurant_hk", F.col("name").alias("restaurant_name"))
            rows = rows.join(names, F.col("restaurant") == F.col("restaurant_hk"))
        sums = rows.groupBy(*by).agg(F.sum("revenue").cast("decimal(20,2)").alias("revenue"), F.sum("orders").alias("total_orders"), F.sum("items").alias("items"), F.max("largest").alias("max_order_value"))
        measures = {
            "total_revenue": F.col("revenue"),
            "avg_revenue_per_order": _ratio(F.col("revenue"), F.col("total_orders")),
            "avg_revenue_per_item": _ratio(F.col("revenue"), F.col("items")),
        }
        return sums.withColumns(measures).select(*by, *MEASURES)
