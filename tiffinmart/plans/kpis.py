"""Revenue KPIs over the fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MEASURES = ("total_revenue", "total_orders", "avg_revenue_per_order", "avg_revenue_per_item", "max_order_value")


def _ratio(total: Column, count: Column) -> Column:
    # NULL instead of an error for a group whose rows all lack the counted column.
    return F.round(F.try_divide(total, count), 2).cast("decimal(21,2)")


def kpi_measures(orders: Column | None = None) -> list[Column]:
    revenue, orders = F.sum("subtotal"), F.count_distinct("order_id") if orders is None else orders
    return [
        revenue.alias("total_revenue"),
        orders.alias("total_orders"),
        _ratio(revenue, orders).alias("avg_revenue_per_order"),
        _ratio(revenue, F.count("order_item_id")).alias("avg_revenue_per_item"),
        # The largest line, not the largest order; the name is kept.
        F.max("subtotal").alias("max_order_value"),
    ]


def revenue_kpis(
    fact: DataFrame,
    dates: DataFrame,
    by: Sequence[str],
    status: str | None = "Delivered",
    restaurants: DataFrame | None = None,
) -> DataFrame:
    """KPIs by columns of the date dimension, the fact and, with `restaurants`, `restaurant_name`.

    The status filter sits below both joins. The calendar is broadcast, a row per day; the
    restaurants only if Spark finds them small. A fact with year and month columns is joined on
    them as well: where they are its folders, a filter on the calendar leaves others unread.
    """
    rows = fact if status is None else fact.filter(F.col("delivery_status") == status)
    same = F.col("order_date_dim_key") == F.col("date_dim_hk")
    for own, of_day in (("order_year", "year"), ("order_month", "month")):
        if own in fact.columns:
            same = same & (F.col(own) == F.col(of_day))
    rows = rows.join(F.broadcast(dates), same)
    if restaurants is not None:
        names = restaurants.select("restaurant_hk", F.col("name").alias("restaurant_name"))
        rows = rows.join(names, F.col("restaurant_dim_key") == F.col("restaurant_hk"))
        # Nearly each line may be of its own order and restaurant. Counting distinct orders would hold all of them with
        # their names in two hash maps of a task; a sort by order marks the first line of each, and spills.
        lines = Window.partitionBy("order_id", *by).orderBy("order_id")
        rows = rows.select(*by, "order_id", "order_item_id", "subtotal")
        rows = rows.withColumn("_first", F.col("order_id").isNotNull() & (F.row_number().over(lines) == 1))
        return rows.groupBy(*by).agg(*kpi_measures(F.count_if("_first")))
    return rows.groupBy(*by).agg(*kpi_measures())


def yearly_kpis(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return revenue_kpis(fact, dates, ["year"])


def monthly_kpis(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return revenue_kpis(fact, dates, ["year", "month"])


def daily_kpis(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return revenue_kpis(fact, dates, ["year", "month", "day_of_the_month"]).withColumnRenamed(
        "day_of_the_month", "day"
    )


def weekday_kpis(fact: DataFrame, dates: DataFrame, delivered_only: bool = False) -> DataFrame:
    """All statuses by default, as in the reference."""
    return revenue_kpis(fact, dates, ["year", "month", "day_name"], "Delivered" if delivered_only else None)


def monthly_restaurant_kpis(fact: DataFrame, dates: DataFrame, restaurants: DataFrame) -> DataFrame:
    by = ["year", "month", "delivery_status", "restaurant_name"]
    return revenue_kpis(fact, dates, by, None, restaurants)


VIEWS = {
    "vw_yearly_revenue_kpis": yearly_kpis,
    "vw_monthly_revenue_kpis": monthly_kpis,
    "vw_daily_revenue_kpis": daily_kpis,
    "vw_day_revenue_kpis": weekday_kpis,
}


def create_views(fact: DataFrame, dates: DataFrame, restaurants: DataFrame) -> None:
    """The five KPI views as temporary views of the session, computed when read."""
    for name, kpis in VIEWS.items():
        kpis(fact, dates).createOrReplaceTempView(name)
    monthly_restaurant_kpis(fact, dates, restaurants).createOrReplaceTempView("vw_monthly_revenue_by_restaurant")


def order_sketches(fact: DataFrame, precision: int = 12) -> DataFrame:
    """HyperLogLog sketches of the distinct orders of each day and status: a few KB each, whatever the rows.

    For `approximate_orders`, where an exact count would shuffle the orders of years. The relative error is about
    1.04 / sqrt(2^precision), 1.6 % by default.
    """
    return fact.groupBy("order_date_dim_key", "delivery_status").agg(F.hll_sketch_agg("order_id", F.lit(precision)).alias("orders"))


def approximate_orders(sketches: DataFrame, dates: DataFrame, by: Sequence[str], status: str | None = "Delivered") -> DataFrame:
    """`total_orders` by columns of the calendar, from united sketches. Opt-in: `revenue_kpis` counts exactly."""
    rows = sketches if status is None else sketches.filter(F.col("delivery_status") == status)
    rows = rows.join(F.broadcast(dates), F.col("order_date_dim_key") == F.col("date_dim_hk"))
    return rows.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("orders")).alias("total_orders"))
