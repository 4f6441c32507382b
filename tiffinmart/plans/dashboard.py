"""Queries behind the revenue dashboard; each returns a small DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffinmart.functions.calendar import month_label
from tiffinmart.plans.kpis import MEASURES


def yearly(k: DataFrame) -> DataFrame:
    return k.select("year", *MEASURES).orderBy("year")


def all_years(k: DataFrame) -> DataFrame:
    """Totals over the yearly KPIs."""
    return k.agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_orders").alias("total_orders"),
        F.max("max_order_value").alias("max_order_value"),
    )


def yoy(k: DataFrame) -> DataFrame:
    """Every year with its KPI differences to the year before, NULL when that year is missing.

    A join on year - 1: a lag over the rows would compare across a gap.
    """
    before = k.select((F.col("year") + 1).alias("year"), *[F.col(m).alias(f"_prev_{m}") for m in MEASURES])
    return k.join(before, "year", "left").select(
        "year", *MEASURES, *[(F.col(m) - F.col(f"_prev_{m}")).alias(f"{m}_diff") for m in MEASURES]
    )


def monthly_rounded(k: DataFrame, year: int) -> DataFrame:
    """Revenue of each month of a year in whole units."""
    return (
        k.filter(F.col("year") == year)
        .select("month", F.round("total_revenue", 0).cast("decimal(10,0)").alias("total_revenue"))
        .orderBy("month")
    )


def monthly_trend(k: DataFrame, year: int) -> DataFrame:
    """Months of a year in calendar order with their short names."""
    return (
        k.filter(F.col("year") == year)
        .select(
            "month",
            month_label(F.col("year"), F.col("month")).alias("month_name"),
            F.round("total_revenue", 0).cast("decimal(10,0)").alias("total_revenue"),
        )
        .orderBy("month")
    )


def months_present(k: DataFrame, year: int) -> DataFrame:
    return k.filter(F.col("year") == year).select("month").distinct().orderBy("month")


def top_restaurants(k: DataFrame, year: int, month: int, n: int = 10) -> DataFrame:
    """Restaurants of a month by revenue, over all delivery statuses; ties by name, then status."""
    return (
        k.filter((F.col("year") == year) & (F.col("month") == month))
        .orderBy(F.col("total_revenue").desc(), "restaurant_name", "delivery_status")
        .select("restaurant_name", *MEASURES)
        .limit(n)
    )


def latest_period(k: DataFrame) -> DataFrame:
    """The newest year and its newest month."""
    return k.agg(F.max(F.struct("year", "month")).alias("p")).select("p.year", "p.month")
