"""Calendar spine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffinmart.functions.calendar import calendar_parts
from tiffinmart.functions.keys import hash_key


def date_bounds(orders: DataFrame, date_col: str, as_of_date: str, to_newest: bool = False) -> DataFrame:
    """One row (lo, hi): the first order day and the day the spine ends, with `to_newest` the last
    order day if that is later."""
    hi = F.to_date(F.lit(as_of_date))
    if to_newest:
        hi = F.greatest(hi, F.to_date(F.max(date_col)))
    return orders.agg(F.to_date(F.min(date_col)).alias("lo"), hi.alias("hi"))


def date_dim(bounds: DataFrame, include_first: bool = True, dow_base: int = 0) -> DataFrame:
    """One row per day from `lo` to `hi` of the one-row frame `bounds`.

    `include_first=False` leaves out the first order day, as the reference's spine does.
    """
    first = F.col("lo") if include_first else F.date_add("lo", 1)
    days = bounds.filter(first <= F.col("hi")).select(
        F.explode(F.sequence(first, F.col("hi"), F.expr("interval 1 day"))).alias("calendar_date")
    )
    return with_date_parts(days, dow_base)


def with_date_parts(days: DataFrame, dow_base: int = 0) -> DataFrame:
    d = F.col("calendar_date")
    parts = calendar_parts(d, dow_base)
    return days.select(
        date_key(d).alias("date_dim_hk"), d, *[expr.alias(name) for name, expr in parts.items()]
    )


def date_key(d):
    """Key of a calendar day."""
    return hash_key([d.cast("date")])
