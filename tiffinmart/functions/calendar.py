"""Calendar attributes of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_parts(d: Column, dow_base: int = 0) -> dict[str, Column]:
    """Year to day name, all numbers as bigint. `dow_base` is the number given to Sunday."""
    return {
        "year": F.year(d).cast("bigint"),
        "quarter": F.quarter(d).cast("bigint"),
        "month": F.month(d).cast("bigint"),
        "week": F.weekofyear(d).cast("bigint"),
        "day_of_year": F.dayofyear(d).cast("bigint"),
        "day_of_week": (F.dayofweek(d) - 1 + dow_base).cast("bigint"),
        "day_of_the_month": F.dayofmonth(d).cast("bigint"),
        "day_name": F.dayname(d),
    }


def month_label(year: Column, month: Column) -> Column:
    """Jan ... Dec."""
    return F.date_format(F.make_date(year.cast("int"), month.cast("int"), F.lit(1)), "MMM")
