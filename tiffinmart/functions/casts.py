"""Text to type conversions.

`try_*` yields NULL for text that does not convert; the strict forms raise, whatever the
session's ANSI setting is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _strict(typed: Column, raw: Column, kind: str) -> Column:
    # `typed` appears once, so nesting does not multiply the generated code.
    message = F.concat(F.lit(f"not a valid {kind}: "), raw.cast("string"))
    return F.coalesce(typed, F.when(raw.isNotNull(), F.raise_error(message)))


def try_number(c: Column) -> Column:
    """Whole number, fractions rounded half up; NULL when the text is not numeric."""
    # Plain integers take the cheap path; only the rest goes through a 38-digit decimal.
    return F.coalesce(c.try_cast("bigint"), c.try_cast("decimal(38,0)").try_cast("bigint"))


def number(c: Column) -> Column:
    return _strict(try_number(c), c, "number")


def try_decimal(c: Column, precision: int, scale: int) -> Column:
    """Decimal rounded half up to `scale`; NULL on bad text or overflow."""
    return c.try_cast(f"decimal({precision},{scale})")


def decimal(c: Column, precision: int, scale: int) -> Column:
    return _strict(try_decimal(c, precision, scale), c, f"decimal({precision},{scale})")


def try_date(c: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(c, fmt)


def try_timestamp(c: Column, *formats: str) -> Column:
    """Zoned timestamp by the first format that fits, or by the default grammar without one."""
    if not formats:
        return c.try_cast("timestamp")
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def try_timestamp_ntz(c: Column, *formats: str) -> Column:
    """Like `try_timestamp`, as wall-clock time without a zone."""
    if not formats:
        return c.try_cast("timestamp_ntz")
    return try_timestamp(c, *formats).cast("timestamp_ntz")


def timestamp(c: Column, *formats: str) -> Column:
    return _strict(try_timestamp(c, *formats), c, "timestamp")


def timestamp_ntz(c: Column, *formats: str) -> Column:
    return _strict(try_timestamp_ntz(c, *formats), c, "timestamp")


def text_boolean(c: Column) -> Column:
    """true / false in any case; anything else is NULL."""
    lowered = F.lower(c)
    return F.when(lowered == "true", True).when(lowered == "false", False)
