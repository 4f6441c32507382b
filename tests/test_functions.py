import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tiffinmart.functions import casts as K
from tiffinmart.functions import places
from tiffinmart.functions.calendar import calendar_parts, month_label
from tiffinmart.functions.keys import hash_key, hash_key_text
from tiffinmart.plans.date_dim import date_bounds, date_dim


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def values(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r[1] for r in sorted(df.select("i", fn(F.col("x"))).collect())]


def test_try_number_rounds_half_up_and_tolerates(spark):
    assert values(spark, ["12", "12.5", "-3.5", " 7 ", "x", "", None], K.try_number) == [12, 13, -4, 7, None, None, None]


def test_strict_number_raises_only_on_bad_text(spark):
    assert values(spark, ["12.5", None], K.number) == [13, None]
    with pytest.raises(PySparkException, match="not a valid number: abc"):
        values(spark, ["abc"], K.number)


def test_strict_casts_do_not_depend_on_ansi_mode(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException, match="not a valid timestamp"):
            values(spark, ["yesterday"], K.timestamp_ntz)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_try_decimal_rounds_and_overflows_to_null(spark):
    assert values(spark, ["4.256", "123.4", "n/a"], lambda c: K.try_decimal(c, 4, 2)) == [Decimal("4.26"), None, None]


def test_dates_and_timestamps_by_mask(spark):
    assert values(spark, ["1990-02-03", "1990-13-03"], K.try_date) == [dt.date(1990, 2, 3), None]
    seconds = lambda c: K.try_timestamp_ntz(c, "yyyy-MM-dd HH:mm:ss")
    assert values(spark, ["2024-01-05 08:30:00", "2024-01-05T08:30:00"], seconds) == [dt.datetime(2024, 1, 5, 8, 30), None]
    nanos = lambda c: K.try_timestamp_ntz(c, "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]")
    assert values(spark, ["2024-01-05 08:30:00.123456789"], nanos) == [dt.datetime(2024, 1, 5, 8, 30, 0, 123456)]
    either = lambda c: K.try_timestamp(c, "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss")
    assert None not in values(spark, ["2024-01-05 08:30:00", "2024-01-05T08:30:00"], either)


def test_text_boolean(spark):
    assert values(spark, ["TRUE", "false", "maybe", None], K.text_boolean) == [True, False, None, None]


def test_places(spark):
    df = spark.createDataFrame(
        [("Delhi", "New Delhi"), ("Maharashtra", "Mumbai"), ("Delhi", "Delhi"), ("Atlantis", "Agra"), (None, None)],
        "state string, city string",
    )
    s, c = F.col("state"), F.col("city")
    got = df.select(
        places.state_name(s), places.state_code(s), places.is_union_territory(s), places.is_capital_city(s, c),
        places.city_tier(c),
    )
    assert [tuple(r) for r in got.collect()] == [
        ("New Delhi", "DL", True, True, "Tier-3"),
        ("Maharashtra", "MH", False, True, "Tier-1"),
        ("New Delhi", "DL", True, False, "Tier-1"),
        ("Atlantis", None, False, False, "Tier-2"),
        (None, None, False, False, "Tier-3"),
    ]


def test_reference_key_collides_and_nulls_out_safe_key_does_not(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("ab", None), (None, "ab")], "p string, q string")
    reference = [r[0] for r in df.select(hash_key(["p", "q"], "reference")).collect()]
    assert reference[0] == reference[1] and reference[2] is None and reference[3] is None
    assert len({r[0] for r in df.select(hash_key(["p", "q"])).collect()}) == 4
    assert len({r[0] for r in df.select(hash_key_text(["p", "q"])).collect()}) == 4


def test_key_by_name_equals_key_by_column(spark):
    df = spark.createDataFrame([("ab", 3), (None, 4)], "p string, q int")
    for mode in ("safe", "reference"):
        by_name, by_col = hash_key(["p", "q"], mode), hash_key([F.col("p"), F.col("q")], mode)
        assert all(r[0] == r[1] for r in df.select(by_name, by_col).collect())


def test_key_value_is_the_documented_one(spark):
    assert one(spark, hash_key([F.lit("a")], "reference")) == (607843303088085631,)


def test_unknown_key_mode(spark):
    with pytest.raises(ValueError, match="unknown key mode"):
        hash_key(["id"], "fast")


def test_calendar_parts(spark):
    d = F.lit("2027-01-01").cast("date")
    assert one(spark, *calendar_parts(d).values()) == (2027, 1, 1, 53, 1, 5, 1, "Fri")
    assert one(spark, calendar_parts(d, dow_base=1)["day_of_week"]) == (6,)
    assert one(spark, month_label(F.lit(2024), F.lit(2))) == ("Feb",)


def test_date_dim_spans_orders_and_reference_drops_first_day(spark):
    orders = spark.sql("SELECT TIMESTAMP_NTZ'2024-02-27 13:00:00' AS d UNION ALL SELECT TIMESTAMP_NTZ'2024-02-28 00:00:00'")
    bounds = date_bounds(orders, "d", "2024-03-01")
    days = [r[0] for r in rows(date_dim(bounds), "calendar_date")]
    assert days == [dt.date(2024, 2, 27), dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    assert [r[0] for r in rows(date_dim(bounds, include_first=False), "calendar_date")] == days[1:]
    later = date_bounds(orders, "d", "2024-01-01")
    assert date_dim(later).count() == 0
