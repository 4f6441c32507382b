import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tiffinmart.catalogue import queries
from tiffinmart.operators.sequence import add_sequence
from tiffinmart.operators.skew import skew_join
from tiffinmart.plans import dashboard, kpis
from tiffinmart.plans.date_dim import with_date_parts
from tiffinmart.plans.fact import FACT_COLUMNS, _sent, build_fact_changes, merge_fact, write_fact_by_month

D = Decimal


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def dates(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2022-12-30', DATE'2024-12-31', interval 1 day)) AS calendar_date")
    return with_date_parts(days)


def sales(spark, dates, *data):
    """(item, order, day, subtotal, status, restaurant)"""
    df = spark.createDataFrame(
        [(i, o, dt.date.fromisoformat(d), D(s), st, r) for i, o, d, s, st, r in data],
        "order_item_id bigint, order_id bigint, day date, subtotal decimal(10,2), delivery_status string, restaurant_dim_key bigint",
    )
    keys = dates.select(F.col("calendar_date").alias("day"), F.col("date_dim_hk").alias("order_date_dim_key"))
    return df.join(keys, "day").drop("day")


@pytest.fixture(scope="module")
def facts(spark, dates):
    return sales(
        spark, dates,
        (1, 10, "2022-12-31", "10.00", "Delivered", 1),
        (2, 10, "2022-12-31", "5.01", "Delivered", 1),
        (3, 11, "2024-02-01", "7.00", "Delivered", 2),
        (4, 12, "2024-02-02", "8.00", "Cancelled", 2),
        (5, 13, "2024-03-01", "1.00", "Delivered", 1),
    )


def test_yearly_and_daily(facts, dates):
    assert rows(kpis.yearly_kpis(facts, dates)) == [
        (2022, D("15.01"), 1, D("15.01"), D("7.51"), D("10.00")),
        (2024, D("8.00"), 2, D("4.00"), D("4.00"), D("7.00")),
    ]
    assert rows(kpis.daily_kpis(facts, dates), "year", "month", "day", "total_orders") == [
        (2022, 12, 31, 1), (2024, 2, 1, 1), (2024, 3, 1, 1),
    ]


def test_weekday_counts_all_statuses_unless_told(facts, dates):
    assert ("Fri", 1) in rows(kpis.weekday_kpis(facts, dates), "day_name", "total_orders")
    assert kpis.weekday_kpis(facts, dates, delivered_only=True).filter("month = 2").count() == 1


def test_namesake_restaurants_merge_and_split_by_status(spark, facts, dates):
    names = spark.createDataFrame([(1, "Spice"), (2, "Spice")], "restaurant_hk bigint, name string")
    k = kpis.monthly_restaurant_kpis(facts, dates, names)
    assert rows(k.filter("month = 2"), "delivery_status", "restaurant_name", "total_revenue") == [
        ("Cancelled", "Spice", D("8.00")), ("Delivered", "Spice", D("7.00")),
    ]
    top = dashboard.top_restaurants(k, 2024, 2)
    assert [r.total_revenue for r in top.collect()] == [D("8.00"), D("7.00")]
    assert "TakeOrderedAndProject" in plan(top)
    assert [r.month for r in dashboard.months_present(k, 2024).collect()] == [2, 3]


def test_dashboard_over_years_with_a_gap(facts, dates):
    k = kpis.yearly_kpis(facts, dates)
    assert dashboard.all_years(k).first()[:] == (D("23.01"), 3, D("10.00"))
    assert rows(dashboard.yoy(k), "year", "total_revenue_diff") == [(2022, None), (2024, None)]
    months = kpis.monthly_kpis(facts, dates)
    assert dashboard.latest_period(months).first()[:] == (2024, 3)
    assert [tuple(r) for r in dashboard.monthly_trend(months, 2024).collect()] == [(2, "Feb", D("7")), (3, "Mar", D("1"))]
    assert [tuple(r) for r in dashboard.monthly_rounded(months, 2022).collect()] == [(12, D("15"))]


def test_views_are_named(spark, facts, dates):
    names = spark.createDataFrame([(1, "A"), (2, "B")], "restaurant_hk bigint, name string")
    kpis.create_views(facts, dates, names)
    assert spark.sql("SELECT sum(total_orders) FROM vw_yearly_revenue_kpis").first()[0] == 3
    assert spark.table("vw_monthly_revenue_by_restaurant").count() == 4


def test_kpi_plan_filters_at_the_scan_and_reads_few_columns(spark, facts, dates, tmp_path):
    wide = facts.select("*", *[F.lit(0).alias(c) for c in FACT_COLUMNS if c not in facts.columns])
    wide.write.parquet(str(tmp_path / "f"))
    text = plan(kpis.yearly_kpis(spark.read.parquet(str(tmp_path / "f")), dates))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "EqualTo(delivery_status,Delivered)" in scan
    assert "quantity" not in scan and "menu_dim_key" not in scan
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_fact_layout_prunes_months(spark, tmp_path):
    df = spark.sql("SELECT id, id AS order_date_dim_key, 2024 AS order_year, CAST(id % 3 AS INT) AS order_month FROM range(30)")
    write_fact_by_month(df, str(tmp_path / "f"))
    back = spark.read.parquet(str(tmp_path / "f"))
    assert back.count() == 30
    march = back.filter("order_year = 2024 AND order_month = 2")
    assert march.count() == 10
    assert "PartitionFilters: [isnotnull(order_year" in plan(march)


def test_merge_fact_overwrites_by_item_and_order(spark):
    def fact(*data):
        df = spark.createDataFrame(list(data), "order_item_id bigint, order_id bigint, subtotal int, order_date_dim_key bigint")
        return df

    out = merge_fact(fact((1, 1, 5, 7), (2, 1, 6, 7)), fact((2, 1, 60, 7), (2, 2, 9, 8)))
    assert rows(out) == [(1, 1, 5, 7), (2, 1, 60, 7), (2, 2, 9, 8)]


@pytest.mark.parametrize("hot_rows", [10, 100_000])
def test_skew_join_equals_a_plain_join(spark, hot_rows):
    # A third of all rows share one key; one key has no partner, one has two.
    big = spark.sql("SELECT id AS item, CASE WHEN id % 3 = 0 THEN 0 ELSE id % 50 END AS k FROM range(900)")
    other = spark.sql("SELECT id AS k, id * 10 AS v FROM range(49) UNION ALL SELECT 7, -1")
    got, want = skew_join(big, other, "k", hot_rows), big.join(other, "k")
    assert rows(got, "item", "k", "v") == rows(want, "item", "k", "v")


def test_skew_join_spreads_the_hot_key(spark):
    big = spark.sql("SELECT id AS item, 1 AS k FROM range(4000)")
    other = spark.sql("SELECT 1 AS k, 'x' AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = skew_join(big, other, "k", 100).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2500


def test_sequence_is_dense_and_ordered(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1009 AS k", "id")
    out = add_sequence(df, ["k"], start=501).orderBy("k").collect()
    assert [r.sk for r in out] == list(range(501, 1501))


def test_sequence_of_nothing(spark):
    assert add_sequence(spark.range(0), ["id"]).count() == 0


def test_a_filter_on_the_calendar_prunes_the_folders_of_the_fact(spark, tmp_path):
    days = with_date_parts(spark.sql("SELECT explode(sequence(date'2023-01-01', date'2024-12-31')) AS calendar_date"))
    rows_ = days.selectExpr(
        "date_dim_hk AS order_date_dim_key", "year AS order_year", "month AS order_month", "1L AS order_id", "2L AS order_item_id",
        "3L AS restaurant_dim_key", "cast(5 AS decimal(10,2)) AS subtotal", "'Delivered' AS delivery_status",
    )
    path = str(tmp_path / "fact")
    rows_.write.partitionBy("order_year", "order_month").parquet(path)
    fact = spark.read.parquet(path)
    monthly = kpis.monthly_kpis(fact, days.filter("calendar_date BETWEEN '2024-02-01' AND '2024-02-29'"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(monthly)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = text[text.index("PartitionFilters: [") :].split("PushedFilters")[0]
    assert "order_year#" in filters and "order_month#" in filters and filters.count("dynamicpruningexpression") == 2
    assert monthly.count() == 1


def test_restaurant_kpis_mark_orders_instead_of_hashing_them(spark, dates):
    names = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "restaurant_hk long, name string")
    data = [(1, 7, 1, "5"), (2, 7, 2, "6"), (3, 8, 1, None), (4, None, 1, "2"), (5, None, 2, "2"), (6, 9, 3, "4"), (None, 9, 3, "1")]
    fact = sales(spark, dates, *[(i, o, "2024-01-05", s or "0", "Delivered" if o != 8 else None, r) for i, o, r, s in data])
    got = kpis.monthly_restaurant_kpis(fact, dates, names)
    plain = fact.join(names, F.col("restaurant_dim_key") == F.col("restaurant_hk")).groupBy("delivery_status", "name").agg(F.count_distinct("order_id"), F.sum("subtotal"), F.max("subtotal"))
    assert rows(got, "delivery_status", "restaurant_name", "total_orders", "total_revenue", "max_order_value") == rows(plain)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.splitlines() if "HashAggregate" in x and "order_id" in x.split("functions=")[0]]


@pytest.mark.parametrize("mode", ["current", "reference"])
def test_items_meet_the_menu_before_the_wider_context(spark, sf_dir, mode):
    e, dims = queries._star_inputs(spark, sf_dir, queries.dim_after_two_days, queries._DAY_0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joins = [x for x in plan(build_fact_changes(e["items"], e["orders"], e["deliveries"], dims, mode)).splitlines() if "SortMergeJoin" in x]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "order_id" in joins[0] and "_menu_id" not in joins[0]


def test_merge_of_joined_facts_moves_no_row_again(spark, sf_dir):
    e, dims = queries._star_inputs(spark, sf_dir, queries.dim_after_two_days, queries._DAY_0 | {"new_items": ("order_item", 1)})
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = queries.QUERIES["merge_fact"](spark, sf_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before, changes = (build_fact_changes(e[n], e["orders"], e["deliveries"], dims) for n in ("items", "new_items"))
        moves = [x for x in plan(merge_fact(before, changes)).splitlines() if "Exchange hashpartitioning" in x]
        got = queries.QUERIES["merge_fact"](spark, sf_dir)
        # Partitions that AQE joins together or splits must still hold both sides of a key.
        assert rows(got) == rows(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert not [x for x in moves if "order_item_id" in x]
    # Orders, deliveries and items of each side; the lookups go to all tasks, once locations are with restaurants.
    assert len([x for x in moves if "_location_id" not in x]) == 6


def test_large_lookups_are_not_forced_into_broadcasts(spark):
    a, b = spark.range(3), spark.range(4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = [plan(spark.range(9).join(df, "id")) for df in _sent({"a": a, "b": b}, 3)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ["BroadcastHashJoin" in x for x in text] == [True, False]
