"""What goes on from load to load: numbers, unique values, KPIs."""

import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tiffinmart.operators.quality import UniqueIndex
from tiffinmart.operators.sequence import append_numbered
from tiffinmart.plans import kpis
from tiffinmart.plans.fact import LAYOUT
from tiffinmart.plans.maintained import GRAINS, KpiTable, day_aggregates
from tiffinmart.store import SnapshotTable


def test_numbers_go_on_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ["k"], 4)
    load = lambda ks, batch: append_numbered(table, spark.createDataFrame([(k,) for k in ks], "k string"), ["k"], batch)
    assert load("ba", 1) == 0 and load("ba", 1) is None and table.mark("sk") == 2
    assert load("dce", 2) == 1 and load("xyz", 2) is None
    table.commit(table.read())  # marks outlive commits that don't name them
    assert load("", 3) is not None and load("f", 4) is not None
    assert rows(table.read(), "sk", "k") == [(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, "e"), (6, "f")] and table.mark("sk") == 6


def test_a_failed_batch_gives_no_numbers_out(spark, tmp_path, monkeypatch):
    table = SnapshotTable(spark, str(tmp_path / "t"), ["k"], 4)
    one = spark.createDataFrame([("a",)], "k string")
    append_numbered(table, one, ["k"], 1)
    with monkeypatch.context() as m:
        m.setattr(table, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            append_numbered(table, one.select(F.lit("b").alias("k")), ["k"], 2)
    append_numbered(table, one.select(F.lit("c").alias("k")), ["k"], 2)
    assert rows(table.read(), "sk", "k") == [(1, "a"), (2, "c")]


def test_unique_values_are_looked_up_in_few_slices(spark, tmp_path):
    index = UniqueIndex(spark, str(tmp_path / "u"), ["mail"], ["id"], 16)
    frame = lambda data: spark.createDataFrame(data, "id int, mail string")
    assert index.violations(frame([(1, "a"), (2, "a"), (3, None), (4, None)])).collect() == [("a", 2, 0)]
    index.add(frame([(i, f"m{i}") for i in range(200)] + [(500, None)]), 1)
    assert index.add(frame([(9, "other")]), 1) is None
    delta = frame([(1, "m1"), (7, "m2"), (300, "new"), (301, None)])
    found = index.violations(delta)
    assert rows(found) == [("m2", 1, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(index.table.touched_slices(delta.dropna())) <= 3 and plan.count("_bucket=") <= 3
    index.add(delta, 2)
    assert index.table.read().count() == 201 and rows(index.violations(frame([(8, "new")]))) == [("new", 1, 1)]


def _fact(spark, seed, n=300):
    r = random.Random(seed)
    data = []
    for _ in range(n):
        order = r.randint(1, 60)
        day = order % 50  # one day, restaurant and status for an order
        month, of_month = day // 28 + 1, day % 28 + 1
        amount = None if r.random() < 0.05 else r.randint(1, 10_000) / 100
        data.append((r.randint(1, 10**6), order, 2024 * 10_000 + month * 100 + of_month, order % 4, amount, "Delivered" if order % 3 else "Pending", 2024, month))
    names = "order_item_id long, order_id long, order_date_dim_key long, restaurant_dim_key long, subtotal double, delivery_status string, order_year int, order_month int"
    return spark.createDataFrame(data, names).withColumn("subtotal", F.col("subtotal").cast("decimal(10,2)"))


def test_maintained_kpis_equal_the_views_after_any_merges(spark, tmp_path):
    fact = SnapshotTable(spark, str(tmp_path / "fact"), ["order_id"], 2, LAYOUT)
    kept = KpiTable(spark, str(tmp_path / "kpis"), fact)
    assert kept.refresh() == []
    days = spark.createDataFrame([(2024 * 10_000 + m * 100 + d, 2024, m, d, ["Mon", "Tue"][d % 2]) for m in (1, 2) for d in range(1, 29)], "date_dim_hk long, year int, month int, day_of_the_month int, day_name string")
    names = spark.createDataFrame([(i, f"r{i % 2}") for i in range(4)], "restaurant_hk long, name string")
    fact.commit(_fact(spark, 1))
    assert kept.refresh() == kept.fact.changed_slices(None, 0) and kept.refresh() == []
    for step, delta in ((1, _fact(spark, 2, 40).filter("order_id % 5 = 0")), (2, _fact(spark, 3, 20).filter("order_id < 20"))):
        touched = fact.touched_slices(delta)
        stays = fact.read(slices=touched).join(delta.select("order_id").distinct(), "order_id", "left_anti")
        fact.commit(stays.unionByName(delta), replace=touched)
        if step == 1:
            continue  # two versions of the fact in one refresh
        read = kept.refresh()
        assert 0 < len(read) <= len(fact.changed_slices(None, 2))
        for by, status, of in ((["year"], "Delivered", None), (["month"], "Delivered", None), (["month", "day_name"], None, None), (["month", "delivery_status", "restaurant_name"], None, names)):
            assert rows(kept.kpis(days, by, status, of)) == rows(kpis.revenue_kpis(fact.read(), days, by, status, of))


def test_sketches_of_days_give_orders_of_longer_times(spark):
    data = spark.range(200_000).selectExpr("id % 150000 AS order_id", "20240101 + (id % 150000) % 28 AS order_date_dim_key", "'Delivered' AS delivery_status")
    days = spark.createDataFrame([(20240101 + d, 2024, 1, d + 1) for d in range(28)], "date_dim_hk long, year int, month int, day_of_the_month int")
    sketches = kpis.order_sketches(data)
    assert sketches.count() == 28
    year = kpis.approximate_orders(sketches, days, ["year"]).first().total_orders
    assert abs(year - 150_000) < 0.03 * 150_000
    for r in kpis.approximate_orders(sketches, days, ["day_of_the_month"]).collect():
        assert abs(r.total_orders - 150_000 / 28) < 0.05 * 150_000 / 28


def test_day_aggregates_shuffle_lines_once(spark):
    r = random.Random(3)
    data = [(2024, 1, r.randint(0, 1), 20240100 + r.randint(1, 3), r.choice(["x", "y", None]), r.choice([1, 2, None]), r.choice([*range(9), None]), i, Decimal(r.randint(1, 9))) for i in range(400)]
    lines = spark.createDataFrame(data, "order_year int, order_month int, _bucket int, order_date_dim_key long, delivery_status string, restaurant_dim_key long, order_id long, order_item_id long, subtotal decimal(10,2)")
    for tasks in (None, 3):
        got = day_aggregates(lines, tasks)
        sums = [F.sum("subtotal").cast("decimal(38,2)").alias("revenue"), F.count_distinct("order_id").alias("orders"), F.count("order_item_id").alias("items"), F.max("subtotal").alias("largest")]
        for grain, by in zip(GRAINS, ([], ["delivery_status"], ["delivery_status", "restaurant_dim_key"]), strict=True):
            plain = lines.groupBy("_bucket", "order_date_dim_key", *by).agg(*sums)
            shown = ["fact_bucket", "order_date_dim_key", *["status", "restaurant"][: len(by)], "revenue", "orders", "items", "largest"]
            assert rows(got.filter(F.col("grain") == grain), *shown) == rows(plain)
        assert got._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
