import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tiffinmart.catalogue import queries
from tiffinmart.plans.fact import build_fact_changes, incremental_fact_changes, merge_fact, merge_stored_fact, single_rows
from tiffinmart.session import materialized, shuffles_released
from tiffinmart.store import SnapshotTable

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_")}


def left_over(spark, before):
    """Shuffle files that are still there a while later."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            return set()
        time.sleep(0.2)
    return shuffle_files(spark) - before


def test_stored_steps_leave_no_shuffle_files(spark, tmp_path):
    before, found = shuffle_files(spark), spark.conf.get(CLEANUP)
    # Kept, so that the driver's garbage collection has nothing to find.
    moved = spark.range(1000).withColumn("k", F.xxhash64("id")).repartition(4, "k")
    with materialized(moved.groupBy("k").count(), "counts") as counts:
        table = SnapshotTable(spark, str(tmp_path / "t"), ["k"], 2)
        table.commit(counts)
        table.commit(counts.join(moved.hint("merge"), "k").select("k", "count"))
        assert not left_over(spark, before)
        assert table.read().count() == 1000
    assert spark.conf.get(CLEANUP) == found


def test_the_setting_returns_with_the_last_of_several_blocks(spark):
    found = spark.conf.get(CLEANUP)
    one, other = shuffles_released(spark), shuffles_released(spark)
    one.__enter__()
    other.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(CLEANUP) == "true"
    with pytest.raises(ZeroDivisionError), shuffles_released(spark):
        1 / 0
    assert spark.conf.get(CLEANUP) == "true"
    other.__exit__(None, None, None)
    assert spark.conf.get(CLEANUP) == found


def test_fact_changes_are_one_per_key_without_moving_again(spark, sf_dir):
    e, dims = queries._star_inputs(spark, sf_dir, queries.dim_after_two_days, queries._DAY_0)
    ids = e["orders"].select("order_id")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changes = single_rows(incremental_fact_changes(ids, e["items"], e["orders"], e["deliveries"], dims))
        plan = changes._jdf.queryExecution().executedPlan().toString()
        assert changes.count() == build_fact_changes(e["items"], e["orders"], e["deliveries"], dims).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "Exchange hashpartitioning" in plan and "Exchange hashpartitioning(order_item_id" not in plan


def test_merge_of_stored_facts_is_the_merge(spark):
    schema = "order_item_id bigint, order_id bigint, subtotal int, order_date_dim_key bigint"
    fact = spark.createDataFrame([(i, i % 7, i, 5) for i in range(100)] + [(1, 1, -1, 5), (None, 3, 0, 5)], schema)
    new = spark.createDataFrame([(i, i % 7, i * 10, 6) for i in range(50, 150)] + [(1, 1, 7, 6), (None, 3, 9, 6)], schema)
    assert rows(merge_stored_fact(fact, new)) == rows(merge_fact(fact, new))


@pytest.mark.parametrize("name", ["warehouse_kpis", "stream_merge_fact"])
def test_landing_files_go_when_they_are_loaded(spark, sf_dir, tmp_path, monkeypatch, name):
    monkeypatch.setattr(queries, "shared_dir", lambda _, purpose: str(tmp_path / purpose))
    assert queries.QUERIES[name](spark, sf_dir).count()
    assert not list(tmp_path.rglob("landing/**/*.csv"))
    assert list(tmp_path.rglob("stage/order_item/**/*.parquet"))
