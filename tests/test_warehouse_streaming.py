import landing as L
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tiffinmart import entities
from tiffinmart.operators.changes import change_feed
from tiffinmart.plans.warehouse import Warehouse
from tiffinmart.sources.csv_stage import read_stage, scan_csv
from tiffinmart.streaming.incremental import append_stage_batch, run_incremental, stream_csv

DAY1, DAY2 = "2024-01-10 00:00:00", "2024-01-11 00:00:00"


def first_day(land):
    L.put(land / "location/initial", "a.csv", "location", L.location("1"), L.location("2", state="Atlantis"))
    L.put(land / "restaurant/initial", "a.csv", "restaurant", L.restaurant("1"))
    L.put(land / "customer/initial", "a.csv", "customer", L.customer("1"), L.customer("2"))
    L.put(
        land / "customer_address/initial", "a.csv", "customer_address",
        L.address("11", "1"), L.address("12", "1"), L.address("21", "2"),
    )
    L.put(land / "menu/initial", "a.csv", "menu", L.menu("1", "50.00"), L.menu("2", "free"))
    L.put(land / "delivery_agent/initial", "a.csv", "delivery_agent", L.agent("1"))
    L.put(
        land / "orders/initial", "a.csv", "orders", L.order("100", "1", "2024-01-05"), L.order("101", "1", "2024-01-06")
    )
    L.put(
        land / "delivery/initial", "a.csv", "delivery",
        L.delivery("900", "100", "11"), L.delivery("901", "101", "12", "Pending"),
    )
    L.put(
        land / "order_item/initial", "a.csv", "order_item",
        L.item("1", "100", "1", "50.00"), L.item("2", "101", "1", "50.00", quantity="2.00"),
    )


def second_day(land):
    later = {"modifieddate": "2024-01-11 00:00:00"}
    L.put(land / "menu/delta", "b.csv", "menu", L.menu("1", "60.00", **later))
    L.put(land / "customer/delta", "b.csv", "customer", L.customer("1", name="C1 new", **later), L.customer("3"))
    # Only the delivery of order 101 changes: its fact row must still be reached.
    L.put(land / "delivery/delta", "b.csv", "delivery", L.delivery("901", "101", "12", "Delivered", **later))


def load(warehouse, land, load_id, ts):
    return sum(
        warehouse.load(name, str(land / name), load_id, ts, str(land)) for name in entities.ENTITIES
    )


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    warehouse = Warehouse(spark, str(root / "tables"), buckets=3)
    first_day(root / "land")
    assert load(warehouse, root / "land", 1, DAY1) == 9
    warehouse.refresh_all(DAY1, "2024-01-31")
    before = rows(warehouse.fact(), "order_item_id", "order_id", "delivery_status", "quantity")
    second_day(root / "land")
    assert load(warehouse, root / "land", 2, DAY2) == 3
    warehouse.refresh_all(DAY2, "2024-01-31")
    return warehouse, before


def test_one_fact_row_per_item_though_the_customer_has_two_addresses(two_days):
    _, before = two_days
    assert before == [(1, 100, "Delivered", 1), (2, 101, "Pending", 2)]


def test_a_delivery_change_alone_reaches_the_fact(two_days):
    warehouse, _ = two_days
    assert rows(warehouse.fact(), "order_item_id", "delivery_status") == [(1, "Delivered"), (2, "Delivered")]


def test_fact_addresses_are_those_of_the_delivery(two_days):
    warehouse, _ = two_days
    a = warehouse.dim("customer_address").select("customer_address_hk", "address_id")
    got = warehouse.fact().join(a, F.col("customer_address_dim_key") == F.col("customer_address_hk"))
    assert rows(got, "order_id", "address_id") == [(100, 11), (101, 12)]


def test_unchanged_fact_slices_are_not_rewritten(two_days):
    warehouse, _ = two_days
    table = warehouse.fact_table()
    assert len(table.versions()) == 2
    assert all(table._entry(1)["slices"][s] == 1 for s in table.changed_slices(0, 1))


def test_dimension_versions(two_days):
    warehouse, _ = two_days
    assert rows(warehouse.dim("menu"), "menu_id", F.col("price").cast("int").alias("p"), "is_current") == [
        (1, 50, False), (1, 60, True),
    ]
    assert rows(warehouse.dim("customer").filter("is_current"), "customer_id", "name") == [
        ("1", "C1 new"), ("2", "C2"), ("3", "C3"),
    ]


def test_bad_rows_are_in_quarantine(spark, two_days):
    warehouse, _ = two_days
    q = lambda n: rows(spark.read.parquet(f"{warehouse.root}/quarantine/{n}"), "_reject_reason")
    assert q("location") == [("state_code missing",)]
    assert q("menu") == [("price missing",)]


def test_every_clean_row_traces_back_to_its_file(two_days):
    warehouse, _ = two_days
    files = {r._stg_file_name for r in warehouse.clean("customer").collect()}
    assert files == {"customer/initial/a.csv", "customer/delta/b.csv"}


def test_load_history(two_days):
    warehouse, _ = two_days
    assert rows(warehouse.history("menu", "2024-01-11 00:30:00"), "load_id", "row_count") == [(2, 1)]
    assert warehouse.history("menu", "2024-01-11 00:30:00", hours=48).count() == 2


def test_nothing_new_means_nothing_done(two_days):
    warehouse, _ = two_days
    versions = {n: warehouse.clean_table(n).version() for n in entities.ENTITIES}
    assert warehouse.refresh_clean("menu") is None
    assert warehouse.refresh_dim("menu", DAY2) is None
    assert warehouse.refresh_fact() is None
    assert versions == {n: warehouse.clean_table(n).version() for n in entities.ENTITIES}


def test_a_load_number_that_would_be_skipped_is_refused(two_days, tmp_path):
    warehouse, _ = two_days
    L.put(tmp_path, "late.csv", "menu", L.menu("9", "1.00"))
    with pytest.raises(ValueError, match="at load 2"):
        warehouse.load("menu", str(tmp_path), 2, DAY2)


def test_repeated_load_is_recognised(spark, two_days):
    warehouse, _ = two_days
    stage = read_stage(spark, "menu", warehouse.stage_path("menu"))
    assert warehouse.merge_clean("menu", stage.filter("load_id = 2"), 2) is None


def test_views_over_the_warehouse(spark, two_days):
    warehouse, _ = two_days
    warehouse.create_views()
    assert spark.sql("SELECT total_orders FROM vw_yearly_revenue_kpis").first()[0] == 2
    assert spark.sql("SELECT restaurant_name FROM vw_monthly_revenue_by_restaurant").first()[0] == "R1"


def test_fact_folder_filter(two_days):
    warehouse, _ = two_days
    assert warehouse.fact(2024, 1).count() == 2 and warehouse.fact(2023).count() == 0


def test_reference_mode_end_to_end_shows_the_known_defects(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "tables"), mode="reference", buckets=2)
    land = tmp_path / "land"
    L.put(land / "delivery_agent/initial", "a.csv", "delivery_agent", L.agent("1", rating="4.60"))
    warehouse.load("delivery_agent", str(land / "delivery_agent"), 1, DAY1, str(land))
    warehouse.refresh_clean("delivery_agent")
    assert [str(r.rating) for r in warehouse.clean("delivery_agent").collect()] == ["5.00"]
    warehouse.refresh_dim("delivery_agent", DAY1)
    # The same row again: only audit values change, yet its version is closed and none opened.
    L.put(land / "delivery_agent/delta", "b.csv", "delivery_agent", L.agent("1", rating="5.00", modifieddate="2024-01-01 00:00:00"))
    warehouse.load("delivery_agent", str(land / "delivery_agent"), 2, DAY2, str(land))
    warehouse.refresh_clean("delivery_agent")
    warehouse.refresh_dim("delivery_agent", DAY2)
    assert rows(warehouse.dim("delivery_agent"), "delivery_agent_id", "is_current") == [(1, False)]


def test_reassigned_delivery_keeps_one_fact_row_with_the_new_agent(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "tables"), buckets=2)
    land = tmp_path / "land"
    first_day(land)
    L.put(land / "delivery_agent/initial", "b.csv", "delivery_agent", L.agent("2"))
    again = L.delivery("900", "100", "11", deliveryagentid="2", modifieddate="2024-01-06 00:00:00")
    L.put(land / "delivery/initial", "b.csv", "delivery", again)
    load(warehouse, land, 1, DAY1)
    warehouse.refresh_all(DAY1, "2024-01-31")
    assert warehouse.clean("delivery").count() == 3
    agents = warehouse.dim("delivery_agent").select("delivery_agent_hk", "delivery_agent_id")
    got = warehouse.fact().join(agents, F.col("delivery_agent_dim_key") == F.col("delivery_agent_hk"))
    assert rows(got, "order_id", "delivery_agent_id") == [(100, 2), (101, 1)]


# -- streaming -----------------------------------------------------------------------------------


def test_streamed_equals_batch(spark, tmp_path):
    land = tmp_path / "land"
    batch = Warehouse(spark, str(tmp_path / "batch"), buckets=2)
    streamed = Warehouse(spark, str(tmp_path / "streamed"), buckets=2)
    for day, (ts, name) in enumerate([(DAY1, "C1"), (DAY2, "C1 new")], 1):
        stamp = {"modifieddate": f"2024-01-0{day} 00:00:00"}
        L.put(land / f"day-{day}", "c.csv", "customer", L.customer("1", name=name, **stamp), L.customer(str(day + 1), **stamp))
        batch.load("customer", str(land), day, ts, str(land))
        batch.refresh_clean("customer")
        batch.refresh_dim("customer", ts)
        run_incremental(
            streamed, "customer", str(land), str(tmp_path / "ckpt"), ts, ("clean", "dim"), root=str(land)
        )
    for get in (lambda w: w.dim("customer"), lambda w: w.clean("customer").drop("_stg_file_load_ts")):
        assert rows(get(streamed)) == rows(get(batch))


def test_one_file_per_batch_gives_the_same_table(spark, tmp_path):
    land = tmp_path / "land"
    for i in range(3):
        L.put(land, f"f{i}.csv", "customer", L.customer("1", name=f"v{i}", modifieddate=f"2024-01-0{i + 1} 00:00:00"))
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2)
    run_incremental(warehouse, "customer", str(land), str(tmp_path / "ckpt"), DAY1, ("clean",), files_per_batch=1)
    assert warehouse.clean_table("customer").versions() == [0, 1, 2]
    # Files of one landing may arrive in any order of batches; the newest change wins within a batch.
    assert warehouse.clean("customer").count() == 1


def test_files_per_batch_does_not_change_the_result(spark, tmp_path):
    land = tmp_path / "land"
    for i, (day, name) in enumerate([("09", "newest"), ("01", "old"), ("09", "newest"), ("05", "mid")]):
        L.put(land, f"f{i}.csv", "customer", L.customer("1", name=name, modifieddate=f"2024-01-{day} 00:00:00"))
    got = {}
    for n in (1, 1000):
        warehouse = Warehouse(spark, str(tmp_path / f"w{n}"), buckets=2)
        run_incremental(warehouse, "customer", str(land), str(tmp_path / f"ckpt{n}"), DAY1, files_per_batch=n, root=str(land))
        dim = warehouse.dim("customer")
        assert dim.filter("eff_start_date = eff_end_date").count() == 0
        assert dim.select("customer_hk").distinct().count() == dim.count() == 1
        got[n] = rows(warehouse.clean("customer")), rows(dim)
    assert got[1] == got[1000] and "newest" in got[1][0][0]


def test_a_replayed_micro_batch_changes_nothing(spark, tmp_path):
    land = tmp_path / "land"
    L.put(land, "a.csv", "customer", L.customer("1"), L.customer("2"))
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2)
    run_incremental(warehouse, "customer", str(land), str(tmp_path / "ckpt"), DAY1, ("clean",), root=str(land))
    version = warehouse.clean_table("customer").version()
    # A driver that died after its commit, and before Spark noted the batch as done, runs it again.
    (tmp_path / "ckpt/commits/0").unlink()
    (tmp_path / "ckpt/commits/.0.crc").unlink(missing_ok=True)
    run_incremental(warehouse, "customer", str(land), str(tmp_path / "ckpt"), DAY1, ("clean",), root=str(land))
    assert warehouse.clean_table("customer").version() == version
    assert read_stage(spark, "customer", warehouse.stage_path("customer")).count() == 2


def test_another_checkpoint_is_refused(spark, tmp_path):
    land = tmp_path / "land"
    L.put(land, "a.csv", "customer", L.customer("1"), L.customer("2"))
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2)
    run_incremental(warehouse, "customer", str(land), str(tmp_path / "ckpt"), DAY1, ("clean",), root=str(land))
    L.put(land, "b.csv", "customer", L.customer("3"))
    with pytest.raises(Exception, match="another checkpoint"):
        run_incremental(warehouse, "customer", str(land), str(tmp_path / "ckpt-2"), DAY1, ("clean",), root=str(land))
    assert read_stage(spark, "customer", warehouse.stage_path("customer")).count() == 2
    run_incremental(warehouse, "customer", str(land), str(tmp_path / "ckpt"), DAY1, ("clean",), root=str(land))
    assert warehouse.clean("customer").count() == 3


def test_orders_past_the_calendar_and_late_dimension_rows_reach_the_fact(spark, tmp_path):
    land = tmp_path / "land"
    warehouse = Warehouse(spark, str(tmp_path / "tables"), buckets=2)
    first_day(land)
    load(warehouse, land, 1, DAY1)
    warehouse.refresh_all(DAY1, "2024-01-07")
    # One order after the last day of the calendar, one whose menu entry is not there yet.
    L.put(land / "orders/late", "b.csv", "orders", L.order("102", "1", "2024-02-09"), L.order("103", "1", "2024-01-06"))
    L.put(land / "delivery/late", "b.csv", "delivery", L.delivery("902", "102", "11"), L.delivery("903", "103", "11"))
    L.put(land / "order_item/late", "b.csv", "order_item", L.item("3", "102", "1", "50.00"), L.item("4", "103", "9", "50.00"))
    load(warehouse, land, 2, DAY2)
    for name in ("orders", "delivery", "order_item"):
        warehouse.refresh_clean(name)
    warehouse.refresh_fact()
    assert rows(warehouse.fact(), "order_id") == [(100,), (101,), (102,)]
    assert str(warehouse.dates().agg(F.max("calendar_date")).first()[0]) == "2024-02-09"
    warehouse.create_views()
    assert spark.sql("SELECT sum(total_orders) FROM vw_yearly_revenue_kpis").first()[0] == 2
    L.put(land / "menu/late", "b.csv", "menu", L.menu("9", "50.00"))
    warehouse.load("menu", str(land / "menu"), 3, DAY2, str(land))
    warehouse.refresh_clean("menu")
    warehouse.refresh_dim("menu", DAY2)
    warehouse.refresh_fact()
    assert rows(warehouse.fact(), "order_id") == [(100,), (101,), (102,), (103,)]
    assert warehouse.waiting_table().read().isEmpty() and warehouse.refresh_fact() is None


def test_version_diff_is_the_net_change_between_reads(spark, tmp_path):
    """An insert and an update between two reads of the feed are one insert."""
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2)
    land = tmp_path / "land"
    for i in (1, 2):
        L.put(land, f"f{i}.csv", "customer", L.customer("1", name=f"v{i}", modifieddate=f"2024-01-0{i} 00:00:00"))
        warehouse.load("customer", str(land), i, DAY1, str(land))
        warehouse.refresh_clean("customer")
    table = warehouse.clean_table("customer")
    assert table.version() == 1
    feed = change_feed(*table.images(None, 1), ["customer_id"])
    assert rows(feed, "name", "_action", "_is_update") == [("v2", "INSERT", False)]


def test_stream_helpers_exist_for_plain_ingest(spark, tmp_path):
    land = tmp_path / "land"
    L.put(land, "a.csv", "customer", L.customer("1"))
    assert stream_csv(spark, "customer", str(land), DAY1).isStreaming
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    run_incremental(warehouse, "customer", str(land), str(tmp_path / "ckpt"), DAY1, ())
    assert not warehouse.clean_table("customer").exists()
    assert read_stage(spark, "customer", warehouse.stage_path("customer")).count() == scan_csv(spark, "customer", str(land)).count()
    assert callable(append_stage_batch)
