from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tiffinmart import entities
from tiffinmart.operators.clean import clean, clean_all, quarantine_null_keys
from tiffinmart.operators.merge import (
    changed_nullsafe, changed_reference, latest_per_key, merge_upsert, replace_rows, upsert_entity,
)

SCHEMA = "id int, a string, b string"


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a1", "b1"), (2, "a2", None), (3, "a3", "b3")], SCHEMA)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(2, "A2", "B2"), (3, "a3", "b3"), (4, "A4", None)], SCHEMA)


def test_update_and_insert(target, source):
    out = merge_upsert(target, source, ["id"], ["a", "b"])
    assert rows(out) == [(1, "a1", "b1"), (2, "A2", "B2"), (3, "a3", "b3"), (4, "A4", None)]


def test_partial_update_and_insert_expressions(target, source):
    out = merge_upsert(
        target, source, ["id"], {"a": F.concat("t.a", "s.a")},
        {"id": F.col("s.id"), "a": F.lit("new")},
    )
    assert rows(out) == [(1, "a1", "b1"), (2, "a2A2", None), (3, "a3a3", "b3"), (4, "new", None)]


def test_null_condition_means_no_update(target, source):
    out = merge_upsert(target, source, ["id"], ["a", "b"], condition=F.col("t.b") != F.col("s.b"))
    assert (2, "a2", None) in rows(out)
    out = merge_upsert(target, source, ["id"], ["a", "b"], condition=changed_nullsafe(["b"]))
    assert (2, "A2", "B2") in rows(out)


def test_change_detection_flavours(spark):
    pairs = spark.sql("SELECT 1 AS id, CAST(NULL AS STRING) AS a, 'x' AS b")
    other = spark.sql("SELECT 1 AS id, 'v' AS a, 'x' AS b")
    joined = pairs.alias("t").join(other.alias("s"), F.col("t.id") == F.col("s.id"))
    assert joined.select(changed_reference(["a", "b"]), changed_nullsafe(["a", "b"])).first()[:] == (None, True)


def test_merge_twice_equals_merge_once(target, source):
    once = merge_upsert(target, source, ["id"], ["a", "b"])
    assert rows(merge_upsert(once, source, ["id"], ["a", "b"])) == rows(once)


def test_null_keys_never_match_and_are_quarantined(spark, target):
    source = spark.createDataFrame([(None, "x", "y"), (1, "z", None)], SCHEMA)
    assert merge_upsert(target, source, ["id"], ["a"]).count() == 4
    good, bad = quarantine_null_keys(source, ["id"])
    assert rows(good) == [(1, "z", None)] and rows(bad) == [(None, "x", "y")]


def test_latest_per_key_takes_newest_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [(1, 5, "old"), (1, 9, "b"), (1, 9, "a"), (2, None, "only"), (3, None, "z"), (3, 1, "c")], "k int, ts int, v string"
    )
    assert rows(latest_per_key(df, ["k"], ["ts"])) == [(1, 9, "b"), (2, None, "only"), (3, 1, "c")]


def test_latest_per_key_reduces_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS ts")
    plan = latest_per_key(df, ["k"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange", 1)[1]


AGENT = entities.DELIVERY_AGENT.source_columns


def agent(spark, *values):
    filled = [v + ("Bike", "3", "Active", "F") + r + ("2024-01-01 00:00:00", m) for v, r, m in values]
    return spark.createDataFrame(filled, ", ".join(f"{c} string" for c in AGENT))


def test_agent_name_is_kept_and_reference_insert_drops_the_fraction(spark):
    first = agent(spark, (("1", "Asha", "111"), ("4.75",), "2024-01-01 00:00:00"))
    second = agent(
        spark,
        (("1", "Renamed", "222"), ("4.35",), "2024-01-02 00:00:00"),
        (("2", "Binod", "333"), ("3.5",), "2024-01-02 00:00:00"),
    )
    t, s = clean("delivery_agent", first)[0], clean("delivery_agent", second)[0]
    cols = ("delivery_agent_id", "name", "phone", "rating")
    assert rows(upsert_entity("delivery_agent", t, s), *cols) == [
        (1, "Asha", "222", Decimal("4.35")), (2, "Binod", "333", Decimal("3.50")),
    ]
    assert rows(upsert_entity("delivery_agent", t, s, "reference"), *cols)[1][3] == Decimal("4.00")


ORDER = entities.ORDERS.source_columns


def order(spark, *values):
    return spark.createDataFrame(list(values), ", ".join(f"{c} string" for c in ORDER))


def test_order_update_keeps_keys_and_reference_mode_loses_cents(spark):
    a = order(spark, ("1", "10", "20", "2024-01-01 10:00:00", "99.50", "NEW", "card", "2024-01-01", "2024-01-01"))
    b = order(spark, ("1", "11", "21", "2024-02-02 10:00:00", "120.75", "PAID", "cash", "2024-01-01", "2024-01-02"))
    for mode, amount in (("default", Decimal("120.75")), ("reference", Decimal("121.00"))):
        out = upsert_entity("orders", clean("orders", a, mode)[0], clean("orders", b, mode)[0], mode)
        r = out.first()
        assert (r.customer_id_fk, r.restaurant_id_fk, str(r.order_date)) == (10, 20, "2024-01-01 10:00:00")
        assert (r.total_amount, r.status, r.payment_method) == (amount, "PAID", "cash")


def test_several_source_rows_per_key_leave_one(spark):
    a = order(spark, ("1", "10", "20", "2024-01-01", "1", "NEW", "x", "2024-01-01", "2024-01-01"))
    both = a.unionByName(order(spark, ("1", "10", "20", "2024-01-01", "2", "PAID", "x", "2024-01-01", "2024-01-03")))
    t = clean("orders", a)[0]
    out = upsert_entity("orders", t, clean("orders", both)[0])
    assert [(r.order_id, r.status) for r in out.collect()] == [(1, "PAID")]


LOCATION = entities.LOCATION.source_columns
CUSTOMER = entities.CUSTOMER.source_columns


def test_location_rejects_unknown_state_and_marks_the_rule(spark):
    df = spark.createDataFrame(
        [
            ("1", "Agra", "Delhi", "110001", "Yes", "2024-01-01 00:00:00", "2024-01-01 00:00:00"),
            ("2", "Agra", "Atlantis", "110001", "Yes", "2024-01-01 00:00:00", None),
            ("3", "Agra", "Goa", "12345678901", "Yes", "2024-01-01 00:00:00", None),
            (None, "Agra", "Goa", "1", "Yes", "2024-01-01 00:00:00", None),
        ],
        ", ".join(f"{c} string" for c in LOCATION),
    )
    marked = {r.location_id: r._reject_reason for r in clean_all("location", df).collect()}
    assert marked == {1: None, 2: "state_code missing", 3: "zip_code too long", None: "location_id missing"}


def test_address_reference_mode_swaps_state_and_pincode(spark):
    cols = entities.CUSTOMER_ADDRESS.source_columns
    df = spark.createDataFrame(
        [tuple("7" if c in ("addressid", "customerid") else c for c in cols)], ", ".join(f"{c} string" for c in cols)
    )
    r = clean("customer_address", df)[0].first()
    assert (r.state, r.pincode) == ("state", "pincode")
    r = clean("customer_address", df, "reference")[0].first()
    assert (r.state, r.pincode) == ("pincode", "state")


def test_customer_masks_per_mode(spark):
    cols = entities.CUSTOMER.source_columns
    base = dict.fromkeys(cols, "1")
    made = [
        tuple((base | {"customerid": str(i), "createddate": d}).values())
        for i, d in enumerate(["2024-01-01 00:00:00", "2024-01-01T00:00:00.000000"])
    ]
    df = spark.createDataFrame(made, ", ".join(f"{c} string" for c in cols))

    def parsed(mode):
        return [r.created_dt is not None for r in clean("customer", df, mode)[0].orderBy("customer_id").collect()]

    assert parsed("initial") == [True, False]
    assert parsed("reference") == [False, True]
    assert parsed("default") == [True, True]


def test_deduplicated_source_is_shuffled_once(spark, target, source):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = merge_upsert(target, latest_per_key(source, ["id"], ["a"]), ["id"], ["a"])
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_latest_rows_are_one_sort_that_the_merge_uses(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(100).selectExpr("id % 10 AS k", "id AS t", "cast(id AS string) AS v")
        single = latest_per_key(df, ["k"], ["t"])
        assert rows(single, "k", "t") == [(k, 90 + k) for k in range(10)]
        plan = merge_upsert(df.limit(0), single, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan


def test_a_stored_row_yields_only_to_a_newer_one(spark):
    def one(name, day):
        values = {"customerid": "1", "name": name, "createddate": "2024-01-01 00:00:00", "modifieddate": f"2024-01-{day} 00:00:00"}
        df = spark.createDataFrame([tuple(values.get(c) for c in CUSTOMER)], ", ".join(f"{c} string" for c in CUSTOMER))
        return clean("customer", df)[0]

    for first, second, want in ((("a", "05"), ("b", "09"), "b"), (("a", "09"), ("b", "05"), "a"), (("b", "05"), ("a", "05"), "b")):
        assert [r.name for r in upsert_entity("customer", one(*first), one(*second)).collect()] == [want]
    assert [r.name for r in upsert_entity("customer", one("a", "09"), one("b", "05"), "reference").collect()] == ["b"]


def test_location_update_keeps_its_creation_time(spark):
    def one(city, created, modified):
        df = spark.createDataFrame([("1", city, "Goa", "1", "Yes", created, modified)], ", ".join(f"{c} string" for c in LOCATION))
        return clean("location", df)[0]

    a = one("Panaji", "2024-01-01 00:00:00", "2024-01-01 00:00:00")
    b = one("Agra", "2024-06-06 00:00:00", "2024-01-02 00:00:00")
    r = upsert_entity("location", a, b).first()
    assert (r.city, r.city_tier, str(r.created_ts)) == ("Agra", "Tier-2", "2024-01-01 00:00:00")


def test_address_update_keeps_its_customer(spark):
    cols = entities.CUSTOMER_ADDRESS.source_columns

    def one(customer, floor):
        row = {c: "x" for c in cols} | {"addressid": "7", "customerid": customer, "floor": floor}
        return clean("customer_address", spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} string" for c in cols)))[0]

    r = upsert_entity("customer_address", one("1", "2"), one("9", "3")).first()
    assert (r.customer_id_fk, r.floor) == (1, "3")


def test_composite_keys_of_the_event_entities():
    """Stated once more by hand: a wrong key or update list in the configuration must not pass."""
    assert entities.DELIVERY.key == ("delivery_id", "order_id_fk", "delivery_agent_id_fk")
    assert entities.ORDER_ITEM.key == ("order_item_id", "order_id_fk", "menu_id_fk")
    business = {n: set(e.update_columns) - set(entities.AUDIT) for n, e in entities.ENTITIES.items()}
    assert business["orders"] == {"total_amount", "status", "payment_method", "modified_dt"}
    assert business["delivery_agent"] == {
        "phone", "vehicle_type", "location_id_fk", "status", "gender", "rating", "created_dt", "modified_dt",
    }
    assert business["order_item"] == {"quantity", "price", "subtotal", "created_dt", "modified_dt"}
    assert "created_ts" not in business["location"] and "customer_id_fk" not in business["customer_address"]
    for name in ("restaurant", "customer", "menu"):
        assert business[name] == set(entities.get(name).columns) - set(entities.get(name).key)


def test_replaced_rows_are_those_of_a_merge(spark):
    # Keys that repeat in the target, keys with a NULL on both sides, a source of another type.
    schema = "a int, b int, v string, w bigint"
    target = spark.createDataFrame([(1, 1, "x", 1), (1, 1, "y", 2), (2, 1, None, 3), (3, None, "n", 4), (3, None, "m", 5), (4, 4, "k", 6)], schema)
    source = spark.createDataFrame([(1, 1, None, 10), (2, 1, "s", None), (3, None, "new", 30), (None, None, "new", 40), (5, 5, "i", 50)], "a int, b int, v string, w int")
    got, want = replace_rows(target, source, ["a", "b"]), merge_upsert(target, source, ["a", "b"], ["v", "w"])
    assert got.dtypes == want.dtypes
    assert rows(got) == rows(want) and got.count() == 9
    assert rows(replace_rows(target.filter("false"), source, ["a", "b"])) == rows(source)
    assert rows(replace_rows(target, source.filter("false"), ["a", "b"])) == rows(target)
