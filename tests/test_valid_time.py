"""Histories by the rows' own time, and joins with the version of an event's time."""

import itertools
import random

import pytest

from tiffinmart import entities
from tiffinmart.entities import Dimension
from tiffinmart.operators.valid_time import Lookup, as_of_keys, history, splice

SPEC = Dimension("hk", ("id", "name", "price"), ("name",), ("id",))
CHANGES = "id bigint, name string, price int, at timestamp_ntz, gone boolean"


def changes(spark, rows):
    return spark.createDataFrame([(i, n, p, f"2024-01-{d:02d} 00:00:00", g) for i, n, p, d, g in rows], "id bigint, name string, price int, at string, gone boolean")


def told(df):
    return sorted((tuple(r) for r in df.drop("hk").collect()), key=str), {r.hk for r in df.collect()}


def plain(rows):
    """(id, name, price, start day, end day) of each version, from all changes at once."""
    out = []
    for i in {r[0] for r in rows if r[0] is not None}:
        points = {}
        for _, n, p, d, g in (r for r in rows if r[0] == i):
            said = (g, n if n is not None else "", p if p is not None else -1)
            if d not in points or said > points[d][0]:
                points[d] = (said, None if g else (n, p))
        turns = []
        for d in sorted(points):
            state = points[d][1]
            if (turns and turns[-1][1] != state) or (not turns and state is not None):
                turns.append((d, state))
        ends = [d for d, _ in turns[1:]] + [None] * bool(turns)
        out += [(i, *s, d, e) for (d, s), e in zip(turns, ends, strict=True) if s is not None]
    return sorted(out, key=str)


def as_days(df):
    day = lambda t: t.day if t is not None else None
    return sorted(((r.id, r.name, r.price, day(r.eff_start_date), day(r.eff_end_date)) for r in df.collect()), key=str)


def spliced(spark, batches):
    from pyspark.sql import functions as F

    points = None
    for batch in batches:
        points = splice(points, changes(spark, batch), SPEC, "at", F.col("gone"))
    return history(points, SPEC)


def test_any_order_of_arrival_gives_one_history(spark):
    rows = [
        (1, "tea", 5, 3, False), (1, "tea", 7, 9, False), (1, "tea", 5, 6, False), (1, "tea", 6, 4, False), (1, None, None, 12, True), (1, "tea", 7, 14, False),
        (2, "rice", None, 5, False), (2, "rice", None, 5, False), (2, None, 1, 8, True), (3, None, None, 2, True), (None, "x", 1, 1, False),
    ]
    want = plain(rows)
    r = random.Random(2)
    for _ in range(4):
        r.shuffle(rows)
        cut = sorted(r.sample(range(1, len(rows)), 2))
        got = spliced(spark, [rows[: cut[0]], rows[cut[0] : cut[1]], rows[cut[1] :]])
        assert as_days(got) == want
    assert told(got)[0] == told(spliced(spark, [rows]))[0] and told(got)[1] == told(spliced(spark, [rows]))[1]
    assert sum(r.is_current for r in got.collect()) == 1


def test_keys_without_changes_pass_through(spark):
    points = splice(None, changes(spark, [(1, "a", 1, 1, False), (2, "b", 2, 2, False)]), SPEC, "at")
    more = splice(points, changes(spark, [(2, "b", 3, 1, False)]), SPEC, "at")
    assert as_days(history(more, SPEC)) == [(1, "a", 1, 1, None), (2, "b", 2, 2, None), (2, "b", 3, 1, 2)]
    assert splice(points, changes(spark, []), SPEC, "at").count() == 2


@pytest.mark.parametrize("hot_rows", [3, 1_000_000])
def test_every_event_takes_the_version_of_its_time(spark, hot_rows):
    r = random.Random(4)
    rows = [(i, f"n{i}", r.randint(1, 5), d, r.random() < 0.2) for i in range(6) for d in sorted(r.sample(range(2, 20), 4))]
    dim = spliced(spark, [rows]).cache()
    versions = [(v.id, v.eff_start_date, v.eff_end_date, v.hk, v.price) for v in dim.collect()]
    # Id 0 is hot; some events repeat, some lie before all versions or have no id.
    events = [(n // 2, r.choice([0, 0, 0, *range(8), None]), r.choice([0, *range(6)]), f"2024-01-{r.randint(1, 25):02d} 00:00:00") for n in range(120)]
    df = spark.createDataFrame(events, "ev bigint, a bigint, b bigint, t string").selectExpr("ev", "a", "b", "CAST(t AS timestamp) AS t")
    got = as_of_keys(df, "t", {"ka": Lookup("a", dim, SPEC, "price"), "kb": Lookup("b", dim, SPEC)}, hot_rows)

    def at(i, t):
        return [(k, p) for j, s, e, k, p in versions if j == i and s <= t and (e is None or t < e)]

    want = [(e, a, b, t, x[0], y[0], x[1]) for e, a, b, t in map(tuple, df.collect()) for x, y in itertools.product(at(a, t), at(b, t))]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and want
    one = as_of_keys(df, "t", {"ka": Lookup("a", dim, SPEC)}, hot_rows)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(((e, a, b, t, k) for e, a, b, t in map(tuple, df.collect()) for k, _ in at(a, t)), key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize(("most_versions", "hot_rows"), [(1, 3), (1, 1_000_000), (16, 3)])
def test_few_versions_are_joined_and_many_are_carried(spark, most_versions, hot_rows):
    days = lambda *d: [f"2024-01-{x:02d} 00:00:00" for x in d]
    # Versions of id 1 overlap; id 2 is gone for a time; a version without a start was always there.
    rows = [(1, "a", *days(1, 9)), (1, "b", *days(5, 20)), (1, "c", *days(7, 8)), (2, "d", *days(1, 3)), (2, "e", days(6)[0], None), (None, "f", days(1)[0], None), (3, "g", None, days(4)[0])]
    fields = [(SPEC.attributes[0], "bigint"), (SPEC.key, "string"), (SPEC.start, "timestamp"), (SPEC.end, "timestamp")]
    text = spark.createDataFrame(rows, ", ".join(f"{n} {'string' if t == 'timestamp' else t}" for n, t in fields))
    dim = text.select(*[text[n].cast(t).alias(n) for n, t in fields])
    asked = [(i, t) for i in (1, 2, 3, None) for t in days(1, 3, 4, 6, 7, 8, 15, 20)] + [(2, days(6)[0]), (1, None)]
    events = spark.createDataFrame(asked, "id bigint, t string").selectExpr("id", "CAST(t AS timestamp) AS t")
    got = as_of_keys(events, "t", {"k": Lookup("id", dim, SPEC)}, hot_rows, most_versions=most_versions)
    want = [(1, d, "a") for d in (1, 3, 4)] + [(1, 6, "b"), (1, 7, "c")] + [(2, 1, "d"), (3, 1, "g"), (3, 3, "g")] + [(2, d, "e") for d in (6, 6, 7, 8, 15, 20)]
    assert sorted((r.id, r.t.day, r.k) for r in got.collect()) == sorted(want)
    # With few versions events move once for the join, and are not sorted together with the versions.
    assert ("Union" in got._jdf.queryExecution().executedPlan().toString()) == (most_versions == 1)


def test_a_later_price_leaves_earlier_orders_alone(spark):
    from tiffinmart.operators.scd2 import dimension_schema
    from tiffinmart.plans.fact import build_fact_as_of

    def versions(name, rows):
        spec = entities.get(name).dimension
        fields = dimension_schema(name)
        blank = {f.name: None for f in fields}
        data = [tuple((blank | {spec.key: k, spec.attributes[0]: i, spec.start: s, spec.end: e, spec.flag: e is None} | more).values()) for k, i, s, e, more in rows]
        text = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields)
        strings = spark.createDataFrame([tuple(None if v is None else str(v) for v in d) for d in data], ", ".join(f"{f.name} string" for f in fields))
        return strings.selectExpr(text.split(", CAST")[0], *["CAST" + t for t in text.split(", CAST")[1:]])

    start, turn = "2020-01-01 00:00:00", "2024-01-05 00:00:00"
    same = lambda name, more=None: versions(name, [(1, 1, start, None, more or {})])
    dims = {n: same(n) for n in ("customer", "customer_address", "location", "delivery_agent")} | {
        "restaurant": same("restaurant", {"location_id_fk": 1}),
        "menu": versions("menu", [(10, 1, start, turn, {}), (11, 1, turn, None, {})]),
    }
    orders = spark.sql("SELECT * FROM VALUES (1L, 1L, 1L, TIMESTAMP_NTZ'2024-01-04 23:59:59'), (2L, 1L, 1L, TIMESTAMP_NTZ'2024-01-05 00:00:00'), (3L, 1L, 1L, TIMESTAMP_NTZ'2019-01-01 00:00:00') AS t(order_id, customer_id_fk, restaurant_id_fk, order_date)")
    deliveries = spark.sql("SELECT order_id_fk, 1L AS delivery_agent_id_fk, 1L AS customer_address_id_fk, 'Delivered' AS delivery_status, 'x' AS estimated_time FROM VALUES (1L), (2L), (3L) AS t(order_id_fk)")
    items = spark.sql("SELECT order_id_fk * 10 AS order_item_id, order_id_fk, 1L AS menu_id_fk, 2.0BD AS quantity, 5.0BD AS price, 10.0BD AS subtotal FROM VALUES (1L), (2L), (3L) AS t(order_id_fk)")
    got = {r.order_id: (r.menu_dim_key, r.restaurant_location_dim_key) for r in build_fact_as_of(items, orders, deliveries, dims).collect()}
    assert got == {1: (10, 1), 2: (11, 1)}
