import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tiffinmart.entities import Dimension
from tiffinmart.operators import changes as C
from tiffinmart.operators.scd2 import as_of, current, scd2_attribute_match, scd2_keyed

SCHEMA = "id int, a string, b string"
SPEC = Dimension("hk", ("id", "a", "b"), ("id", "a", "b"), ("id", "a", "b"), "start_ts", "end_ts", "is_current")
T = [f"2024-01-0{i} 00:00:00" for i in range(1, 10)]


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_feed_of_each_kind(spark):
    old = frame(spark, (1, "x", None), (2, "y", "q"), (3, "z", "z"))
    new = frame(spark, (1, "x", None), (2, "Y", "q"), (4, "n", None))
    assert rows(C.change_feed(old, new, ["id"])) == [
        (2, "Y", "q", "INSERT", True),
        (2, "y", "q", "DELETE", True),
        (3, "z", "z", "DELETE", False),
        (4, "n", None, "INSERT", False),
    ]
    counts = {(r[0], r[1]): r[2] for r in C.pending_change_count(C.change_feed(old, new, ["id"])).collect()}
    assert counts == {("INSERT", True): 1, ("DELETE", True): 1, ("DELETE", False): 1, ("INSERT", False): 1}


def test_feed_without_old_is_all_inserts(spark):
    assert rows(C.change_feed(None, frame(spark, (1, "x", None)), ["id"])) == [(1, "x", None, "INSERT", False)]


def test_feed_sees_null_transitions_and_can_ignore_columns(spark):
    old, new = frame(spark, (1, "x", None)), frame(spark, (1, "x", "v"))
    assert C.change_feed(old, new, ["id"]).count() == 2
    assert C.change_feed(old, new, ["id"], compare=["a"]).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_replaying_a_feed_gives_the_new_version(spark, seed):
    rnd = random.Random(seed)

    def version():
        ids = rnd.sample(range(40), 25)
        return frame(spark, *[(i, rnd.choice("xyz"), rnd.choice(["p", None])) for i in ids])

    old, new = version(), version()
    feed = C.change_feed(old, new, ["id"])
    assert rows(C.apply_feed(old, feed, ["id"])) == rows(new)


def test_append_changes(spark):
    df = spark.range(5).withColumnRenamed("id", "load_id")
    assert C.append_changes(df, None).count() == 5
    assert sorted(r[0] for r in C.append_changes(df, 2).collect()) == [3, 4]


# -- the reference's rule ------------------------------------------------------------------------


def reference_dim(spark, versions, spec=SPEC, compare=None):
    dim = scd2_attribute_match(None, C.change_feed(None, versions[0], ["id"]), spec, T[0])
    for i, (old, new) in enumerate(zip(versions, versions[1:], strict=False), 1):
        dim = scd2_attribute_match(dim, C.change_feed(old, new, ["id"], compare), spec, T[i])
    return dim


def state(dim):
    return rows(dim, "id", "a", "b", F.date_format("start_ts", "d").alias("s"), F.date_format("end_ts", "d").alias("e"), "is_current")


def test_reference_update_closes_and_opens(spark):
    dim = reference_dim(spark, [frame(spark, (1, "x", "p")), frame(spark, (1, "y", "p"))])
    assert state(dim) == [(1, "x", "p", "1", "2", False), (1, "y", "p", "2", None, True)]


def test_reference_key_and_flag_match_loses_the_new_version(spark):
    narrow = Dimension("hk", SPEC.attributes, ("a",), ("id", "b"), "start_ts", "end_ts", "is_current")
    dim = reference_dim(spark, [frame(spark, (1, "x", "Yes")), frame(spark, (1, "y", "Yes"))], narrow)
    assert state(dim) == [(1, "x", "Yes", "1", "2", False)]
    dim = reference_dim(spark, [frame(spark, (1, "x", "Yes")), frame(spark, (1, "x", "No"))], narrow)
    assert state(dim) == [(1, "x", "No", "2", None, True), (1, "x", "Yes", "1", "2", False)]


def test_reference_unchanged_resend_closes_without_reopening(spark):
    first = frame(spark, (1, "x", "p")).withColumn("audit", F.lit(1))
    again = frame(spark, (1, "x", "p")).withColumn("audit", F.lit(2))
    dim = reference_dim(spark, [first, again])
    assert state(dim) == [(1, "x", "p", "1", "2", False)]


def test_reference_null_attribute_is_never_closed(spark):
    dim = reference_dim(spark, [frame(spark, (1, "x", None)), frame(spark, (1, "y", None))])
    assert state(dim) == [(1, "x", None, "1", None, True), (1, "y", None, "2", None, True)]
    assert [r.hk for r in dim.collect()] == [None, None]


def test_reference_a_b_a_leaves_nothing_open(spark):
    a, b = frame(spark, (1, "x", "p")), frame(spark, (1, "y", "p"))
    assert state(reference_dim(spark, [a, b, a])) == [(1, "x", "p", "1", "2", False), (1, "y", "p", "2", "3", False)]
    # Closing the first version again moves its end.
    assert state(reference_dim(spark, [a, b, a, b]))[0] == (1, "x", "p", "1", "4", False)


def test_reference_ignores_pure_deletes(spark):
    dim = reference_dim(spark, [frame(spark, (1, "x", "p"), (2, "y", "q")), frame(spark, (2, "y", "q"))])
    assert state(dim)[0] == (1, "x", "p", "1", None, True)


# -- keyed rule ----------------------------------------------------------------------------------


def keyed_dim(spark, versions, **options):
    dim = scd2_keyed(None, C.change_feed(None, versions[0], ["id"]), SPEC, T[0])
    for i, (old, new) in enumerate(zip(versions, versions[1:], strict=False), 1):
        dim = scd2_keyed(dim, C.change_feed(old, new, ["id"]), SPEC, T[i], **options)
    return dim


def test_keyed_handles_what_the_reference_rule_does_not(spark):
    a, b = frame(spark, (1, "x", None)), frame(spark, (1, "y", None))
    dim = keyed_dim(spark, [a, b, a])
    assert state(dim) == [
        (1, "x", None, "1", "2", False), (1, "x", None, "3", None, True), (1, "y", None, "2", "3", False),
    ]
    assert len({r.hk for r in dim.collect()}) == 3


def test_keyed_unchanged_resend_keeps_the_version(spark):
    a = frame(spark, (1, "x", "p"))
    resend = a.select("*", F.lit("INSERT").alias(C.ACTION), F.lit(True).alias(C.IS_UPDATE))
    dim = scd2_keyed(scd2_keyed(None, C.change_feed(None, a, ["id"]), SPEC, T[0]), resend, SPEC, T[1])
    assert state(dim) == [(1, "x", "p", "1", None, True)]


def test_keyed_delete_is_closed_on_request(spark):
    versions = [frame(spark, (1, "x", "p"), (2, "y", "q")), frame(spark, (2, "y", "q"))]
    assert state(keyed_dim(spark, versions))[0] == (1, "x", "p", "1", None, True)
    assert state(keyed_dim(spark, versions, close_on_delete=True))[0] == (1, "x", "p", "1", "2", False)


@pytest.mark.parametrize("seed", range(3))
def test_keyed_intervals_never_overlap_and_end_at_the_last_version(spark, seed):
    rnd = random.Random(seed)
    versions = [
        frame(spark, *[(i, rnd.choice("xy"), rnd.choice(["p", None])) for i in rnd.sample(range(8), 6)])
        for _ in range(4)
    ]
    out = [tuple(r) for r in keyed_dim(spark, versions, close_on_delete=True).drop("hk").collect()]
    by_id = {}
    for i, a, b, start, end, is_open in out:
        by_id.setdefault(i, []).append((start, end, is_open, a, b))
    for spans in by_id.values():
        spans.sort(key=lambda s: s[0])
        assert sum(s[2] for s in spans) <= 1
        for (_, end, _, *_), (start, *_) in zip(spans, spans[1:], strict=False):
            assert end is not None and end <= start
    open_rows = sorted((i, s[3], s[4]) for i, spans in by_id.items() for s in spans if s[2])
    assert open_rows == sorted(tuple(r) for r in versions[-1].collect())


def test_as_of_and_current(spark):
    dim = keyed_dim(spark, [frame(spark, (1, "x", "p")), frame(spark, (1, "y", "p"))])
    facts = spark.createDataFrame(
        [(1, "2024-01-01 12:00:00"), (1, "2024-01-02 00:00:00"), (1, "2023-12-31 00:00:00")], "fk int, t string"
    ).withColumn("t", F.col("t").cast("timestamp"))
    got = as_of(facts, dim, SPEC, "fk", "t")
    assert rows(got.select(F.date_format("t", "MM-dd HH"), "a")) == [("01-01 12", "x"), ("01-02 00", "y")]
    assert rows(current(dim, SPEC), "a") == [("y",)]
