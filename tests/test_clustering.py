"""A fact that grows by files: what is rewritten, what stays, and that no row changes."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tiffinmart.plans.clustering import ClusteredFact, overlaps, pieces

FILES = "order_year int, order_month int, file string, low long, high long, file_rows long"
ROWS = "order_id long, day long, order_year int, order_month int"


def listed(spark, ranges):
    return spark.createDataFrame([(2024, m, f, a, b, 1) for m, f, a, b in ranges], FILES)


def chosen(files, most):
    return {(r.order_month, r.file): r.cluster for r in overlaps(files, most_depth=most).collect() if r.cluster is not None}


def test_overlaps_by_hand(spark):
    files = listed(spark, [(1, "a", 1, 5), (1, "b", 5, 9), (1, "c", 5, 6), (1, "d", 10, 12), (1, "e", 5, 5), (1, "n", None, None), (2, "a", 1, 5)])
    assert chosen(files, 3) == {}
    assert chosen(files, 2) == {(1, "a"): 1, (1, "b"): 1, (1, "c"): 1}
    assert {r.file: r.deepest for r in overlaps(files).filter("order_month = 1").collect()} == {"a": 1, "b": 2, "c": 3, "d": 1}


def test_overlaps_against_every_place(spark):
    for seed in range(4):
        rng = random.Random(seed)
        ranges = [(1, f"f{i:02}", a, a + rng.randrange(0, 9)) for i, a in enumerate(rng.randrange(60) for _ in range(30))]
        wide = [r for r in ranges if r[2] < r[3]]
        for most in (2, 3):
            deep = [x for x in range(70) if sum(a <= x <= b for _, _, a, b in wide) > most]
            want = sorted((a, b, f) for _, f, a, b in wide if any(a <= x <= b for x in deep))
            clusters, reach = {}, -1
            for a, b, f in want:
                clusters[1, f] = len(set(clusters.values())) + (a > reach)
                reach = max(reach, b)
            assert chosen(listed(spark, ranges), most) == clusters


def test_pieces_share_no_value(spark):
    data = [(i, d, 2024, 1) for i, d in enumerate([1] * 3 + [2] * 25 + [3] * 4 + [4] * 4 + [None] * 2)]
    out = pieces(spark.createDataFrame(data, ROWS), "day", ["order_year", "order_month"], 10)
    assert sorted(map(tuple, out.drop("_piece").collect()), key=lambda r: r[0]) == data
    days = {}
    for r in out.collect():
        days.setdefault(r._piece, []).append(r.day)
    assert all(len(set(d)) == 1 for d in days.values() if 2 in d) and sum(2 in d for d in days.values()) > 1
    assert max(len(d) for d in days.values() if 2 not in d) < 20


def test_growth(spark, tmp_path):
    grown = ClusteredFact(spark, str(tmp_path / "f"), "day", rows_per_file=8, most_depth=2)
    rng, data = random.Random(5), []
    for batch in range(3):
        # All batches fill month 1, each has a week of month 2 for itself; ids repeat and some keys are missing.
        rows_1 = [(rng.randrange(99), rng.randrange(1, 32), 2024, 1) for _ in range(60)]
        rows_2 = [(rng.randrange(99), batch * 6 + d, 2024, 2) for d in range(1, 6) for _ in range(3)]
        part = rows_1 + rows_2 + [(batch, None, 2024, 3), (batch, 1, None, None)]
        data += part
        assert grown.append(spark.createDataFrame(part, ROWS), batch) == batch
    assert grown.append(spark.createDataFrame(data, ROWS), 2) is None
    order = lambda found: sorted(map(tuple, found), key=str)
    assert order(grown.read().select("order_id", "day", "order_year", "order_month").collect()) == order(data)
    before = {r.file: (r.order_month, r.file_rows) for r in grown.files.read().collect()}
    assert grown.depth() > 2
    gone = grown.recluster(3)
    after = {r.file: (r.order_month, r.file_rows) for r in grown.files.read().collect()}
    assert grown.depth() <= 2 and set(gone) == set(before) - set(after) and gone
    assert {before[f][0] for f in gone} == {1}
    assert order(grown.read().select("order_id", "day", "order_year", "order_month").collect()) == order(data)
    assert grown.recluster(3) == [] == grown.recluster(4)
    week = grown.read(3, 4)
    assert len(week.inputFiles()) < len(after) / 2
    assert rows(week, "day", "order_id") == sorted(((d, i) for i, d, *_ in data if d in (3, 4)), key=lambda t: tuple(map(str, t)))


def test_a_failed_step_shows_nothing(spark, tmp_path, monkeypatch):
    grown = ClusteredFact(spark, str(tmp_path / "f"), "day", 4, 2)
    for batch in range(3):
        grown.append(spark.createDataFrame([(i, i % 7, 2024, 1) for i in range(20)], ROWS), batch)
    with monkeypatch.context() as m:
        m.setattr(grown.files, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            grown.recluster(3)
    assert grown.read().count() == 60 and grown.depth() > 2
    assert grown.recluster(3) and grown.depth() <= 2 and grown.read().count() == 60


def test_nothing_to_cluster(spark, tmp_path):
    grown = ClusteredFact(spark, str(tmp_path / "f"), "day")
    assert grown.recluster(0) == []
    grown.append(spark.createDataFrame([], ROWS), 0)
    assert grown.read().count() == 0 and grown.recluster(1) == [] and grown.depth() == 0
    grown.append(spark.createDataFrame([(1, 1, 2024, 1)], ROWS), 1)
    assert grown.read().filter(F.col("order_id") == 1).count() == 1
    with pytest.raises(ValueError, match="2 at least"):
        ClusteredFact(spark, str(tmp_path / "g"), most_depth=1)


def test_rows_move_once_to_their_pieces(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.range(100).select((F.col("id") % 7).alias("day"), F.lit(1).alias("order_month"), "id")
        laid = pieces(lines, "day", ["order_month"], 20)
        plan = laid._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and laid.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
