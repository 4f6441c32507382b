import pytest
from conftest import rows

from tiffinmart.store import SnapshotTable


@pytest.fixture
def table(spark, tmp_path):
    return SnapshotTable(spark, str(tmp_path / "t"), ["id"], buckets=4)


def frame(spark, *data):
    return spark.createDataFrame(list(data), "id bigint, v string")


def test_versions_stay_readable(spark, table):
    assert table.version() is None and not table.exists() and table.batch_id() is None
    assert table.commit(frame(spark, (1, "a"), (2, "b")), batch_id=5) == 0
    assert table.commit(frame(spark, (1, "c"))) == 1
    assert rows(table.read(0)) == [(1, "a"), (2, "b")]
    assert rows(table.read()) == [(1, "c")]
    assert table.batch_id() == 5 and table.versions() == [0, 1]


def test_replacing_slices_carries_the_others_over(spark, table):
    table.commit(frame(spark, *[(i, "old") for i in range(20)]))
    delta = frame(spark, (3, "new"))
    touched = table.touched_slices(delta)
    assert len(touched) == 1
    kept = table.read(slices=touched).filter("id <> 3").unionByName(delta)
    table.commit(kept, replace=touched)
    assert rows(table.read()) == sorted(
        [(i, "new" if i == 3 else "old") for i in range(20)], key=lambda t: tuple(map(str, t))
    )
    assert table.changed_slices(0, 1) == touched
    before, after = table.images(0, 1)
    assert before.count() == after.count() < 20


def test_emptied_slice_disappears(spark, table):
    table.commit(frame(spark, (1, "a"), (2, "b")))
    touched = table.touched_slices(frame(spark, (1, "a"), (2, "b")))
    table.commit(frame(spark), replace=touched)
    assert table.read().count() == 0 and table.read().columns == ["id", "v"]


def test_files_of_an_unpublished_version_are_ignored(spark, table):
    table.commit(frame(spark, (1, "a")))
    table.with_slices(frame(spark, (9, "orphan"))).write.partitionBy("_bucket").parquet(f"{table.root}/data/_version=1")
    assert rows(table.read()) == [(1, "a")]
    assert table.commit(frame(spark, (1, "b"))) == 1
    assert rows(table.read()) == [(1, "b")]


def test_second_writer_is_noticed(spark, table):
    table.commit(frame(spark, (1, "a")))
    with pytest.raises(RuntimeError, match="already exists"):
        table._publish(0, {})


def test_partitioned_by_columns_with_null(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "p"), ["id"], buckets=0, partition_by=["y"])
    df = spark.createDataFrame([(1, 2023), (2, 2024), (3, None)], "id bigint, y int")
    t.commit(df)
    assert rows(t.read(), "id", "y") == rows(df, "id", "y")
    touched = t.touched_slices(df.filter("y IS NULL"))
    t.commit(spark.createDataFrame([(4, None)], "id bigint, y int"), replace=touched)
    assert rows(t.read(), "id", "y") == [(1, 2023), (2, 2024), (4, None)]


def test_int_and_bigint_keys_share_a_bucket(spark, table):
    assert table.touched_slices(frame(spark, (7, "a"))) == table.touched_slices(
        spark.createDataFrame([(7, "a")], "id int, v string")
    )


def test_another_slicing_is_refused(spark, table):
    table.commit(frame(spark, *[(i, "a") for i in range(20)]))
    for other in (SnapshotTable(spark, table.root, ["id"], buckets=16), SnapshotTable(spark, table.root, ["v"], buckets=4)):
        with pytest.raises(ValueError, match="cut into slices"):
            other.read()
        with pytest.raises(ValueError, match="cut into slices"):
            other.commit(frame(spark, (1, "b")))
    assert SnapshotTable(spark, table.root, ["id"], buckets=4).read().count() == 20
