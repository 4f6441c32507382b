import gzip
import hashlib

import landing
import pytest
from conftest import rows

from tiffinmart import entities
from tiffinmart.sources.csv_stage import CORRUPT, copy_into, load_stage, read_stage, scan_csv
from tiffinmart.sources.files import fingerprints, list_files
from tiffinmart.sources.ledger import copy_history, pending_files, read_ledger

HEADER = ",".join(entities.LOCATION.source_columns) + "\n"


def write(path, body, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(header + body)
    return str(path)


def test_quotes_nulls_and_positions(spark, tmp_path):
    # The header names are wrong on purpose: columns bind by position.
    path = write(
        tmp_path / "a.csv", '1,"Panaji, Goa",\\N,"say ""hi""",,"",2024\n', "h1,h2,h3,h4,h5,h6,h7\n"
    )
    r = scan_csv(spark, "location", path).first()
    assert tuple(r)[:7] == ("1", "Panaji, Goa", None, 'say "hi"', None, "", "2024")


def test_ragged_rows_are_kept_and_marked_or_abort(spark, tmp_path):
    path = write(tmp_path / "a.csv", "1,a\n2,a,b,c,d,e,f\n3,a,b,c,d,e,f,extra\n")
    # All columns are read: Spark does not check columns it prunes.
    got = [(r.locationid, r.modifieddate, r[CORRUPT] is not None) for r in scan_csv(spark, "location", path).collect()]
    assert sorted(got) == [("1", None, True), ("2", "f", False), ("3", "f", True)]
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        scan_csv(spark, "location", path, strict=True).collect()


def test_gzip_and_nested_prefixes(spark, tmp_path):
    write(tmp_path / "x" / "a.csv", "1,a,b,c,d,e,f\n")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write(HEADER + "2,a,b,c,d,e,f\n")
    assert sorted(r.locationid for r in scan_csv(spark, "location", str(tmp_path)).collect()) == ["1", "2"]


def test_lineage_of_odd_file_names(spark, tmp_path):
    path = write(tmp_path / "initial" / "delhi+NCR 1.csv", "1,a,b,c,d,e,f\n")
    r = load_stage(spark, "location", str(tmp_path), "2024-01-01 00:00:00", str(tmp_path)).first()
    assert r._stg_file_name == "initial/delhi+NCR 1.csv"
    assert r._stg_file_md5 == hashlib.md5(open(path, "rb").read()).hexdigest()
    assert r._stg_file_load_ts is not None and str(r._copy_data_ts) == "2024-01-01 00:00:00"


def test_fingerprints_are_content_digests(spark, tmp_path):
    content = bytes(range(256)) * 10_000
    (tmp_path / "big.bin").write_bytes(content)
    (tmp_path / "small.bin").write_bytes(b"abc")
    (tmp_path / "empty.bin").write_bytes(b"")
    df = fingerprints(spark, str(tmp_path))
    # Spark plans no split for a file of length 0.
    assert {r.path.rsplit("/", 1)[1]: r.md5 for r in df.collect()} == {
        "big.bin": hashlib.md5(content).hexdigest(), "small.bin": hashlib.md5(b"abc").hexdigest(),
    }
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_listing_reads_no_content(spark, tmp_path):
    (tmp_path / "a.csv").write_text("12345")
    listing = list_files(spark, str(tmp_path))
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in listing.collect()] == [("a.csv", 5)]
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_files_load_once_and_changed_content_loads_again(spark, tmp_path):
    land, stage, ledger = tmp_path / "land", str(tmp_path / "stage"), str(tmp_path / "ledger")

    def load(load_id):
        return copy_into(spark, "location", str(land), stage, ledger, load_id, f"2024-01-0{load_id} 00:00:00", str(land))

    landing.put(land / "delta-1", "day-02.csv", "location", landing.location("1"), landing.location("2"))
    assert load(1) == 1 and load(2) == 0
    with pytest.raises(ValueError, match="already recorded"):
        load(1)
    # The same name and content under another prefix is another file.
    landing.put(land / "delta-2", "day-02.csv", "location", landing.location("1"), landing.location("2"))
    assert load(3) == 1
    landing.put(land / "delta-2", "day-02.csv", "location", landing.location("3"))
    assert load(4) == 1
    got = rows(read_ledger(spark, ledger), "load_id", "row_count", "corrupt_count")
    assert got == [(1, 2, 0), (3, 2, 0), (4, 1, 0)]
    assert rows(read_stage(spark, "location", stage), "load_id", "locationid") == [
        (1, "1"), (1, "2"), (3, "1"), (3, "2"), (4, "3"),
    ]
    assert pending_files(fingerprints(spark, str(land)), read_ledger(spark, ledger), "location").count() == 0
    assert pending_files(fingerprints(spark, str(land)), read_ledger(spark, ledger), "menu").count() == 2
    recent = copy_history(read_ledger(spark, ledger), "location", "2024-01-03 00:30:00")
    assert sorted(r.load_id for r in recent.collect()) == [3, 4]


def test_known_files_are_not_opened_again(spark, tmp_path, monkeypatch):
    import os

    from tiffinmart.sources import csv_stage

    asked = []
    real = csv_stage.fingerprints
    monkeypatch.setattr(csv_stage, "fingerprints", lambda s, paths: asked.append(paths) or real(s, paths))
    land, stage, ledger = tmp_path / "land", str(tmp_path / "stage"), str(tmp_path / "ledger")

    def load(load_id):
        return copy_into(spark, "location", str(land), stage, ledger, load_id, f"2024-01-0{load_id} 00:00:00", str(land))

    landing.put(land, "a [1] {x}*.csv", "location", landing.location("1"))
    landing.put(land, "b+c.csv", "location", landing.location("2"))
    assert load(1) == 2 and load(2) == 0 and len(asked) == 1
    landing.put(land, "c.csv", "location", landing.location("3"))
    assert load(3) == 1
    assert len(asked) == 2 and [p.rsplit("/", 1)[1] for p in asked[1]] == ["c.csv"]
    # A touched file is looked at, and found to be loaded.
    os.utime(land / "b+c.csv", (1, 1))
    assert load(4) == 0 and [p.rsplit("/", 1)[1] for p in asked[2]] == ["b+c.csv"]
    assert rows(read_stage(spark, "location", stage), "load_id", "locationid") == [(1, "1"), (1, "2"), (3, "3")]
    # More files than names are wanted: the prefix is read, with the same rows.
    other = str(tmp_path / "other")
    assert copy_into(spark, "location", str(land), f"{other}/s", f"{other}/l", 1, "2024-01-01 00:00:00", str(land), most_names=1) == 3
    assert asked[-1] == str(land) and rows(read_stage(spark, "location", f"{other}/s"), "locationid") == [("1",), ("2",), ("3",)]


def test_large_files_are_fingerprinted_by_lines(spark, tmp_path):
    lines = [f"{i},some text\n" for i in range(5000)]
    (tmp_path / "a.csv").write_text("".join(lines))
    (tmp_path / "b.csv").write_text("".join(reversed(lines)))
    (tmp_path / "c.csv").write_text("".join(lines).replace("77,some", "78,some"))
    (tmp_path / "small.csv").write_text("abc")
    got = {r.path.rsplit("/", 1)[1]: r for r in fingerprints(spark, str(tmp_path), largest=1000).collect()}
    assert got["small.csv"].md5 == hashlib.md5(b"abc").hexdigest()
    assert got["a.csv"].md5 == got["b.csv"].md5 != got["c.csv"].md5 and got["a.csv"].md5.startswith("lines:")
    listed = {r.path: (r.length, r.modified_at) for r in list_files(spark, str(tmp_path)).collect()}
    assert {r.path: (r.length, r.modified_at) for r in got.values()} == listed
    # The digest does not depend on how the file is split.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        again = {r.path.rsplit("/", 1)[1]: r.md5 for r in fingerprints(spark, str(tmp_path), largest=1000).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert again == {n: r.md5 for n, r in got.items()}


def test_no_task_holds_a_large_file_unless_asked_to(spark, tmp_path):
    line = "x" * 99 + "\n"
    (tmp_path / "large.csv").write_text(line * 700_000)
    (tmp_path / "small.csv").write_text(line * 1000)
    got = {r.path.rsplit("/", 1)[1]: r.md5 for r in fingerprints(spark, str(tmp_path)).collect()}
    assert got["large.csv"].startswith("lines:") and got["small.csv"] == hashlib.md5((line * 1000).encode()).hexdigest()


def test_corrupt_rows_and_empty_files_are_counted(spark, tmp_path):
    land, ledger = tmp_path / "land", str(tmp_path / "ledger")
    write(land / "a.csv", "1,a\n2,a,b,c,d,e,f\n")
    write(land / "b.csv", "")
    assert copy_into(spark, "location", str(land), str(tmp_path / "s"), ledger, 1, "2024-01-01 00:00:00") == 2
    assert rows(read_ledger(spark, ledger), "row_count", "corrupt_count") == [(0, 0), (2, 1)]


def test_offset_filter_prunes_load_folders(spark, tmp_path):
    land = tmp_path / "land"
    landing.put(land, "a.csv", "location", landing.location("1"))
    copy_into(spark, "location", str(land), str(tmp_path / "s"), str(tmp_path / "l"), 1, "2024-01-01 00:00:00")
    plan = read_stage(spark, "location", str(tmp_path / "s")).filter("load_id > 1")
    assert "PartitionFilters: [isnotnull(load_id" in plan._jdf.queryExecution().executedPlan().toString()
