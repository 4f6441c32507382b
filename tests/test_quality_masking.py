import pytest
from conftest import rows

from tiffinmart.operators import masking, quality


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "Asha", None, "a@x"), (2, None, "222", "b@x"), (2, "Binod", "333", None)],
        "id int, name string, mobile string, email string",
    )


def test_masks_replace_every_value(people):
    out = masking.mask_columns(people, {"mobile": "phone", "email": "email", "name": "pii"})
    assert set(rows(out, "name", "mobile", "email")) == {("** PII **", "** Phone **", "** EAMIL **")}


def test_tags_travel_and_choose_the_mask(people):
    tagged = masking.tag_columns(people, {"mobile": "SENSITIVE", "email": "EMAIL", "id": "PRICE"}).filter("id = 1")
    assert rows(masking.mask_by_tag(tagged)) == [(1, "Asha", "** Phone **", "** EAMIL **")]
    with pytest.raises(ValueError, match="SECRET"):
        masking.tag_columns(people, {"name": "SECRET"})
    assert masking.entity_tags("customer") == {"mobile": "PII", "email": "EMAIL", "gender": "PII", "dob": "PII"}


def test_null_and_unique_checks(people):
    assert rows(quality.check_not_null(people, ["name", "email"])) == [("email", 1), ("name", 1)]
    assert rows(quality.check_unique(people, ["id"])) == [(2, 2)]
    report = {r.column_name: (r.null_rate, r.within_limit) for r in quality.null_rates(people, {"name": 0.5, "id": 0, "email": 0.1}).collect()}
    assert report == {"name": (1 / 3, True), "id": (0.0, True), "email": (1 / 3, False)}


def test_lengths(spark):
    df = spark.sql("SELECT repeat('x', 101) AS city, 'GA' AS state, 'GAA' AS state_code, 'Tier-1' AS city_tier, '1' AS zip_code, 'Y' AS active_flag")
    long = {r.column_name: r.too_long for r in quality.check_lengths(df, "location").collect()}
    assert long["city"] == 1 and long["state_code"] == 1 and long["zip_code"] == 0


def test_foreign_keys_count_rows_not_values(spark):
    fact = spark.sql("SELECT * FROM VALUES (1, 5), (9, 5), (9, 6), (CAST(NULL AS INT), 6) AS t(a, b)")
    dim_a, dim_b = spark.sql("SELECT 1 AS k"), spark.sql("SELECT * FROM VALUES (5), (6) AS t(k)")
    assert rows(quality.check_foreign_keys(fact, {"a": (dim_a, "k"), "b": (dim_b, "k")})) == [("a", 2), ("b", 0)]


def test_reconcile_counts(spark):
    stage = spark.sql("SELECT * FROM VALUES ('f1'), ('f1'), ('f2') AS t(f)")
    clean = spark.sql("SELECT 'f1' AS f")
    assert rows(quality.reconcile_counts({"stage": stage, "clean": clean}, ["f"])) == [("f1", 2, 1), ("f2", 1, 0)]


def test_on_time_by_tier(spark):
    d = spark.sql("SELECT * FROM VALUES (1, '30 minutes', 30), (1, '30 minutes', 31), (2, 'soon', 5), (2, '10 min', 5) AS t(loc, estimated_time, actual_minutes)")
    places = spark.sql("SELECT * FROM VALUES (1, 'Tier-1'), (2, 'Tier-2') AS t(location_id, city_tier)")
    assert rows(quality.on_time_by_tier(d, places, "loc")) == [("Tier-1", 2, 1, 0.5), ("Tier-2", 1, 1, 1.0)]
