"""The pipeline against plain versions of its stages, each on its own input."""

import brute
import corpus_pipeline as pipeline
import pytest
from compare import connect

from tiffinmart.llm import queries as q


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_quality(stages):
    want = brute.good_texts([(r.doc_id, r.text, r.source) for r in stages[0].collect()])
    got = stages[1].collect()
    assert {r.doc_id: r.text for r in got} == want and 0 < len(got) == len(want) < stages[0].count()


def test_near_copies(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].orderBy("doc_id").collect()]
    assert ids(stages[2]) == sorted({c for _, _, c in brute.components(rows, 80, 5)})


def test_contamination(stages, sf_dir):
    items = [t for (t,) in connect(sf_dir).execute("SELECT text FROM benchmark").fetchall()]
    clean = []
    for r in stages[2].collect():
        own = brute.shingle_set(r.text, 5)
        if not any(own & brute.shingle_set(t, 5) and (c := brute.tiling(t, r.text, 5))[0] >= 0.5 * c[1] for t in items):
            clean.append(r.doc_id)
    assert ids(stages[3]) == sorted(clean)


def test_secrets(stages):
    before = {r.doc_id: r for r in stages[3].collect()}
    after = {r.doc_id: r for r in stages[4].collect()}
    assert set(before) == set(after)
    assert any(brute.base_spans(r.text) for r in before.values())
    for d, r in after.items():
        assert not brute.base_spans(r.text) and (r.n_chars == len(r.text) or r.text == before[d].text)


def test_mixing(stages, spark):
    got = stages[5]
    want = q.mix_sources(stages[4], q.WEIGHTS, q.OTHER_WEIGHT)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert set(ids(got)) <= set(ids(stages[4]))


def test_run(stages, spark, sf_dir):
    assert sorted((r.doc_id, r.copy) for r in pipeline.run(spark, sf_dir).select("doc_id", "copy").collect()) == sorted(
        (r.doc_id, r.copy) for r in stages[5].select("doc_id", "copy").collect()
    )
