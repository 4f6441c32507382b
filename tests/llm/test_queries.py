"""Every query of the package over whole tables, against SQL or a brute-force version."""

import brute
import public_tokenizers
import pytest
import sentencepiece
from compare import compare, connect

from tiffinmart.llm import queries as q


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def texts(con):
    return con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def result(spark, sf_dir, name, *columns):
    df = q.QUERIES[name](spark, sf_dir)
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_against_sql(name, spark, sf_dir, con):
    df = q.QUERIES[name](spark, sf_dir)
    if name.startswith(("op3", "op9")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert compare(df, con, q.ORACLES[name]) is None


def test_contamination(spark, sf_dir, con, texts):
    got = dict(((d, i), c) for d, i, c in result(spark, sf_dir, "op2_contamination", "doc_id", "item_id", "n_covered"))
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    seeds = {i: brute.shingle_set(t, 5) for i, t in items}
    want = {}
    for d, t in texts:
        own = brute.shingle_set(t, 5)
        for i, item in items:
            # Without a shared run of five words there is no tile.
            if own & seeds[i]:
                covered, n = brute.tiling(item, t, 5)
                if covered >= 0.5 * n:
                    want[d, i] = covered
    assert got == want and want


def test_suffix_tree(spark, sf_dir, texts):
    rows = q.QUERIES["op4_suffix_tree"](spark, sf_dir).orderBy("doc_id").collect()
    want, n = brute.unigram(texts)
    for r, (d, _), (tokens, known, base) in zip(rows, texts, want, strict=True):
        assert (r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (d, tokens, known, n, brute.fold(d, 7) == 2)
        assert r.base_score == pytest.approx(base) and r.score < 0
    for r, score in zip(rows, brute.tree_scores(texts), strict=True):
        assert r.score == pytest.approx(score, rel=1e-5)
    for held in (True, False):
        assert sum(r.score - r.base_score for r in rows if r.held_out == held) > 0


def test_secrets(spark, sf_dir, texts):
    import hashlib

    got = {r.doc_id: r for r in q.QUERIES["op5_secrets"](spark, sf_dir).collect()}
    kinds = ("assign", "access", "hex")
    some = 0
    for d, t in texts:
        spans = brute.base_spans(t)
        told = [f"{kinds[k]}:{s}:{e}" for s, k, e in spans]
        r = got[d]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert set(told) <= set(r.spans.split(","))
        some += len(spans)
    assert some


def test_jaccard(spark, sf_dir, texts):
    assert result(spark, sf_dir, "op6_jaccard_components", "doc_id", "n_shingles", "component_id") == brute.components(texts, 85, 4)


def test_token_counts(spark, sf_dir, texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = [(d, len(t.encode()), n := len(sp.encode(t)), n > 4096) for d, t in texts]
    assert result(spark, sf_dir, "op7_token_counts", "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_quality_on_held_out(spark, con):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in q.QUERIES["op8_quality_scores"](spark, sf).collect()}
    labels = connect(sf).execute("SELECT doc_id, quality FROM labels").fetchall()
    held = [(rows[d].score, y) for d, y in labels if rows[d].held_out]
    assert all(r.held_out == (brute.fold(d, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in rows.items())
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    ahead = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert ahead > 0.85


def test_repeats(spark, sf_dir, texts):
    assert result(spark, sf_dir, "op10_remove_repeats", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeats(texts)
