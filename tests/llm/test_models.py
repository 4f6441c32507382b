"""Exact clustering, phrase collocations and personal data, against plain versions."""

import hashlib
import math
import random

import brute
import numpy as np
import pytest

from tiffinmart.llm import char_lstm, pii
from tiffinmart.llm.centroids import centroid_clusters
from tiffinmart.llm.char_lstm import CODES, KINDS, TAGS, SpanNet, codes_of, spans_of, tags_of
from tiffinmart.llm.phrases import collocations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# -- centroids ---------------------------------------------------------------------------------


def vectors(n, seed, size=4):
    r = random.Random(seed)
    return [(i, [r.uniform(-2, 2) + 3 * (i % 3) for _ in range(size)]) for i in range(n)]


def clusters(df, **more):
    return sorted(map(tuple, centroid_clusters(df, size=4, **more).collect()), key=str)


def test_centroids_with_odd_rows(spark):
    rows = vectors(60, 1) + vectors(3, 1)  # ids 0 to 2 twice
    rows += [(None, [0.5, 0.5, 0.5, 0.5]), (70, None), (71, [1.0, 2.0]), (72, [1.0, None, 2.0, 3.0]), (73, [1.0, math.nan, 0.0, 0.0])]
    rows += [(74, [math.inf, 0.0, 0.0, 0.0]), (75, []), (76, [0.0, 0.0, 0.0, 0.0]), (77, [-1e-9, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster string")
    got = clusters(df)
    assert got == sorted(brute.centroids(rows, size=4), key=str) and len(got) == 66


def test_centroids_at_ties_and_with_few_vectors(spark):
    rows = [(1, [1.0] * 4), (2, [1.0] * 4), (3, [3.0] * 4), (4, [2.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for k in (2, 8):
        assert clusters(df, k=k) == sorted(brute.centroids(rows, k=k, size=4), key=str)
    none = centroid_clusters(df.limit(0), size=4)
    assert none.collect() == [] and none.columns == centroid_clusters(df, size=4).columns


def test_centroids_refuse_what_a_long_cannot_hold(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0, 0.0, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        clusters(df)


# -- phrases -----------------------------------------------------------------------------------


def phrase_rows():
    r = random.Random(3)
    few = ["the", "of", "Big", "cat", "sat", "on", "mat", "é", "x"]
    texts = [" ".join(r.choice(few) + r.choice(["", "", "", ",", ".", "\n", "\t"]) for _ in range(60)) for _ in range(40)]
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(t, r.choice(["en", "de", None, "und"])) for t in texts]
    rows += [(f"one {passage} two", "en")] * 5 + [(passage, "en")] * 2 + [("a a a a a a a a", "en")] * 3
    return rows + [(None, "en"), ("", None), ("!?.", "fr"), ("alone", "fr"), (" \t ", "fr"), ("word " * 5000, "es")]


@pytest.mark.parametrize(("least", "top"), [(1, 2000), (4, 50), (1000, 5)])
def test_collocations(spark, least, top):
    rows = phrase_rows()
    df = spark.createDataFrame([(i, t, lang, 7) for i, (t, lang) in enumerate(rows)], "doc_id long, text string, lang string, n long")
    got = collocations(df, least=least, top=top).drop("path_words").collect()
    assert sorted(map(tuple, got)) == brute.collocations(rows, least, top)


def test_paths_without_branches(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(f"one {passage} two", "en")] * 5 + [("so it goes on", "en")] * 5
    got = collocations(spark.createDataFrame(rows, "text string, lang string"), least=5).collect()
    assert {(r.path_words, len(r.phrase.split())) for r in got} == {(32, 5), (4, 4)} and sum(r.path_words == 32 for r in got) == 28


def test_no_phrases(spark):
    assert collocations(spark.createDataFrame([], DOCS)).collect() == []


def test_scores_beyond_64_bits(spark):
    from tiffinmart.llm.phrases import scored

    r = random.Random(5)
    n = [r.randint(10**12, 10**14) for _ in range(20)]
    a = [r.randint(10**9, 10**11) for _ in n]
    left, right = [x + r.randint(0, 10**11) for x in a], [x + r.randint(0, 10**10) for x in a]
    key = lambda i, side: bytes([i, side] + [0] * 6)
    phrases = [("x", key(i, 0), left[i]) for i in range(20)] + [("x", key(i, 1), right[i]) for i in range(20)]
    totals = spark.createDataFrame([(str(i), n[i]) for i in range(20)], "lang string, n long")
    candidates = spark.createDataFrame([(str(i), key(i, 0) + key(i, 1), a[i]) for i in range(20)], "lang string, g binary, n long")
    got = {int(r.lang): (r.score, r.l, r.r) for r in scored(candidates, spark.createDataFrame(phrases, "lang string, g binary, n long"), totals).collect()}
    assert got == {i: (1000 * a[i] * n[i] // (left[i] * right[i]), left[i], right[i]) for i in range(20)}


# -- personal data -----------------------------------------------------------------------------

TEXTS = [
    "mail a.b@c.de, x@y z@q.r.s-t.. a@b.c_d@e.f", "@@a@b.c@d.e", "1.2.3.4.5.6.7.8 999.1.1.1 00001.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1112",
    "411111111111111141111111 4111  1111", "+49 (30) 123-4567. +1 +12345678901234567 +1 2 3 (4) 5 6 7 8 9 (", "", None, " \n", "é" * 50 + " a@b.cc", "+" * 40 + "123456789",
    "x" * 3000 + "@b.c " + "1" * 3000, "٣٤٥ +٣٤٥٣٤٥٣٤٥ 1.٢.3.4",
]


def test_patterns():
    for text in TEXTS:
        assert pii.base_spans(text or "") == brute.personal(text)
    r = random.Random(4)
    for _ in range(3000):
        text = "".join(r.choice("ab1234567890  ..@@--++()%_,") for _ in range(r.randint(0, 60)))
        assert pii.base_spans(text) == brute.personal(text)


def test_gradients():
    net, r = SpanNet(hidden=3, embed=2), np.random.default_rng(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    codes, tags = r.integers(0, CODES, (3, 6)).astype(np.uint8), r.integers(0, TAGS, (3, 6))
    _, g = net.gradients(codes, tags)
    for name, value in net.p.items():
        for _ in range(4):
            at = tuple(r.integers(0, n) for n in value.shape)
            kept, step = value[at], 1e-2
            value[at] = kept + step
            up = net.gradients(codes, tags)[0]
            value[at] = kept - step
            down = net.gradients(codes, tags)[0]
            value[at] = kept
            assert (up - down) / (2 * step) == pytest.approx(g[name][at], abs=1e-3)


def test_best_tags_are_the_best():
    import itertools

    r = np.random.default_rng(2)
    net = SpanNet()
    net.p["step"], net.p["first"] = r.normal(0, 1, (TAGS, TAGS)), r.normal(0, 1, TAGS)
    e = r.normal(0, 1, (4, TAGS, 5))
    got = net.best_tags(e)
    for row in range(5):
        score = lambda p: net.p["first"][p[0]] + sum(e[t, x, row] for t, x in enumerate(p)) + sum(net.p["step"][a, b] for a, b in itertools.pairwise(p))  # noqa: B023, E731
        assert tuple(got[row]) == max(itertools.product(range(TAGS), repeat=4), key=score)
    quiet = np.zeros((4, TAGS, 5))
    quiet[:, char_lstm.O] = 20
    assert not net.best_tags(quiet).any()
    # Rows that are passed over have no better path than the outside one, near the bound too.
    e = r.normal(0, 1, (3, TAGS, 60))
    e[:, char_lstm.O] += np.linspace(0, 8, 60)
    may = net.may_leave(e)
    assert may.any() and not may.all()
    for row in range(60):
        score = lambda p: net.p["first"][p[0]] + sum(e[t, x, row] for t, x in enumerate(p)) + sum(net.p["step"][a, b] for a, b in itertools.pairwise(p))  # noqa: B023, E731
        best = max(itertools.product(range(TAGS), repeat=3), key=score)
        assert tuple(net.best_tags(e)[row]) == best and (may[row] or not any(best))


def test_windows_cover_all():
    net, r = SpanNet(), np.random.default_rng(3)
    net.p["tag"][:] = 0
    codes = [r.integers(32, 127, n).astype(np.uint8) for n in (0, 1, 50, 99, 100, 101, 500)]
    whole = [net.best_tags(net.emissions(net.states(c[None])))[0] if len(c) else c for c in codes]
    got = net.tags(codes, 100, 40, rows=3)
    assert [len(g) for g in got] == [len(c) for c in codes]
    for g, w in zip(got[:5], whole[:5], strict=True):  # one window, padded
        assert len(g) == len(w)
    assert (got[4] == whole[4]).all() and (got[6][:20] == whole[6][:20]).mean() > 0.9
    assert spans_of(tags_of(9, [(0, 1, 3), (0, 3, 5), (2, 7, 9), (1, 8, 9)])) == [(0, 1, 3), (0, 3, 5), (2, 7, 9)]
    assert codes_of("aé—😀").tolist() == [97, char_lstm.LETTER, char_lstm.OTHER, char_lstm.LETTER]


def test_personal_data(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(9_000_000 + i, t, "en", "src0", 1) for i, t in enumerate(TEXTS)] + [(None, "a@b.cc", None, None, None)] * 2, DOCS)
    learnt = docs.select("doc_id", "text", "lang", "source", "n_chars").union(odd)
    # Forms that no pattern knows, in prose of the corpus, from other random numbers than the network learnt from.
    prose = [r.text for r in docs.orderBy("doc_id").limit(60).collect() if len(r.text) > 400 and not brute.personal(r.text)][:20]
    forms = pii.Forms(77)
    hidden = [(k, f) for k in range(len(KINDS)) for f in (forms.hidden(k) for _ in range(20))]
    hard = [(8_000_000 + i, f"{prose[i % len(prose)][:300]} {f}, {prose[-1][:100]}", "en", "src0", 1) for i, (_, f) in enumerate(hidden)]
    picked = learnt.select("doc_id", "text")
    net = pii.learned(picked, 20_000, 300, 96, 5)
    rows = pii.scanned(learnt.union(spark.createDataFrame(hard, DOCS)), net).collect()
    monkeypatch.setattr(pii, "learned", lambda *a: net)
    assert sorted(map(str, pii.find_personal(learnt).collect())) == sorted(map(str, pii.scanned(learnt, net).collect()))
    texts = {r.doc_id: r.text for r in learnt.collect()} | {d: t for d, t, *_ in hard}
    assert len(rows) == len(texts) + 1
    found = clean = wrong = 0
    for r in rows:
        base = brute.personal(texts[r.doc_id])
        told = [f"{KINDS[k]}:{s}:{e}" for k, s, e in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in base) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        spans = [s for s in r.spans.split(",") if s]
        assert spans[: len(told)] == told and len(spans) == len(told) + r.n_model
        if r.doc_id is not None and 8_000_000 <= r.doc_id < 9_000_000:
            kind, form = hidden[r.doc_id - 8_000_000]
            at = texts[r.doc_id].index(form)
            found += any(at <= int(s.split(":")[1]) < at + len(form) for s in spans)
        elif not base:
            clean += 1
            wrong += r.n_model > 0
    assert found >= 0.9 * len(hidden) and wrong <= 0.02 * clean


def test_personal_data_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert pii.find_personal(empty).collect() == []
