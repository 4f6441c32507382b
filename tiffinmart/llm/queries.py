"""The registered queries of this package, over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tiffinmart.llm.byte_cnn import quality_scores
from tiffinmart.llm.centroids import centroid_clusters
from tiffinmart.llm.decontaminate import contamination
from tiffinmart.llm.jaccard_join import jaccard_components
from tiffinmart.llm.licences import PARAGRAPH, RULES, SENTENCE_END, SENTENCES, TRIGGERS, normal_form, scan_licences
from tiffinmart.llm.mixing import mix_sources
from tiffinmart.llm.phrases import collocations
from tiffinmart.llm.pii import find_personal
from tiffinmart.llm.quality_rules import quality_rules
from tiffinmart.llm.secret_scan import scan_secrets
from tiffinmart.llm.suffix_dedup import remove_repeats
from tiffinmart.llm.suffix_tree import text_scores
from tiffinmart.llm.token_counts import count_tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Shares of bytes by source: the hot source is held back, three curated ones are raised, all others share the rest.
WEIGHTS = {"src0": 0.2, "src1": 0.1, "src2": 0.1, "src3": 0.1}
OTHER_WEIGHT = 0.5

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@query
def op1_mix_sources(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"), WEIGHTS, OTHER_WEIGHT)


_UNIT = "('0x' || substr(md5({}), 1, 13))::BIGINT"
_GROUP = f"CASE WHEN source IN ({', '.join(map(quoted, WEIGHTS))}) THEN source END"
ORACLES["op1_mix_sources"] = f"""
WITH RECURSIVE w(g, w) AS (VALUES {", ".join(f"({quoted(g)}, {w}::DOUBLE)" for g, w in WEIGHTS.items())}, (NULL, {OTHER_WEIGHT}::DOUBLE)),
d AS (SELECT *, {_GROUP} AS g, coalesce(doc_id::VARCHAR, '') AS id FROM documents),
s AS (SELECT g, sum(octet_length(encode(coalesce(text, ''))))::BIGINT AS n FROM d GROUP BY g),
t AS (SELECT s.g, s.n, w.w, (SELECT sum(n) FROM s)::BIGINT AS total, (SELECT sum(w.w) FROM s JOIN w ON s.g IS NOT DISTINCT FROM w.g WHERE s.n > 0) AS whole
      FROM s JOIN w ON s.g IS NOT DISTINCT FROM w.g WHERE s.n > 0),
r AS (SELECT g, 1.0::DOUBLE * total * w / whole / n AS mean FROM t),
steps AS (SELECT g, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM r
          UNION ALL SELECT g, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM steps WHERE k < 200),
u AS (SELECT *, {_UNIT.format("'mix|count0|' || id")} / {1 << 52}::DOUBLE AS u FROM d),
n AS (SELECT u.* EXCLUDE (u), (SELECT count(*) FROM steps WHERE steps.g IS NOT DISTINCT FROM u.g AND c < 1 AND c <= u.u) AS n FROM u),
e AS (SELECT *, unnest(range(1, n + 1)) AS copy FROM n)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy, {_UNIT.format("'mix|place|' || id || '|' || copy")} AS shuffle_key FROM e
"""


@query
def op2_contamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_licences(spark, sf_dir):
    return scan_licences(table(spark, sf_dir, "documents"))


def _licence_sql() -> str:
    known = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in {normal_form(s): i for s, i in SENTENCES.items()}.items())
    either = "|".join(n.replace(" ", r"(?: |\x02\x02)") for n in sorted({normal_form(s) for s in SENTENCES}, key=len, reverse=True))
    rest = "coalesce(string_agg('<' || id || '>', '' ORDER BY n), '')"
    for k, (_, sequence) in enumerate(RULES):
        rest = f"replace({rest}, {quoted(''.join(f'<{i}>' for i in sequence))}, '[{k}]')"
    by: dict[str, list[int]] = {}
    for k, (name, _) in enumerate(RULES):
        by.setdefault(name, []).append(k)
    found = ", ".join("CASE WHEN " + " OR ".join(f"contains(rest, '[{k}]')" for k in ks) + f" THEN {quoted(n)} END" for n, ks in by.items())
    return f"""
WITH known(s, id) AS (VALUES {known}),
d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
e AS (SELECT r, regexp_replace(regexp_replace(translate(t, chr(2), ' '), '{SENTENCE_END}', chr(1), 'g'), '{PARAGRAPH}', chr(1), 'g') AS t FROM d
      WHERE {" OR ".join(f"contains(t, '{x}')" for x in TRIGGERS)}),
b AS (SELECT r, regexp_replace(translate(t, chr(10), chr(2)), '[^a-z0-9\\x01\\x02]+', ' ', 'g') AS t FROM e),
m AS (SELECT r, regexp_replace(regexp_replace(chr(1) || t || chr(1), '[ \\x02]{{2,}}', chr(2), 'g'), '[ \\x01\\x02]{{2,}}', chr(1), 'g') AS t FROM b),
q AS (SELECT r, regexp_extract_all(replace(replace(t, chr(1), chr(1) || chr(1)), chr(2), chr(2) || chr(2)), '[\\x01\\x02]({either})[\\x01\\x02]', 1) AS ss FROM m),
l AS (SELECT r, unnest(range(len(ss))) AS n, replace(unnest(ss), chr(2) || chr(2), ' ') AS s FROM q),
i AS (SELECT r, n, id FROM l JOIN known USING (s)),
g AS (SELECT d.doc_id, d.r, count(id) AS n_known, coalesce(string_agg(id, ',' ORDER BY n), '') AS sentence_ids, {rest} AS rest FROM d LEFT JOIN i USING (r) GROUP BY ALL)
SELECT doc_id, n_known, sentence_ids, concat_ws(',', {found}) AS licences, length(rest) - length(replace(rest, '<', '')) AS n_unmatched FROM g
"""


ORACLES["op3_licences"] = _licence_sql()


@query
def op4_suffix_tree(spark, sf_dir):
    return text_scores(table(spark, sf_dir, "documents"))


@query
def op5_secrets(spark, sf_dir):
    return scan_secrets(table(spark, sf_dir, "documents"))


@query
def op6_jaccard_components(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))


ORACLES["op6_jaccard_components"] = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
i AS (SELECT r, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM d WHERE len(ws) > 0),
s AS (SELECT DISTINCT r, list_slice(ws, i, i + 3) AS s FROM i),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS both_ FROM s a JOIN s b ON a.s = b.s AND a.r < b.r GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * both_ >= 85 * (x.n + y.n - both_)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c AS (SELECT r, r AS to_ FROM n UNION SELECT c.r, e.b FROM c JOIN e ON e.a = c.to_),
m AS (SELECT c.r, min(d.doc_id) AS least FROM c JOIN d ON d.r = c.to_ GROUP BY c.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE least END AS component_id FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)
"""


@query
def op7_token_counts(spark, sf_dir):
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op8_quality_scores(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents")).drop("text_hash")


_FOLD = "translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789' || chr(9) || chr(11) || chr(12) || chr(13), 'abcdefghijklmnopqrstuvwxyz000000000    ')"
ORACLES["op9_quality_rules"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
b AS (SELECT *, {WORDS.format("t")} AS ws FROM d),
v AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM b),
x AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS times FROM v),
y AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM x WHERE times > 1) GROUP BY r),
l AS (SELECT r, host, t, unnest(string_split(t, chr(10))) AS l FROM d),
m AS (SELECT r, host, t, l, trim({_FOLD}, ' ') AS f, len({WORDS.format("l")}) AS n FROM l WHERE len({WORDS.format("l")}) > 0),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM m GROUP BY r),
c AS (SELECT host, f FROM m GROUP BY host, f HAVING count(DISTINCT t) > 20),
lost AS (SELECT r, sum(n) AS words, count(*) AS lines FROM m JOIN c USING (host, f) GROUP BY r),
s AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
      length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(y.n, 0) AS n_repeat_words,
      coalesce(lost.lines, 0)::BIGINT AS n_common_lines, coalesce(lost.words, 0)::BIGINT AS n_common_words
      FROM b LEFT JOIN y USING (r) LEFT JOIN dup USING (r) LEFT JOIN lost USING (r)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT *, NOT base_failed AND NOT (n_words - n_common_words < 50 OR n_common_words > 0.7 * n_words) AS kept FROM f
"""


@query
def op10_remove_repeats(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


# Bytes as pairs of hex digits; windows are told apart by their MD5.
ORACLES["op10_remove_repeats"] = """
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, o, md5(substr(h, 2 * o + 1, 200)) AS w FROM (SELECT r, h, unnest(range(length(h) // 2 - 99)) AS o FROM d)),
t AS (SELECT r, o, o + 100 AS e FROM (SELECT r, o, row_number() OVER (PARTITION BY w ORDER BY r, o) AS k FROM w) WHERE k > 1),
f AS (SELECT r, o, e, o > coalesce(lag(e) OVER (PARTITION BY r ORDER BY o), -1) AS fresh FROM t),
g AS (SELECT r, o, e, sum(fresh::INT) OVER (PARTITION BY r ORDER BY o) AS g FROM f),
s AS (SELECT r, min(o) AS o, max(e) AS e FROM g GROUP BY r, g),
k AS (SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY o), 0) AS a, o AS b FROM s UNION ALL SELECT d.r, coalesce(max(e), 0), max(length(h) // 2) FROM d LEFT JOIN s USING (r) GROUP BY d.r),
x AS (SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS kept FROM k JOIN d USING (r) GROUP BY r),
n AS (SELECT r, sum(e - o) AS n, count(*) AS spans FROM s GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n.n, 0)::BIGINT AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN x USING (r) LEFT JOIN n USING (r)
"""


@query
def op11_centroid_clusters(spark, sf_dir):
    return centroid_clusters(table(spark, sf_dir, "embeddings"))


def _centroid_sql(k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3) -> str:
    far = f"list_sum([(v[j] - c[j]) * (v[j] - c[j]) FOR j IN range(1, {size + 1})])::BIGINT"
    steps = [
        f"""w AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [floor({scale} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE len(embedding) = {size} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {size})""",
        f"""c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY h, v) - 1)::INT AS k, v AS c FROM (SELECT sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM w ORDER BY h, v LIMIT {k}))""",
    ]
    for n in range(rounds + 1):
        steps.append(f"a{n} AS MATERIALIZED (SELECT r, min(x) AS x FROM (SELECT r, {{'d': {far}, 'k': k}} AS x FROM w, c{n}) GROUP BY r)")
        if n < rounds:
            mean = "[(s - ((s % n) + n) % n) // n FOR s IN ss]"
            each = ", ".join(f"sum(v[{j}])::BIGINT" for j in range(1, size + 1))
            steps.append(f"s{n} AS (SELECT x.k AS k, count(*) AS n, [{each}] AS ss FROM w JOIN a{n} USING (r) GROUP BY x.k)")
            steps.append(f"c{n + 1} AS MATERIALIZED (SELECT c.k, CASE WHEN s.k IS NULL THEN c ELSE {mean} END AS c FROM c{n} c LEFT JOIN s{n} s ON c.k = s.k)")
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, x.k AS cluster, x.d AS distance, (sum(x.d) OVER (PARTITION BY x.k))::BIGINT AS cluster_inertia, (sum(x.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM w JOIN a{rounds} USING (r) JOIN c{rounds} c ON c.k = x.k
"""


ORACLES["op11_centroid_clusters"] = _centroid_sql()


@query
def op12_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents")).drop("path_words")


ORACLES["op12_collocations"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, w[i : i + k - 1] AS g FROM i, range(1, 6) t(k) WHERE i + k - 1 <= len(w)),
f AS MATERIALIZED (SELECT lang, g, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1),
s AS (SELECT c.lang, c.g, c.a, k, x.f AS l, y.f AS r, n, ((1000 * c.a::HUGEINT * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
      FROM c JOIN n USING (lang) JOIN f x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (SELECT lang, g[i : i + k - 1] AS g, max(f) AS f FROM (SELECT lang, g, f, unnest(range(1, len(g) + 1)) AS i FROM f), range(2, 5) t(k) WHERE k < len(g) AND i + k - 1 <= len(g) GROUP BY ALL),
o AS (SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM b LEFT JOIN inside x ON x.lang = b.lang AND x.g = b.g WHERE x.f IS NULL OR 100 * x.f < 100 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o QUALIFY rank <= 2000
"""


@query
def op13_personal_data(spark, sf_dir):
    return find_personal(table(spark, sf_dir, "documents"))
