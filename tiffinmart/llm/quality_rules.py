"""Quality rules: shape of a text, and lines that too many documents of one host share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffinmart.llm.frames import LOWER, SEPARATORS, UPPER, pick
from tiffinmart.llm.storage import settled

SYMBOLS = "#*$%&|<>"
GAP = "[ \\t-\\r]+"
#: Upper case, digits and blanks of a line that make no difference to it.
FOLD = UPPER + "123456789" + "\t\x0b\x0c\r", LOWER + "0" * 9 + " " * 4


def _word_count(line):
    bare = F.btrim(line, F.lit(SEPARATORS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, GAP)))


def document_shape(docs: DataFrame) -> DataFrame:
    """doc_id, host, text_hash, lines (hash of the normal form and words of each) and the counts of the base rules, one
    row per row of `docs`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.btrim(text, F.lit(SEPARATORS))
    d = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("host"), text.alias("text"))
    d = d.withColumns(
        {
            "text_hash": F.xxhash64("text"),
            "words": F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, GAP)),
            "lines": F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SEPARATORS)) != ""),
        }
    )
    d = d.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "windows": F.transform(
                F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
                lambda x, i: F.xxhash64(x, F.get("words", i + 1), F.get("words", i + 2)),
            ),
        }
    )
    # Only texts that repeat a window at all sort theirs: the places of equal neighbours, and two words after each.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    d = d.withColumn("ordered", F.when(repeats, placed))
    neighbour = lambda i: F.get("ordered", i)["h"]
    twice = F.filter(
        "ordered", lambda x, i: F.coalesce(neighbour(i - 1) == x["h"], F.lit(False)) | F.coalesce(neighbour(i + 1) == x["h"], F.lit(False))
    )
    covered = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.sequence(x["i"], x["i"] + 2))))
    return d.select(
        "doc_id",
        "host",
        "text_hash",
        F.transform("lines", lambda x: F.struct(line_hash(x).alias("line_hash"), _word_count(x).alias("n"))).alias("lines"),
        "n_words",
        F.length(F.translate("text", SEPARATORS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("ordered").isNotNull(), F.size(covered)).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def line_hash(line):
    """Hash of the normal form of a line."""
    return F.xxhash64(F.btrim(F.translate(line, *FOLD), F.lit(" ")))


def quality_rules(docs: DataFrame, min_docs: int = 20, min_words: int = 50, max_lost: float = 0.7) -> DataFrame:
    """One row per row of `docs`: the base counts, the words lost with lines that are common on the host, a verdict.

    A line is common when more than `min_docs` distinct texts of its host (`source`; null counts as the empty name)
    have it in normal form (case, digits and blanks folded). Common lines go; a text that is left with under
    `min_words` words, or loses more than `max_lost` of them, is depleted and rejected. So are texts that fail the base
    rules: under 50 words, or over half of the words in repeated three-word windows. A null or empty text has no words
    and fails; repeated rows each get a row; no documents give no rows; other columns are not read. Texts are told
    apart by a 64-bit hash. The texts are read once; their counts and the hashes of their lines are written down.
    """
    return judged(docs, min_docs, min_words, max_lost).drop("host", "common")


def judged(docs: DataFrame, min_docs: int = 20, min_words: int = 50, max_lost: float = 0.7) -> DataFrame:
    """What `quality_rules` gives, the host, and the hashes of the common lines of the text (null if it has none)."""
    shapes = document_shape(pick(docs, "doc_id", "text", "source")).withColumn("row", F.monotonically_increasing_id())
    shapes = settled(shapes, "shapes")
    lines = shapes.select("row", "host", "text_hash", F.explode("lines").alias("line")).select("row", "host", "text_hash", "line.*")
    # Copies of a text say the same about their lines, so they count as one document.
    spread = lines.select("host", "line_hash", "text_hash").distinct().groupBy("host", "line_hash").agg(F.count("*").alias("n_texts"))
    common = spread.filter(F.col("n_texts") > min_docs).select("host", "line_hash")
    lost = (
        lines.join(common, ["host", "line_hash"])
        .groupBy("row")
        .agg(F.sum("n").alias("n_common_words"), F.count("*").alias("n_common_lines"), F.collect_set("line_hash").alias("common"))
    )
    out = shapes.drop("lines").join(lost, "row", "left")
    left = F.col("n_words") - F.col("n_common_words")
    depleted = (left < min_words) | (F.col("n_common_words") > max_lost * F.col("n_words"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.fillna(0, ["n_common_words", "n_common_lines"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "n_common_lines", "n_common_words",
        "text_hash", "host", "common",
    )


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The rows of `docs` that `quality_rules` keeps, without the common lines of their texts, and `n_chars` counted
    anew where lines went. All else comes back as it was. A null or empty text is rejected; repeated rows each stay or
    go; no documents give no rows; columns of other names are passed on."""
    names = list(docs.columns)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index('text')}"
    verdict = judged(docs, **limits).select(F.xxhash64("doc_id", "host", "text_hash").alias("key"), "kept", "common")
    host, text_hash = F.coalesce(f"c{names.index('source')}", F.lit("")), F.xxhash64(F.coalesce(text, F.lit("")))
    keyed = plain.withColumn("key", F.xxhash64(f"c{names.index('doc_id')}", host, text_hash))
    good = keyed.join(verdict.filter("kept").select("key", "common").dropDuplicates(["key"]), "key")
    left = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains("common", line_hash(x))), "\n")
    good = good.withColumn(text, F.when(F.col("common").isNull(), F.col(text)).otherwise(left))
    if "n_chars" in names:
        chars = f"c{names.index('n_chars')}"
        kind = plain.schema[chars].dataType
        good = good.withColumn(chars, F.when(F.col("common").isNull(), F.col(chars)).otherwise(F.length(text).cast(kind)))
    return good.drop("key", "common").toDF(*names)
