"""Listing of the landing folder and content fingerprints of its files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """path, length, modified_at of every file under the prefixes; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths if isinstance(paths, str) else list(paths)).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("length"),
        F.col("modificationTime").alias("modified_at"),
    )


#: Bytes of the largest file that one task hashes whole. Reading and hashing take about four times that in memory.
WHOLE_FILE = 64 << 20


def fingerprints(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, largest: int = WHOLE_FILE
) -> DataFrame:
    """path, length, modified_at, md5 of every file.

    Files of up to `largest` bytes have the MD5 of their content; a task holds one of them at a time, in several copies
    while it is read and hashed. Larger ones are read line by line, in as many tasks as they have splits, and have
    `lines:` and an MD5 over length, number and summed MD5s of their lines: equal for equal lines in any order.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(paths if isinstance(paths, str) else list(paths))
    named = [F.col("_metadata.file_path").alias("path"), F.col("length"), F.col("modificationTime").alias("modified_at")]
    # The limit reaches the source, which opens no larger file.
    small = files.filter(F.col("length") <= largest).select(*named, F.md5("content").alias("md5"))
    large = files.filter(F.col("length") > largest).select(*named)
    # Few: each stands for more than `largest` bytes.
    names = readable(large)
    return small.unionByName(_line_digests(spark, names)) if names else small


def _line_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
        F.md5(F.col("value").cast("binary")).alias("h"),
    )
    half = [F.conv(F.substring("h", i, 15), 16, 10).cast("decimal(20,0)") for i in (1, 16)]
    sums = lines.groupBy("path", "length", "modified_at").agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(half)])
    digest = F.md5(F.concat_ws("|", F.col("length").cast("string"), F.col("n").cast("string"), F.col("s0").cast("string"), F.col("s1").cast("string")).cast("binary"))
    return sums.select("path", "length", "modified_at", F.concat(F.lit("lines:"), digest).alias("md5"))


def decoded(path: str) -> Column:
    # Paths come percent-encoded, but with a plain '+', which decoding would turn into a space.
    return F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))


def readable(listing: DataFrame) -> list[str]:
    """The paths of a listing as a reader takes them: decoded, and with nothing left that stands for other names."""
    plain = listing.select(F.regexp_replace(decoded("path"), r"([\[\]{}*?\\])", r"\\$1").alias("p"))
    return [r["p"] for r in plain.orderBy("p").collect()]


def relative_name(path: str, root: str) -> Column:
    """File path below the landing root, such as initial/location/a.csv."""
    base = root.split(":", 1)[-1].strip("/")
    return F.regexp_replace(decoded(path), "^.*?" + _quote(base) + "/+", "")


def _quote(text: str) -> str:
    return "\\Q" + text + "\\E"
