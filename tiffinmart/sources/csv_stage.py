"""CSV files into append-only, all-text stage tables with file lineage."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffinmart import entities
from tiffinmart.entities import AUDIT, Entity
from tiffinmart.session import materialized, shuffles_released
from tiffinmart.sources.files import fingerprints, list_files, readable, relative_name
from tiffinmart.sources.ledger import pending_files, read_ledger, unseen_files

CORRUPT = "_corrupt_record"

# The CSV format of the landing files.
CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "recursiveFileLookup": "true",
}


def csv_options(strict: bool = False) -> dict[str, str]:
    """Tolerant by default: ragged rows are padded or cut and kept in `_corrupt_record`.
    `strict` aborts on the first of them."""
    if strict:
        return {**CSV_OPTIONS, "mode": "FAILFAST", "enforceSchema": "true"}
    return {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "enforceSchema": "true"}


def csv_schema(entity: Entity | str, strict: bool = False) -> T.StructType:
    schema = entities.get(entity).stage_schema()
    return schema if strict else T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def scan_csv(
    spark: SparkSession, entity: Entity | str, path: str | Sequence[str], strict: bool = False
) -> DataFrame:
    """Rows of one file, a prefix or a list of files as text, columns bound by position.

    One record per line, so a large file is split over many tasks. `_corrupt_record` is only
    reliable when all columns are read, as a stage load does: Spark skips checks on pruned ones.
    """
    return (
        spark.read.schema(csv_schema(entity, strict))
        .options(**csv_options(strict))
        .csv(path if isinstance(path, str) else list(path))
    )


def with_lineage(df: DataFrame, batch_ts: datetime | str | Column, root: str | None = None) -> DataFrame:
    """Adds `_stg_file_name` (below `root`), `_stg_file_load_ts`, `_copy_data_ts` and `_path`."""
    ts = batch_ts if isinstance(batch_ts, Column) else F.lit(batch_ts).cast("timestamp")
    named = df.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("_stg_file_load_ts"),
        ts.cast("timestamp_ntz").alias("_copy_data_ts"),
    )
    return named.withColumn("_stg_file_name", relative_name("_path", root) if root else F.col("_path"))


def load_stage(
    spark: SparkSession,
    entity: Entity | str,
    path: str | Sequence[str],
    batch_ts: datetime | str | Column,
    root: str | None = None,
    strict: bool = False,
    prints: DataFrame | None = None,
    only: bool = False,
) -> DataFrame:
    """Stage rows of the files: text columns plus the four audit columns.

    `prints` are the files' fingerprints, when the caller has them already; with `only`, files without
    one are left out.
    """
    e = entities.get(entity)
    rows = with_lineage(scan_csv(spark, e, path, strict), batch_ts, root)
    columns = [*e.source_columns, *AUDIT, *([] if strict else [CORRUPT])]
    known = fingerprints(spark, path) if prints is None else prints
    return with_fingerprints(rows, known, "inner" if only else "left").select(*columns)


def with_fingerprints(rows: DataFrame, prints: DataFrame, how: str = "left") -> DataFrame:
    """Adds `_stg_file_md5` by `_path`. One row per file: Spark broadcasts them while they are small
    and shuffles otherwise."""
    return rows.join(
        prints.select(F.col("path").alias("_path"), F.col("md5").alias("_stg_file_md5")), "_path", how
    )


def copy_into(
    spark: SparkSession,
    entity: Entity | str,
    path: str | Sequence[str],
    stage_path: str,
    ledger_path: str,
    load_id: int,
    batch_ts: datetime | str,
    root: str | None = None,
    strict: bool = False,
    most_names: int = 100_000,
) -> int:
    """Append the files not loaded yet to the stage table and record them. Returns the file count.

    A listing against the ledger comes first, by path, length and time: what is as it was loaded is not opened again.
    Of the rest the content is fingerprinted, so a file that was only touched is not loaded twice, and changed content
    under an old name is. Rows are read from the pending files alone, if they are at most `most_names`; of more, Spark
    reads the prefix and drops the rows of others, which spares the driver the list.

    The rows of a load live in their own `load_id` folder, so repeating a failed load replaces
    its rows; the ledger is written last. A finished load's number cannot be used again.
    """
    e = entities.get(entity)
    ledger = read_ledger(spark, ledger_path)
    if ledger.filter((F.col("table_name") == e.name) & (F.col("load_id") == load_id)).limit(1).count():
        raise ValueError(f"load {load_id} of {e.name} is already recorded")
    with materialized(unseen_files(list_files(spark, path), ledger, e.name), "unseen-files") as unseen:
        n_unseen = unseen.count()
        if not n_unseen:
            return 0
        looked_at = readable(unseen) if n_unseen <= most_names else path
        prints = fingerprints(spark, looked_at).join(unseen.select(F.col("path").alias("_unseen")), F.col("path") == F.col("_unseen"), "left_semi")
        return _copy_files(spark, e, looked_at, pending_files(prints, ledger, e.name), stage_path, ledger_path, load_id, batch_ts, root, strict)


def _copy_files(spark, e: Entity, path, pending: DataFrame, stage_path: str, ledger_path: str, load_id: int, batch_ts, root, strict: bool) -> int:
    # Content is hashed once; the result serves the file list, the rows and the ledger.
    with materialized(pending, "pending-files") as prints:
        n_files = prints.count()
        if not n_files:
            return 0
        target = f"{stage_path}/load_id={load_id}"
        with shuffles_released(spark):
            load_stage(spark, e, path, batch_ts, root, strict, prints, only=True).write.mode("overwrite").parquet(target)

        written = spark.read.parquet(target)
        bad = F.lit(False) if strict else F.col(CORRUPT).isNotNull()
        counts = written.groupBy("_stg_file_name", F.col("_stg_file_md5").alias("md5")).agg(
            F.count(F.lit(1)).alias("row_count"), F.count_if(bad).alias("corrupt_count")
        )
        name = relative_name("path", root) if root else F.col("path")
        loaded = (
            prints.withColumn("_stg_file_name", name)
            .join(counts, ["_stg_file_name", "md5"], "left")
            .select(
                F.lit(e.name).alias("table_name"),
                "path",
                "md5",
                "length",
                F.lit(load_id).cast("bigint").alias("load_id"),
                F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"),
                F.coalesce("corrupt_count", F.lit(0)).cast("bigint").alias("corrupt_count"),
                F.lit(batch_ts).cast("timestamp").alias("load_ts"),
                "modified_at",
            )
        )
        with shuffles_released(spark):
            loaded.write.mode("append").parquet(ledger_path)
        return n_files


def read_stage(spark: SparkSession, entity: Entity | str, stage_path: str, strict: bool = False) -> DataFrame:
    """The stage table; `load_id` is a partition column, so an offset filter prunes folders."""
    e = entities.get(entity)
    schema = T.StructType(
        [
            *e.stage_schema().fields,
            T.StructField("_stg_file_name", T.StringType()),
            T.StructField("_stg_file_load_ts", T.TimestampNTZType()),
            T.StructField("_stg_file_md5", T.StringType()),
            T.StructField("_copy_data_ts", T.TimestampNTZType()),
            T.StructField(CORRUPT, T.StringType()),
            T.StructField("load_id", T.LongType()),
        ]
    )
    return spark.read.schema(schema).parquet(stage_path)
