"""What has been loaded: one ledger row per (table, file)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = (
    "table_name string, path string, md5 string, length bigint, load_id bigint, "
    "row_count bigint, corrupt_count bigint, load_ts timestamp, modified_at timestamp"
)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, empty before the first load."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def pending_files(listing: DataFrame, ledger: DataFrame, table: str) -> DataFrame:
    """Files of the listing the table has not loaded yet, by path and content."""
    done = ledger.filter(F.col("table_name") == table).select("path", "md5")
    return listing.join(done, ["path", "md5"], "left_anti")


def unseen_files(listing: DataFrame, ledger: DataFrame, table: str) -> DataFrame:
    """Files of the listing that are not as the table has loaded them, by path, length and time: no content is needed.

    A file among them may still have the content that was loaded; `pending_files` tells by its fingerprint. Ledger rows
    without a time, from before it was recorded, count as unseen."""
    done = ledger.filter((F.col("table_name") == table) & F.col("modified_at").isNotNull()).select("path", "length", "modified_at")
    return listing.join(done, ["path", "length", "modified_at"], "left_anti")


def copy_history(ledger: DataFrame, table: str, now: datetime | str | Column, hours: int = 1) -> DataFrame:
    """Loads of a table within the last `hours` before `now`."""
    at = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    return ledger.filter(
        (F.col("table_name") == table) & (F.col("load_ts") >= at - F.make_dt_interval(hours=F.lit(hours)))
    )
