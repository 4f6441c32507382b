"""Dense surrogate numbers without a global sort in one task."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiffinmart.store import SnapshotTable


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; set one of our own only on a local master without any."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tiffinmart-checkpoint-"))


def add_sequence(df: DataFrame, order: Sequence[str], start: int = 1, name: str = "sk") -> DataFrame:
    """Number the rows start, start+1, ... in the order given, which should be unique.

    Rows are range-partitioned and sorted inside each range; the position inside the range plus
    the sizes of the ranges before it is the number. The ranges are checkpointed once, because
    sizes and positions must come from the same split of the data.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id is (range number << 33) + position in the range.
    placed = ranged.withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    placed = placed.withColumn("_range", F.shiftright("_id", 33)).withColumn(
        "_pos", F.col("_id").bitwiseAND((1 << 33) - 1)
    )
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range, so this window without a partition is as small as the number of tasks.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    number = (F.col("_offset") + F.col("_pos") + F.lit(start)).cast("bigint")
    return placed.join(F.broadcast(offsets), "_range").select(*df.columns, number.alias(name))


def append_numbered(table: SnapshotTable, rows: DataFrame, order: Sequence[str], batch_id: int, name: str = "sk") -> int | None:
    """Append `rows` as batch `batch_id`, numbered from where the batch before ended; the new version, or None.

    The last number is published in the table's log together with the rows, so numbers go on without gaps over loads,
    a batch that fails gives none out, and one that is repeated changes nothing. Only slices with new rows are written.
    """
    done = table.batch_id()
    if done is not None and done >= batch_id:
        return None
    last = table.mark(name) if table.exists() else 0
    # `add_sequence` has checkpointed the rows, so they are counted, dealt and written from there.
    numbered = add_sequence(rows, order, last + 1, name)
    n = numbered.count()
    touched = table.touched_slices(numbered) if table.exists() else None
    whole = numbered if touched is None else table.read(slices=touched).unionByName(numbered)
    return table.commit(whole, batch_id, touched, {name: last + n})
