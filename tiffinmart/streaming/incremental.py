"""Incremental loads: a file stream whose micro-batches run the batch operators.

The checkpoint is the offset of the landing folder: a file is read once. `foreachBatch` may run
a batch again after a failure; every step recognises a batch it has already published.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffinmart import entities
from tiffinmart.entities import AUDIT, Entity
from tiffinmart.plans.warehouse import Warehouse
from tiffinmart.session import materialized, shuffles_released
from tiffinmart.sources.csv_stage import (
    CORRUPT, csv_options, csv_schema, read_stage, with_fingerprints, with_lineage,
)
from tiffinmart.sources.files import fingerprints

FILES_PER_BATCH = 1000


def drain(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run `step` on everything that is waiting, then stop."""
    query = (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_csv(
    spark: SparkSession,
    entity: Entity | str,
    source_dir: str,
    batch_ts: datetime | str,
    files_per_batch: int = FILES_PER_BATCH,
    root: str | None = None,
) -> DataFrame:
    """Streaming stage rows of the CSV files below `source_dir`, without the fingerprint."""
    rows = (
        spark.readStream.schema(csv_schema(entity))
        .options(**csv_options())
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(source_dir)
    )
    return with_lineage(rows, batch_ts, root)


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The number that Spark gives a checkpoint when it makes it."""
    row = spark.read.json(f"{checkpoint}/metadata").select("id").first()
    return row["id"]


def claim(warehouse: Warehouse, entity: Entity | str, checkpoint: str) -> None:
    """Binds an entity's stage table to its checkpoint. Batch numbers of another one start again, so they
    would replace stage rows and be taken for batches that are already in."""
    e = entities.get(entity)
    own = checkpoint_id(warehouse.spark, checkpoint)
    path = warehouse.spark._jvm.org.apache.hadoop.fs.Path(f"{warehouse.root}/checkpoints/{e.name}")
    fs = path.getFileSystem(warehouse.spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        stream = fs.create(path, False)
        stream.write(bytearray(own, "utf-8"))
        stream.close()
        return
    known = warehouse.spark.read.text(f"{warehouse.root}/checkpoints/{e.name}").first()[0]
    if known != own:
        raise ValueError(f"{e.name} belongs to another checkpoint than {checkpoint}")


def append_stage_batch(warehouse: Warehouse, entity: Entity | str, rows: DataFrame, batch_id: int) -> None:
    """Write one micro-batch as its own `load_id` folder; a repeat replaces it.

    The text files are parsed once, into columns; their names, at most `files_per_batch`, and the
    rows are then read from there.
    """
    e = entities.get(entity)
    with materialized(rows, f"batch-{e.name}") as parsed:
        # At most `files_per_batch` names, which is what they are there for.
        files = [r["_path"] for r in parsed.select("_path").distinct().collect()]
        if files:
            # As few rows go to every task; the size of an aggregate is not known, and rows would be shuffled for it.
            parsed = with_fingerprints(parsed, F.broadcast(fingerprints(warehouse.spark, files)))
        else:
            parsed = parsed.withColumn("_stg_file_md5", F.lit(None).cast("string"))
        target = f"{warehouse.stage_path(e)}/load_id={batch_id}"
        staged = parsed.select(*e.source_columns, *AUDIT, CORRUPT)
        with shuffles_released(staged.sparkSession):
            staged.write.mode("overwrite").parquet(target)


def run_incremental(
    warehouse: Warehouse,
    entity: Entity | str,
    source_dir: str,
    checkpoint: str,
    batch_ts: datetime | str,
    then: Sequence[str] = ("clean", "dim"),
    files_per_batch: int = FILES_PER_BATCH,
    root: str | None = None,
) -> None:
    """Ingest the waiting files of an entity and carry each micro-batch on to the layers in
    `then`: clean upsert, dimension versions, fact upsert.

    Micro-batches reach stage and clean table one by one; dimension and fact follow once, when all have
    arrived, from the change between their last version and the newest. So the result does not depend
    on how files fall into batches.

    Batch numbers come from the checkpoint and mark what the tables hold, so a warehouse keeps one
    checkpoint per entity for good; another one is refused. An entity is either streamed or loaded by
    `Warehouse.load`.
    """
    e = entities.get(entity)

    def step(rows: DataFrame, batch_id: int) -> None:
        claim(warehouse, e, checkpoint)
        append_stage_batch(warehouse, e, rows, batch_id)
        if "clean" in then:
            stage = read_stage(warehouse.spark, e, warehouse.stage_path(e))
            warehouse.merge_clean(e, stage.filter(F.col("load_id") == batch_id), batch_id)

    drain(stream_csv(warehouse.spark, e, source_dir, batch_ts, files_per_batch, root), step, checkpoint)
    if "dim" in then and e.dimension:
        warehouse.refresh_dim(e, batch_ts)
    if "fact" in then:
        warehouse.refresh_fact()
