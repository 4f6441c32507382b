"""Intermediate tables of iterative operators, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tiffinmart.session import shared_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared folder and read back; the folder goes when the session ends."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    # What was made on the way is not needed once the table stands: shuffle files go with the query that wrote them.
    before = spark.conf.get(_CLEANUP, None)
    if before is not None:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is not None:
            spark.conf.set(_CLEANUP, before)
    system, folder = _folder(spark, path)
    system.deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Removes the folder of a table that `settled` gave and that nothing reads any more."""
    for file in df.inputFiles()[:1]:
        system, folder = _folder(df.sparkSession, file)
        system.delete(folder.getParent(), True)
