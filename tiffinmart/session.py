"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def build_session(app: str = "tiffinmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for. On a cluster pass no master."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # The JVM never compiles methods above 8000 bytes; wide typed projections do better split up.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Plans are built from many expressions; recording a call site for each costs more than it tells.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder every executor can reach, below `spark.checkpoint.dir`.

    Only a local master may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tiffinmart-")
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex[:12]}")


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form Catalyst recognises as empty, so joins with it vanish from the plan."""
    nothing = spark.range(1).filter(F.lit(False))
    return nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_releasing: dict = {}


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write inside go when it ends, on all executors. Otherwise they stay until the driver
    collects its garbage, and a job of many steps keeps the shuffles of all of them.

    Meant for writes, whose result is read from files. The setting is the session's, so blocks of several threads
    count: the last one puts back what the first one found.
    """
    session = spark._jsparkSession
    with _lock:
        inside, found = _releasing.get(session, (0, None))
        if not inside:
            found = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _releasing[session] = (inside + 1, found)
    try:
        yield
    finally:
        with _lock:
            inside, found = _releasing.pop(session)
            if inside > 1:
                _releasing[session] = (inside - 1, found)
            elif found is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, found)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def remove_dir(spark: SparkSession, path: str) -> None:
    """Removes a folder that is not read again."""
    system, folder = _folder(spark, path)
    system.delete(folder, True)


def _store(df: DataFrame, path: str) -> DataFrame:
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written to the shared folder and read back: cuts the lineage, survives lost executors
    and gives later joins the true size. The folder goes when the session ends."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    out = _store(df, path)
    system, folder = _folder(spark, path)
    system.deleteOnExit(folder)
    return out


def materialize_all(frames: Mapping[str, DataFrame], purpose: str, at_once: int = 6) -> dict[str, DataFrame]:
    """`materialize` for several independent frames, whose jobs run side by side."""

    def store(name: str) -> DataFrame:
        return materialize(frames[name], f"{purpose}-{name}")

    spark = next(iter(frames.values())).sparkSession
    with ThreadPoolExecutor(at_once) as pool:
        tasks = {name: pool.submit(inheritable_thread_target(spark)(store), name) for name in frames}
        return {name: task.result() for name, task in tasks.items()}


@contextmanager
def materialized(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """`materialize` for the time of a block; the folder goes when the block ends."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    try:
        yield _store(df, path)
    finally:
        remove_dir(spark, path)
