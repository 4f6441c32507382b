"""Versioned Parquet tables: each commit is a new version, published by one small log file.

    root/data/_version=7/_bucket=3/part-*.parquet     the files written by version 7
    root/_log/00000007.json                    which slice lives in which version's folder

A slice is one value of the partition columns. A commit writes the slices it changed and points
to the older folders for all others, so a small delta rewrites a small part of a large table.
Files a log entry does not name are ignored, so a failed or repeated job leaves the table whole.
One writer per table.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffinmart.session import empty_frame, shuffles_released

BUCKET = "_bucket"
_NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"


class SnapshotTable:
    """`buckets` hash buckets on `key`, or the table's own columns `partition_by` (determined by
    the key, for example year and month of an immutable order date), or both."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key: Sequence[str],
        buckets: int = 16,
        partition_by: Sequence[str] = (),
    ):
        self.spark, self.root, self.key = spark, root.rstrip("/"), list(key)
        self.buckets, self.partition_by = buckets, list(partition_by)
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._fs = hadoop.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # -- log ---------------------------------------------------------------------------------

    def _log_file(self, version: int) -> str:
        return f"{self.root}/_log/{version:08d}.json"

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/_log")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:8]) for n in names if n.endswith(".json") and n[:8].isdigit())

    def version(self) -> int | None:
        found = self.versions()
        return found[-1] if found else None

    def _entry(self, version: int | None) -> dict:
        if version is None:
            return {"slices": {}, "batch_id": None, "schema": None, "marks": {}}
        stream = self._fs.open(self._path(self._log_file(version)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        entry = json.loads(text)
        laid_out = entry.get("layout", self._layout())
        if laid_out != self._layout():
            raise ValueError(f"{self.root} is cut into slices by {laid_out}, not by {self._layout()}")
        return entry

    def _layout(self) -> dict:
        """What decides the slice of a row; with another one, slices would be looked for in the wrong place."""
        return {"key": self.key if self.buckets else [], "buckets": self.buckets, "partition_by": self.partition_by}

    def batch_id(self) -> int | None:
        """Batch number of the newest version that carries one."""
        return self._entry(self.version())["batch_id"]

    def mark(self, name: str, version: int | None = None) -> int:
        """A number kept in the log from commit to commit, such as the last one a sequence gave out; 0 at first."""
        return self._entry(version if version is not None else self.version()).get("marks", {}).get(name, 0)

    def _publish(self, version: int, entry: dict) -> None:
        final = self._path(self._log_file(version))
        if self._fs.exists(final):
            raise RuntimeError(f"version {version} of {self.root} already exists: a second writer?")
        draft = self._path(f"{self.root}/_log/.{version:08d}.draft")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(entry), "utf-8"))
        finally:
            stream.close()
        if not self._fs.rename(draft, final):
            raise RuntimeError(f"could not publish version {version} of {self.root}")

    # -- slices ------------------------------------------------------------------------------

    @property
    def slice_columns(self) -> list[str]:
        return self.partition_by + ([BUCKET] if self.buckets else [])

    def _bucket(self) -> Column:
        # Text of the key, so that an int and a bigint column of the same value agree.
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.key]), F.lit(self.buckets)).cast("int")

    def with_slices(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, self._bucket()) if self.buckets else df

    def touched_slices(self, df: DataFrame) -> list[str]:
        """Slices that hold the keys of `df`; at most one value per slice reaches the driver."""
        rows = self.with_slices(df).select(*self.slice_columns).distinct().collect()
        return ["/".join(f"{c}={_NULL_VALUE if r[c] is None else r[c]}" for c in self.slice_columns) for r in rows]

    def _written_slices(self, version: int) -> list[str]:
        base = f"{self.root}/data/_version={version}"
        found = self._fs.globStatus(self._path(base + "/*=*" * len(self.slice_columns))) or []
        return ["/".join(s.getPath().toString().split("/")[-len(self.slice_columns):]) for s in found]

    # -- read --------------------------------------------------------------------------------

    def schema(self, version: int | None = None) -> T.StructType | None:
        text = self._entry(version if version is not None else self.version())["schema"]
        return T.StructType.fromJson(json.loads(text)) if text else None

    def exists(self) -> bool:
        return self.version() is not None

    def read(self, version: int | None = None, slices: Iterable[str] | None = None) -> DataFrame:
        """The table at a version (newest by default), optionally only some slices of it."""
        version = version if version is not None else self.version()
        entry = self._entry(version)
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        wanted = entry["slices"]
        if slices is not None:
            wanted = {s: wanted[s] for s in slices if s in wanted}
        if not wanted:
            return empty_frame(self.spark, schema)
        paths = [f"{self.root}/data/_version={v}/{s}" for s, v in sorted(wanted.items())]
        full = T.StructType(list(schema.fields))
        if self.buckets:
            full = full.add(BUCKET, T.IntegerType())
        full = full.add("_version", T.IntegerType())
        df = self.spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(*paths)
        return df.select(*schema.fieldNames())

    # -- write -------------------------------------------------------------------------------

    def commit(
        self, df: DataFrame, batch_id: int | None = None, replace: Sequence[str] | None = None, marks: dict[str, int] | None = None
    ) -> int:
        """Write `df` as the next version. `replace` names the slices it stands for; others carry
        over from the current version. Without it `df` is the whole table. `marks` change with the
        version or not at all; those not named stay."""
        before = self.version()
        old = self._entry(before)
        version = 0 if before is None else before + 1
        rows = self.with_slices(df).hint("rebalance", *self.slice_columns)
        with shuffles_released(rows.sparkSession):
            (
                rows.write.mode("overwrite")
                .option("partitionOverwriteMode", "static")
                .partitionBy(*self.slice_columns)
                .parquet(f"{self.root}/data/_version={version}")
            )
        kept = {} if replace is None else {s: v for s, v in old["slices"].items() if s not in set(replace)}
        slices = {**kept, **{s: version for s in self._written_slices(version)}}
        batch = batch_id if batch_id is not None else old["batch_id"]
        self._publish(version, {"batch_id": batch, "schema": df.schema.json(), "slices": slices, "layout": self._layout(), "marks": {**old.get("marks", {}), **(marks or {})}})
        return version

    def changed_slices(self, old: int | None, new: int) -> list[str]:
        a, b = self._entry(old)["slices"], self._entry(new)["slices"]
        return sorted(s for s in a.keys() | b.keys() if a.get(s) != b.get(s))

    def images(self, old: int | None, new: int) -> tuple[DataFrame | None, DataFrame]:
        """Both versions, limited to the slices in which they can differ; None for no old version."""
        if old is None:
            return None, self.read(new)
        slices = self.changed_slices(old, new)
        return self.read(old, slices), self.read(new, slices)
