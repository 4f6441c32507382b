"""A fact that grows by files, kept clustered on one key: only files whose key ranges overlap too deeply are rewritten.

    root/data/_batch=3/order_year=2024/order_month=5/_piece=.../part-*.parquet     what one step wrote, never changed
    root/files, root/columns                      SnapshotTables: which files count, with their ranges; the schema

A step becomes visible with the commit of the list of files, whole or not at all; what a failed step wrote is not listed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffinmart.plans.fact import LAYOUT
from tiffinmart.session import empty_frame
from tiffinmart.store import SnapshotTable

#: Listed of each file, beside its month.
RANGE = ("file", "low", "high", "file_rows")


def overlaps(files: DataFrame, month: Sequence[str] = LAYOUT, most_depth: int = 4) -> DataFrame:
    """`files` with deepest (how many files of its month lie over its low end, of those that begin there only itself and
    the ones named before it; the largest is the depth of the month) and cluster (null, or the number of the group of
    overlapping files it is to be rewritten with).

    Files of one value are left out: nothing prunes better, and a value of many files cannot overlap less. Chosen are
    the files over any place deeper than `most_depth`. One window over the files of a month, never over rows.
    """
    wide = files.filter("low < high")
    ends = F.explode(F.array(F.struct(F.col("low").alias("at"), F.lit(0).alias("closes")), F.struct(F.col("high").alias("at"), F.lit(1).alias("closes"))))
    line = Window.partitionBy(*month).orderBy("at", "closes", "file").rowsBetween(Window.unboundedPreceding, 0)
    swept = wide.select(*month, "file", ends.alias("e")).select(*month, "file", "e.*")
    swept = swept.withColumn("depth", F.sum(1 - 2 * F.col("closes")).over(line))
    deep = ((F.col("closes") == 0) & (F.col("depth") > most_depth)).cast("int")
    swept = swept.withColumn("deep", deep).withColumn("so_far", F.sum("deep").over(line))
    opened, closed = F.col("closes") == 0, F.col("closes") == 1
    # A file lies over the deep places that are counted from its own opening to its close.
    place = swept.groupBy(*month, "file").agg(
        (F.max(F.when(closed, F.col("so_far"))) - F.max(F.when(opened, F.col("so_far") - F.col("deep")))).alias("over"),
        F.max(F.when(opened, F.col("depth"))).alias("depth"),
    )
    judged = wide.join(place, [*month, "file"])
    chosen = judged.filter("over > 0")
    by_low = Window.partitionBy(*month).orderBy("low", "file")
    starts = F.coalesce((F.col("low") > F.max("high").over(by_low.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1))
    chosen = chosen.withColumn("starts", starts).withColumn("cluster", F.sum("starts").over(by_low.rowsBetween(Window.unboundedPreceding, 0)))
    return judged.join(chosen.select(*month, "file", "cluster"), [*month, "file"], "left").select(*month, *RANGE, F.col("depth").alias("deepest"), "cluster")


def pieces(rows: DataFrame, key: str, group: Sequence[str], rows_per_file: int) -> DataFrame:
    """`rows` with _piece: stretches of about `rows_per_file` rows by `key` within a group, one file each.

    Counted exactly, so that pieces share no value of the key; a value of more rows than that has pieces of its own,
    by a hash of the row. `key` has few values within a group, such as the days of a month. A null key is its own value.
    """
    per = rows.groupBy(*group, key).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*group).orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    per = per.withColumn("_start", F.floor((upto - F.col("_n")) / rows_per_file)).withColumn("_parts", F.ceil(F.col("_n") / rows_per_file))
    same = [F.col(f"r.{x}").eqNullSafe(F.col(f"p.{x}")) for x in (*group, key)]
    # One row per group and value: broadcast, so that the rows move only once, to their pieces.
    out = rows.alias("r").join(F.broadcast(per).alias("p"), same).select("r.*", "_start", "_parts", F.xxhash64(*[F.col(f"r.{x}") for x in rows.columns]).alias("_hash"))
    split = F.concat_ws("-", F.lit("split"), F.col("_start").cast("string"), F.xxhash64(key).cast("string"), F.pmod("_hash", "_parts").cast("string"))
    piece = F.when(F.col("_parts") > 1, split).otherwise(F.concat_ws("-", F.lit("from"), F.col("_start").cast("string")))
    return out.withColumn("_piece", piece).drop("_start", "_parts", "_hash")


class ClusteredFact:
    """Fact rows below `root`, by year and month, with files of narrow ranges of `key`.

    Month columns and `key` may be null; such a key lies in a range without bounds, which overlaps nothing. An empty
    batch adds no file. Each step takes the number of its batch, and one that was done before does nothing.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "order_date_dim_key", rows_per_file: int = 4_000_000, most_depth: int = 4):
        if most_depth < 2:
            raise ValueError("files that share the value between them overlap twice: most_depth is 2 at least")
        self.spark, self.root, self.key = spark, root.rstrip("/"), key
        self.rows_per_file, self.most_depth = rows_per_file, most_depth
        self.files = SnapshotTable(spark, f"{self.root}/files", [], 0, LAYOUT)
        self.columns = SnapshotTable(spark, f"{self.root}/columns", [], 0, LAYOUT)

    def _write(self, rows: DataFrame, group: Sequence[str], batch: int) -> DataFrame:
        """Writes pieces and returns the list of their files. Only the key is read again, for the ranges."""
        folder = f"{self.root}/data/_batch={batch}"
        laid = pieces(rows, self.key, [*LAYOUT, *group], self.rows_per_file)
        laid = laid.withColumn("_piece", F.concat_ws("-", "_piece", *[F.col(g).cast("string") for g in group])).drop(*group)
        tidy = laid.repartition(*LAYOUT, "_piece").sortWithinPartitions(*LAYOUT, "_piece", self.key)
        tidy.write.mode("overwrite").partitionBy(*LAYOUT, "_piece").parquet(folder)
        schema = rows.drop(*group).schema
        written = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("_piece", T.StringType())])).parquet(folder)
        return written.groupBy(*LAYOUT, F.col("_metadata.file_path").alias("file")).agg(
            F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count(F.lit(1)).alias("file_rows")
        )

    def append(self, rows: DataFrame, batch: int) -> int | None:
        """Adds a batch as files of its own; the files that are there stay. The version, or None if it was done before."""
        if self._done(batch):
            return None
        if not self.files.exists():
            # The columns of the fact are those of its first batch.
            self.columns.commit(rows.limit(0), batch)
            return self.files.commit(self._write(rows, [], batch), batch)
        fresh = self._write(rows.select(*self.columns.schema().fieldNames()), [], batch)
        return self._publish(fresh, fresh, None, batch)

    def recluster(self, batch: int) -> list[str]:
        """Rewrites the files over places deeper than `most_depth`, with each other; the names of the files that went.
        Names alone reach the driver, as they do for any scan."""
        if self._done(batch) or not self.files.exists():
            return []
        chosen = overlaps(self.files.read(), LAYOUT, self.most_depth).filter("cluster is not null")
        old = [(r["file"], r["cluster"]) for r in chosen.select("file", "cluster").collect()]
        if not old:
            return []
        gone = self.spark.createDataFrame(old, "_file string, _cluster long")
        rows = self._rows([f for f, _ in old], F.col("_metadata.file_path").alias("_at"))
        rows = rows.join(F.broadcast(gone), F.col("_at") == F.col("_file")).drop("_at", "_file")
        fresh = self._write(rows, ["_cluster"], batch)
        self._publish(fresh, chosen, gone, batch)
        return sorted(f for f, _ in old)

    def depth(self) -> int:
        """Most files of a month that hold one value of the key, files of that value alone aside."""
        return overlaps(self.files.read(), LAYOUT, self.most_depth).agg(F.max("deepest")).first()[0] or 0

    def read(self, low=None, high=None) -> DataFrame:
        """The rows, or those with a key from `low` to `high`; of these only files whose range meets it are opened."""
        listed, within = self.files.read(), F.lit(True)
        if low is not None:
            listed, within = listed.filter(F.col("high") >= low), within & (F.col(self.key) >= low)
        if high is not None:
            listed, within = listed.filter(F.col("low") <= high), within & (F.col(self.key) <= high)
        return self._rows([r["file"] for r in listed.select("file").collect()]).filter(within)

    def _done(self, batch: int) -> bool:
        last = self.files.batch_id() if self.files.exists() else None
        return last is not None and batch <= last

    def _publish(self, fresh: DataFrame, touched: DataFrame, gone: DataFrame | None, batch: int) -> int:
        months = self.files.touched_slices(touched)
        kept = self.files.read(slices=months)
        if gone is not None:
            kept = kept.join(gone, F.col("file") == F.col("_file"), "left_anti")
        return self.files.commit(kept.unionByName(fresh), batch, months)

    def _rows(self, files: Sequence[str], *more: Column) -> DataFrame:
        schema = self.columns.schema()
        if not files:
            return empty_frame(self.spark, schema)
        full = T.StructType([*schema.fields, T.StructField("_piece", T.StringType()), T.StructField("_batch", T.LongType())])
        df = self.spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(*files)
        return df.select(*schema.fieldNames(), *more)
