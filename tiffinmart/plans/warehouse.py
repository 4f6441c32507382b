"""The whole path over versioned tables: files -> stage -> clean -> dimensions -> fact -> KPIs.

Every table records what it has consumed in the same log entry that publishes its new version
(load ids for clean tables, clean versions for dimensions and the fact). A step that is repeated
after a failure therefore does its work exactly once.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffinmart import entities
from tiffinmart.entities import DIMENSION_ENTITIES, Entity
from tiffinmart.operators.changes import append_changes, change_feed
from tiffinmart.operators.clean import clean_all, split_rejects
from tiffinmart.operators.merge import upsert_entity
from tiffinmart.operators.scd2 import scd2_attribute_match, scd2_keyed
from tiffinmart.plans import kpis
from tiffinmart.plans.date_dim import date_bounds, date_dim
from tiffinmart.plans.fact import LAYOUT, affected_orders, incremental_fact_changes, merge_stored_fact, single_rows
from tiffinmart.session import empty_frame, materialized
from tiffinmart.sources.csv_stage import copy_into, read_stage
from tiffinmart.sources.ledger import copy_history, read_ledger
from tiffinmart.store import SnapshotTable

EVENTS = ("order_item", "orders", "delivery")


class Warehouse:
    """Tables below `root`. `buckets` is the number of slices a table is rewritten by; choose it
    so that one slice is some hundred MB to a few GB."""

    def __init__(self, spark: SparkSession, root: str, mode: str = "default", buckets: int = 16):
        self.spark, self.root, self.mode, self.buckets = spark, root.rstrip("/"), mode, buckets
        self.ledger_path = f"{self.root}/ledger"

    # -- tables ------------------------------------------------------------------------------

    def stage_path(self, entity: Entity | str) -> str:
        return f"{self.root}/stage/{entities.get(entity).name}"

    def clean_table(self, entity: Entity | str) -> SnapshotTable:
        e = entities.get(entity)
        return SnapshotTable(self.spark, f"{self.root}/clean/{e.name}", e.slice_key, self.buckets)

    def dim_table(self, entity: Entity | str) -> SnapshotTable:
        e = entities.get(entity)
        return SnapshotTable(self.spark, f"{self.root}/dim/{e.name}", e.key, self.buckets)

    def fact_table(self) -> SnapshotTable:
        # The order date never changes, so year and month are as good as part of the key.
        return SnapshotTable(self.spark, f"{self.root}/fact", ["order_id"], self.buckets, LAYOUT)

    def clean(self, entity: Entity | str) -> DataFrame:
        return self.clean_table(entity).read()

    def dim(self, entity: Entity | str) -> DataFrame:
        return self.dim_table(entity).read()

    def dates_table(self) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/dim/date", ["date_dim_hk"], 1)

    def dates(self) -> DataFrame:
        return self.dates_table().read()

    def waiting_table(self) -> SnapshotTable:
        """Orders that gave no fact row yet, because a dimension row they name has not arrived."""
        return SnapshotTable(self.spark, f"{self.root}/fact_waiting", ["order_id"], self.buckets)

    def fact(self, year: int | None = None, month: int | None = None) -> DataFrame:
        """The fact; year and month filters prune its folders."""
        df = self.fact_table().read()
        if year is not None:
            df = df.filter(F.col("order_year") == year)
        if month is not None:
            df = df.filter(F.col("order_month") == month)
        return df

    # -- steps -------------------------------------------------------------------------------

    def load(
        self,
        entity: Entity | str,
        path: str,
        load_id: int,
        batch_ts: datetime | str,
        landing: str | None = None,
        strict: bool = False,
    ) -> int:
        """Append the new files under `path` to the stage table. Load numbers must rise."""
        e = entities.get(entity)
        consumed = self.clean_table(e).batch_id()
        if consumed is not None and load_id <= consumed:
            raise ValueError(f"load {load_id} of {e.name} would not be seen: the clean table is at load {consumed}")
        return copy_into(
            self.spark, e, path, self.stage_path(e), f"{self.ledger_path}/{e.name}", load_id, batch_ts, landing, strict
        )

    def history(self, entity: Entity | str, now: datetime | str, hours: int = 1) -> DataFrame:
        """Files loaded into the entity's stage table within the last `hours` before `now`."""
        e = entities.get(entity)
        return copy_history(read_ledger(self.spark, f"{self.ledger_path}/{e.name}"), e.name, now, hours)

    def refresh_clean(self, entity: Entity | str) -> int | None:
        """Upsert the stage rows appended since the last refresh. Returns the new version."""
        e = entities.get(entity)
        table = self.clean_table(e)
        stage = read_stage(self.spark, e, self.stage_path(e))
        pending = append_changes(stage, table.batch_id())
        newest = pending.agg(F.max("load_id")).first()[0]
        if newest is None:
            return None
        return self.merge_clean(e, pending, newest)

    def merge_clean(self, entity: Entity | str, stage_rows: DataFrame, load_id: int) -> int | None:
        """Clean and upsert stage rows as load `load_id`; does nothing if that is already in."""
        e = entities.get(entity)
        table = self.clean_table(e)
        done = table.batch_id()
        if done is not None and done >= load_id:
            return None
        # Typed once; the rows are then read for the quarantine, the slices and the merge.
        with materialized(clean_all(e, stage_rows, self.mode), f"typed-{e.name}") as typed:
            accepted, rejected = split_rejects(typed)
            rejected.write.mode("overwrite").parquet(f"{self.root}/quarantine/{e.name}/load_id={load_id}")
            if table.exists():
                touched = table.touched_slices(accepted)
                target = table.read(slices=touched)
            else:
                touched, target = None, empty_frame(self.spark, accepted.schema)
            return table.commit(upsert_entity(e, target, accepted, self.mode), load_id, touched)

    def refresh_dim(self, entity: Entity | str, batch_ts: datetime | str) -> int | None:
        """Version the net change of the clean table since the last refresh."""
        e = entities.get(entity)
        source, table = self.clean_table(e), self.dim_table(e)
        consumed, latest = table.batch_id(), source.version()
        if latest is None or consumed == latest:
            return None
        before, after = source.images(consumed, latest)
        reference = self.mode == "reference"
        # In reference mode a row re-sent with new audit values counts as an update.
        changes = change_feed(before, after, e.key, None if reference else e.dimension.attributes)
        # Compared once; the feed then serves the slices and the versions.
        with materialized(changes, f"feed-{e.name}") as feed:
            if table.exists():
                touched = table.touched_slices(feed)
                dim = table.read(slices=touched)
            else:
                touched, dim = None, None
            if reference:
                versions = scd2_attribute_match(dim, feed, e.dimension, batch_ts)
            else:
                versions = scd2_keyed(dim, feed, e.dimension, batch_ts)
            return table.commit(versions, latest, touched)

    def refresh_dates(self, as_of_date: str) -> None:
        """The calendar up to `as_of_date`, or in default mode to the newest order if that is later."""
        bounds = date_bounds(self.clean("orders"), "order_date", as_of_date, to_newest=self.mode != "reference")
        self.dates_table().commit(date_dim(bounds, include_first=self.mode != "reference"))

    def _extend_dates(self) -> None:
        """The calendar goes on to the newest order, if it has begun at all."""
        if self.mode == "reference" or not self.dates_table().exists():
            return
        last = self.dates().agg(F.max("calendar_date")).first()[0]
        newest = self.clean("orders").agg(F.to_date(F.max("order_date"))).first()[0]
        if newest is not None and (last is None or newest > last):
            self.refresh_dates(str(newest))

    def refresh_fact(self) -> int | None:
        """Upsert the fact rows of every order an item, order or delivery change touches, and of those
        that have waited for a dimension row."""
        table, waiting = self.fact_table(), self.waiting_table()
        consumed = table.batch_id() or {}
        latest = {name: self.clean_table(name).version() for name in EVENTS}
        waited = waiting.read() if waiting.exists() else None
        if consumed == latest and (waited is None or waited.isEmpty()):
            return None
        self._extend_dates()
        feeds = {}
        for name in EVENTS:
            if latest[name] is not None and consumed.get(name) != latest[name]:
                before, after = self.clean_table(name).images(consumed.get(name), latest[name])
                feeds[name] = change_feed(before, after, entities.get(name).key)
        if feeds:
            affected = affected_orders(*(feeds.get(name) for name in EVENTS))
            affected = affected.union(waited).distinct() if waited is not None else affected
        else:
            affected = waited
        dims = {e.name: self.dim(e) for e in DIMENSION_ENTITIES} | {"date": self.dates()}
        # The ids serve each of the three event tables, the fact rows the slices and the merge.
        with materialized(affected, "affected-orders") as ids:
            # The three event tables are sliced by order, so the same slices hold an order's rows.
            slices = self.clean_table("orders").touched_slices(ids)
            items, orders, deliveries = (self.clean_table(name).read(slices=slices) for name in EVENTS)
            # One row per key while they are still together by order, so that the commit need not sort them out.
            rows = single_rows(incremental_fact_changes(ids, items, orders, deliveries, dims, with_layout=True))
            with materialized(rows, "fact-changes") as changes:
                # Published before the fact: if the fact's version fails, these orders are only tried twice.
                late = ids.join(changes.select("order_id").distinct(), "order_id", "left_anti")
                with materialized(late, "fact-late") as left:
                    if waiting.exists() or not left.isEmpty():
                        waiting.commit(left)
                if consumed == latest and changes.isEmpty():
                    return None
                if not table.exists():
                    return table.commit(changes, latest)
                touched = table.touched_slices(changes)
                return table.commit(merge_stored_fact(table.read(slices=touched), changes), latest, touched)

    def refresh_dimensions(self, batch_ts: datetime | str) -> None:
        """All clean tables, then all dimensions. The tables of a layer do not depend on each
        other, so their jobs run side by side."""
        with ThreadPoolExecutor(len(entities.ENTITIES)) as pool:
            loaded = [n for n in entities.ENTITIES if self._has_stage(n)]
            list(pool.map(self.refresh_clean, loaded))
            list(pool.map(lambda e: self.refresh_dim(e, batch_ts), DIMENSION_ENTITIES))

    def _has_stage(self, entity: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.stage_path(entity))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def refresh_all(self, batch_ts: datetime | str, as_of_date: str) -> None:
        self.refresh_dimensions(batch_ts)
        self.refresh_dates(as_of_date)
        self.refresh_fact()

    def create_views(self) -> None:
        kpis.create_views(self.fact(), self.dates(), self.dim("restaurant"))
