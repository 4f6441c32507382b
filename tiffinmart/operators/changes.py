"""Change capture: appended rows since an offset, and the net change between two snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION, IS_UPDATE = "_action", "_is_update"


def append_changes(stage: DataFrame, last_load_id: int | None, load_col: str = "load_id") -> DataFrame:
    """Rows appended after `last_load_id`; on a table partitioned by it, a partition filter."""
    return stage if last_load_id is None else stage.filter(F.col(load_col) > last_load_id)


def change_feed(
    old: DataFrame | None, new: DataFrame, key: Sequence[str], compare: Sequence[str] | None = None
) -> DataFrame:
    """Net change from `old` to `new`: an insert or delete is one row, an update is the old image
    as DELETE plus the new image as INSERT, both with `_is_update`. Without `old` all rows are inserts.

    `compare` limits the columns that make a row changed; by default all of them do, so a row
    re-sent with new audit values counts as updated. One shuffle per side, on the key.
    """
    cols = new.columns
    if old is None:
        return new.select("*", F.lit("INSERT").alias(ACTION), F.lit(False).alias(IS_UPDATE))
    watched = [c for c in (compare if compare is not None else cols) if c not in key]
    o = old.selectExpr("true AS _had", *[f"`{c}` AS `_o_{c}`" for c in cols])
    n = new.selectExpr("true AS _has", *[f"`{c}` AS `_n_{c}`" for c in cols])
    on = " AND ".join(f"`_o_{k}` = `_n_{k}`" for k in key)
    same = " AND ".join(["true", *[f"`_o_{c}` <=> `_n_{c}`" for c in watched]])
    # Image 0 is the old row, image 1 the new one. Only these numbers are exploded; the columns
    # are picked afterwards, which keeps everything in generated code.
    images = "CASE WHEN _has IS NULL THEN array(0) WHEN _had IS NULL THEN array(1) ELSE array(0, 1) END"
    return (
        o.join(n, F.expr(on), "full_outer")
        .filter(f"NOT (_had IS NOT NULL AND _has IS NOT NULL AND {same})")
        .withColumn("_image", F.explode(F.expr(images)))
        .selectExpr(
            *[f"if(_image = 0, `_o_{c}`, `_n_{c}`) AS `{c}`" for c in cols],
            f"if(_image = 0, 'DELETE', 'INSERT') AS {ACTION}",
            f"_had IS NOT NULL AND _has IS NOT NULL AS {IS_UPDATE}",
        )
    )


def apply_feed(old: DataFrame, feed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Replay a feed: drop every old row the feed names, add its INSERT images."""
    touched = feed.select(*key).distinct()
    inserts = feed.filter(inserted()).select(*old.columns)
    return old.join(touched, list(key), "left_anti").select(*old.columns).unionByName(inserts)


def inserted() -> Column:
    return F.col(ACTION) == "INSERT"


def closed_by_update() -> Column:
    return (F.col(ACTION) == "DELETE") & F.col(IS_UPDATE)


def purely_deleted() -> Column:
    return (F.col(ACTION) == "DELETE") & ~F.col(IS_UPDATE)


def pending_change_count(feed: DataFrame) -> DataFrame:
    return feed.groupBy(ACTION, IS_UPDATE).agg(F.count(F.lit(1)).alias("changes"))
