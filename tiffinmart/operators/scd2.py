"""Type 2 slowly changing dimensions from a change feed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffinmart import entities
from tiffinmart.entities import Dimension, Entity
from tiffinmart.functions.keys import hash_key
from tiffinmart.operators.changes import closed_by_update, inserted, purely_deleted


def _ts(batch_ts: datetime | str | Column) -> Column:
    return batch_ts if isinstance(batch_ts, Column) else F.lit(batch_ts).cast("timestamp")


def dimension_schema(entity: Entity | str) -> T.StructType:
    e = entities.get(entity)
    spec = e.dimension
    fields = {f.name: f.type for f in e.fields}
    ddl = [f"{spec.key} bigint"] + [f"{a} {fields[a]}" for a in spec.attributes]
    ddl += [f"{spec.start} timestamp", f"{spec.end} timestamp", f"{spec.flag} boolean"]
    return T.StructType.fromDDL(", ".join(ddl))


def _new_key(spec: Dimension, key_mode: str, prefix: str = "") -> Column:
    """Key of a version that starts at `_ts`."""
    if key_mode == "reference":
        return hash_key([prefix + c for c in spec.hash_cols], "reference")
    # The start time keeps two versions with equal attributes (A, B, A again) apart.
    return hash_key([*[prefix + c for c in spec.attributes], "_ts"])


def _open_versions(spec: Dimension, changes: DataFrame, ts: Column, key_mode: str) -> DataFrame:
    """First load: every inserted row opens a version."""
    return (
        changes.filter(inserted())
        .withColumn("_ts", ts)
        .withColumn(spec.key, _new_key(spec, key_mode))
        .selectExpr(
            spec.key,
            *spec.attributes,
            f"_ts AS {spec.start}",
            f"CAST(NULL AS TIMESTAMP) AS {spec.end}",
            f"true AS {spec.flag}",
        )
    )


def _stored(spec: Dimension, dim: DataFrame) -> DataFrame:
    columns = [spec.key, *spec.attributes, spec.start, spec.end, spec.flag]
    return dim.selectExpr("true AS _known", *[f"{c} AS _d_{c}" for c in columns])


def _pick(spec: Dimension, joined: DataFrame, is_stored: str, close: str, ts: Column, key_mode: str) -> DataFrame:
    """The stored version, closed at `ts` if so marked, or a new version from the `_n_` columns."""
    return (
        joined.withColumn("_ts", ts)
        .withColumn("_new_key", _new_key(spec, key_mode, "_n_"))
        .selectExpr(
            f"if({is_stored}, _d_{spec.key}, _new_key) AS {spec.key}",
            *[f"if({is_stored}, _d_{a}, _n_{a}) AS {a}" for a in spec.attributes],
            f"if({is_stored}, _d_{spec.start}, _ts) AS {spec.start}",
            f"CASE WHEN {is_stored} AND {close} THEN _ts WHEN {is_stored} THEN _d_{spec.end} END AS {spec.end}",
            f"if({is_stored}, _d_{spec.flag} AND NOT ({close}), true) AS {spec.flag}",
        )
    )


def scd2_attribute_match(
    dim: DataFrame | None,
    changes: DataFrame,
    spec: Dimension,
    batch_ts: datetime | str | Column,
    key_mode: str = "reference",
) -> DataFrame:
    """The reference's rule: a change meets a version when all of `spec.match_cols` are equal.

    A DELETE image of an update closes every version it meets, an INSERT image that meets none
    opens one. NULLs never meet, closed versions are met like open ones, pure deletes do nothing.
    Both clauses see the dimension as it was before the merge: one full outer join does it.
    """
    ts = _ts(batch_ts)
    if dim is None:
        return _open_versions(spec, changes, ts, key_mode)
    others = [a for a in spec.attributes if a not in spec.match_cols]
    images = changes.withColumns({"_c": closed_by_update(), "_i": inserted()})
    per_match = images.selectExpr("_c", "_i", *[f"{a} AS _n_{a}" for a in spec.attributes])
    per_match = per_match.groupBy(*[f"_n_{m}" for m in spec.match_cols]).agg(
        F.max("_c").alias("_close"),
        F.max("_i").alias("_open"),
        *[F.expr(f"max(if(_i, _n_{a}, NULL)) AS _n_{a}") for a in others],
    )
    on = " AND ".join(f"_d_{m} = _n_{m}" for m in spec.match_cols)
    joined = _stored(spec, dim).join(per_match, F.expr(on), "full_outer").filter("_known IS NOT NULL OR _open")
    return _pick(spec, joined, "_known IS NOT NULL", "coalesce(_close, false)", ts, key_mode)


def scd2_keyed(
    dim: DataFrame | None,
    changes: DataFrame,
    spec: Dimension,
    batch_ts: datetime | str | Column,
    close_on_delete: bool = False,
    key_mode: str = "safe",
) -> DataFrame:
    """Versioning by business key against the open version, comparing attributes null-safely.

    At most one open version per key and no overlapping intervals. Closed versions pass through
    without a shuffle. `changes` holds at most one INSERT image per key, as a change feed does.
    """
    ts = _ts(batch_ts)
    if dim is None:
        return _open_versions(spec, changes, ts, key_mode)
    business_key = spec.attributes[0]
    # Of an update only the new image matters, so each key keeps one row and needs no grouping.
    news = (
        changes.filter(inserted() | purely_deleted())
        .withColumn("_open", inserted())
        .selectExpr("_open", *[f"{a} AS _n_{a}" for a in spec.attributes])
    )
    same = " AND ".join(f"_d_{a} <=> _n_{a}" for a in spec.attributes)
    # Version 0 is the stored one, version 1 the new one; see `change_feed` for the explode.
    versions = """CASE WHEN _replace THEN array(0, 1) WHEN _known IS NOT NULL THEN array(0)
        WHEN _open THEN array(1) ELSE CAST(array() AS ARRAY<INT>) END"""
    gone = "coalesce(NOT _open, false)" if close_on_delete else "false"
    joined = (
        _stored(spec, dim.filter(spec.flag))
        .join(news, F.expr(f"_d_{business_key} = _n_{business_key}"), "full_outer")
        .withColumn("_replace", F.expr(f"_known IS NOT NULL AND coalesce(_open, false) AND NOT ({same})"))
        .withColumn("_version", F.explode(F.expr(versions)))
    )
    current = _pick(spec, joined, "_version = 0", f"_replace OR {gone}", ts, key_mode)
    history = dim.filter(f"NOT {spec.flag}")
    return history.select(*current.columns).unionByName(current)


def current(dim: DataFrame, spec: Dimension) -> DataFrame:
    return dim.filter(F.col(spec.flag))


def as_of(facts: DataFrame, dim: DataFrame, spec: Dimension, fact_key: str, ts: str) -> DataFrame:
    """Facts with the version that was valid at `ts`: start <= ts < end, an open end being endless."""
    d = dim.select(F.struct(*dim.columns).alias("d"))
    valid = (F.col(f"d.{spec.start}") <= F.col(ts)) & (
        F.col(f"d.{spec.end}").isNull() | (F.col(ts) < F.col(f"d.{spec.end}"))
    )
    extra = [c for c in dim.columns if c not in facts.columns]
    return facts.join(d, (F.col(fact_key) == F.col(f"d.{spec.attributes[0]}")) & valid).select(
        *facts.columns, *[F.col(f"d.{c}").alias(c) for c in extra]
    )
