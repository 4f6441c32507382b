"""MERGE as a DataFrame operator: (target, source) -> next state of the target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffinmart import entities
from tiffinmart.entities import AUDIT, Entity

Assignments = Mapping[str, Column] | Sequence[str]


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by `order`, ties broken by the remaining columns.

    One shuffle and one sort, both of use to a join on the key. Spark cuts the rows of a key down to
    one before the shuffle, so a hot key costs no more than any other.
    """
    rest = [c for c in df.columns if c not in order and c not in key]
    newest = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in (*order, *rest)])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def _assignments(spec: Assignments | None) -> dict[str, Column]:
    if spec is None:
        return {}
    if isinstance(spec, Mapping):
        return dict(spec)
    return {c: F.col(f"s.{c}") for c in spec}


def _on(key: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in key:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    return cond


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    update: Assignments,
    insert: Assignments | None = None,
    condition: Column | None = None,
) -> DataFrame:
    """Rows of `target` updated from matching source rows, plus source rows without a match.

    `update` and `insert` name columns to copy or map a column to an expression over `t.*` and
    `s.*`; `insert` defaults to every target column the source has. A match whose `condition` is
    false or NULL leaves the row alone. The source must hold one row per key (`latest_per_key`).

    The plan is one full outer join on the key.
    """
    sets = _assignments(update)
    puts = _assignments(insert if insert is not None else [c for c in target.columns if c in source.columns])
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = source.withColumn("_in_s", F.lit(True)).alias("s")
    apply = F.col("s._in_s").isNotNull()
    if condition is not None:
        apply = apply & F.coalesce(condition, F.lit(False))

    types = dict(zip(target.columns, [f.dataType for f in target.schema.fields], strict=True))

    def inserted(name: str) -> Column:
        return puts.get(name, F.lit(None)).cast(types[name])

    def updated(name: str) -> Column:
        old = F.col(f"t.{name}")
        return F.when(apply, sets[name].cast(types[name])).otherwise(old) if name in sets else old

    joined = t.join(s, _on(on), "full_outer")
    is_new = F.col("t._in_t").isNull()
    return joined.select(*[F.when(is_new, inserted(n)).otherwise(updated(n)).alias(n) for n in target.columns])


def replace_rows(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """`merge_upsert` whose update sets all columns but the key, from a source of one row per key.

    Rows of both sides are sorted together by key, not joined. A join moves both unless they are partitioned by the
    whole key; here it is enough that they are partitioned by a part of it.
    """
    rest = [n for n in target.columns if n not in on]
    own = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
    both = target.withColumn("_new", F.lit(False)).unionByName(own.withColumn("_new", F.lit(True)))
    # A NULL in the key matches nothing, so such rows of the two sides stay apart.
    no_key = reduce(Column.__or__, [F.col(k).isNull() for k in on])
    key = Window.partitionBy(*on, "_apart").orderBy(F.desc("_new"))
    marked = both.withColumn("_apart", no_key & F.col("_new")).select(
        *target.columns,
        "_new",
        F.first(F.struct("_new", *rest)).over(key.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_first"),
        F.lead("_new").over(key).alias("_next"),
    )
    # A source row stands for itself only where no target row takes its values.
    kept = marked.filter(~F.col("_new") | F.col("_next").isNull())
    return kept.select(*[F.when(F.col("_first._new"), F.col(f"_first.{n}")).otherwise(F.col(n)).alias(n) if n in rest else n for n in target.columns])


def changed_reference(columns: Sequence[str]) -> Column:
    """Any column differs, by plain inequality: a NULL on either side never counts as a change."""
    return F.expr(" OR ".join(f"t.{c} != s.{c}" for c in columns))


def changed_nullsafe(columns: Sequence[str]) -> Column:
    """Any column differs, NULL being a value like any other."""
    return F.expr(" OR ".join(f"NOT (t.{c} <=> s.{c})" for c in columns))


def upsert_entity(
    entity: Entity | str, target: DataFrame, source: DataFrame, mode: str = "default"
) -> DataFrame:
    """The entity's own MERGE: which columns an update may touch and when it fires.

    A stored row yields only to a source row that is greater in the order that also picks one of
    several source rows, so the result does not depend on how rows are split into batches. In
    reference mode any source row wins. Locations update only when a tracked column changed; in
    reference mode that test is not null-safe, and a delivery agent's rating loses its fraction on
    insert.
    """
    e = entities.get(entity)
    update = [c for c in e.update_columns if c in target.columns]
    condition = None
    insert: dict[str, Column] | None = None
    if e.name == "location":
        compared = [c for c in e.columns if c not in e.key and c not in e.frozen]
        condition = changed_reference(compared) if mode == "reference" else changed_nullsafe(compared)
    if e.name == "delivery_agent" and mode == "reference":
        insert = {c: F.col(f"s.{c}") for c in target.columns if c in source.columns}
        insert["rating"] = F.round(F.col("s.rating"), 0)
    order = [e.modified, *[a for a in AUDIT if a in source.columns and a.endswith("_ts")]]
    single = latest_per_key(source, list(e.key), order)
    if mode != "reference":
        compared = [c for c in order if c in target.columns] + [c for c in update if c not in order and c in source.columns]
        newer = F.struct(*[F.col(f"s.{c}") for c in compared]) > F.struct(*[F.col(f"t.{c}") for c in compared])
        condition = newer if condition is None else condition & newer
    return merge_upsert(target, single, list(e.key), update, insert, condition)
