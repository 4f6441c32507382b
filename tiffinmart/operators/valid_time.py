"""Histories by the rows' own time: late changes spliced in, and events joined with the version of their time."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffinmart.entities import Dimension
from tiffinmart.functions.keys import hash_key
from tiffinmart.session import materialize

GONE, REPEATS = "_gone", "_repeats"


def splice(points: DataFrame | None, changes: DataFrame, spec: Dimension, at: str, gone: Column | None = None) -> DataFrame:
    """`points` (None at first) with `changes` put in at their own time, column `at`, wherever that lies.

    A point is what a key was said to be at a time. All points are kept, also those that say what was known already
    (`_repeats`), so any order of arrival of the same changes gives the same points. Of several changes of one key and
    time the greatest by value counts; `gone` marks changes that end the key. Rows without key or time are left out.
    Only the keys of `changes` are sorted; all others pass through.
    """
    key, others = spec.attributes[0], list(spec.attributes[1:])
    state = [key, spec.start, GONE, *others]
    new = changes.select(key, F.col(at).cast("timestamp").alias(spec.start), (F.lit(False) if gone is None else gone).alias(GONE), *others)
    new = new.filter(F.col(key).isNotNull() & F.col(spec.start).isNotNull())
    rest = None
    if points is not None:
        ids = new.select(F.col(key).alias("_id")).distinct()
        touched = points.join(ids, F.col(key) == F.col("_id"), "left_semi").select(*state)
        rest = points.join(ids, F.col(key) == F.col("_id"), "left_anti")
        new = touched.unionByName(new)
    one = new.groupBy(key, spec.start).agg(F.max(F.struct(GONE, *others)).alias("_s")).select(key, spec.start, "_s.*")
    back = Window.partitionBy(key).orderBy(F.desc(spec.start))
    said = F.struct(GONE, *[F.when(~F.col(GONE), F.col(c)).alias(c) for c in others])
    # In order of falling time, the row before in time comes next; nothing is known of a key before its first point.
    before = F.lead(said).over(back)
    marked = one.withColumn(REPEATS, F.coalesce(before.eqNullSafe(said), F.lit(False)) | (before.isNull() & F.col(GONE)))
    turn = F.last(F.when(~F.col(REPEATS), F.col(spec.start)), ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))
    timed = marked.withColumn(spec.end, turn).withColumn(spec.flag, ~F.col(GONE) & F.col(spec.end).isNull())
    keyed = timed.withColumn(spec.key, hash_key([*spec.attributes, spec.start]))
    out = keyed.select(spec.key, *spec.attributes, spec.start, spec.end, spec.flag, GONE, REPEATS)
    return out if rest is None else rest.select(*out.columns).unionByName(out)


def history(points: DataFrame, spec: Dimension) -> DataFrame:
    """The versions that the points stand for: no gaps but where a key was gone, no two equal neighbours."""
    return points.filter(~F.col(REPEATS) & ~F.col(GONE)).select(spec.key, *spec.attributes, spec.start, spec.end, spec.flag)


@dataclass(frozen=True)
class Lookup:
    """Versions to look up: `id` is the column of the events, `more` a further whole number of the version."""

    id: str
    dim: DataFrame
    spec: Dimension
    more: str | None = None

    def versions(self, place: int) -> DataFrame:
        more = F.lit(None) if self.more is None else F.col(self.more)
        return self.dim.select(
            F.lit(place).alias("_lookup"),
            F.col(self.spec.attributes[0]).cast("bigint").alias("_id"),
            F.col(self.spec.start).cast("timestamp").alias("_at"),
            F.struct(F.col(self.spec.key).alias("key"), F.col(self.spec.end).cast("timestamp").alias("end"), more.cast("bigint").alias("more")).alias("_version"),
        )

    def intervals(self) -> DataFrame:
        """Of the versions that have started, the last one counts: each from `_version_from` to `_version_until`."""
        start = F.coalesce("_at", F.lit("0001-01-01 00:00:00").cast("timestamp"))
        v = self.versions(0).filter("_id IS NOT NULL").select(F.col("_id").alias("_version_id"), start.alias("_version_from"), "_version.*")
        after = F.lead("_version_from").over(Window.partitionBy("_version_id").orderBy("_version_from"))
        v = v.withColumn("_version_until", F.least("end", after)).drop("end")
        return v.filter("_version_until IS NULL OR _version_from < _version_until")


def as_of_keys(
    events: DataFrame, at: str, lookups: Mapping[str, Lookup], hot_rows: int = 1_000_000, counted: DataFrame | None = None, most_versions: int = 16
) -> DataFrame:
    """`events` with, for each lookup, its name as a column: the key of the version valid at column `at`, start
    inclusive and end exclusive (and `<name>_more`, where asked for). Events without a version in any lookup are left out.

    Where no id has more than `most_versions` versions, a lookup is an equal join on the id that also compares times:
    events move once, or not at all for a small dimension. The others are one pass: events and versions of an id are put
    in order of time and each event takes the last version before it, so no row meets all versions of its id. There, ids
    of more than `hot_rows` events are counted first and split, with their versions copied to each part. They are counted
    in `counted`, any frame with the columns of ids, or in `events`, which is then stored. The versions of all
    dimensions are counted at once, before the frame is returned.
    """
    columns = events.columns
    ids = None
    for i, q in enumerate(lookups.values()):
        own = q.versions(i).filter("_id IS NOT NULL").select("_lookup", "_id")
        ids = own if ids is None else ids.unionByName(own)
    many = ids.groupBy("_lookup", "_id").count().filter(F.col("count") > most_versions).select("_lookup").distinct().collect()
    long = {n: q for i, (n, q) in enumerate(lookups.items()) if any(r[0] == i for r in many)}
    out = events
    for name, q in lookups.items():
        if name not in long:
            shown = {"key": name} | ({"more": f"{name}_more"} if q.more else {})
            versions = q.intervals().withColumnsRenamed(shown).select(*shown.values(), "_version_id", "_version_from", "_version_until")
            when, until = F.col(at).cast("timestamp"), F.col("_version_until")
            met = (F.col(q.id).cast("bigint") == F.col("_version_id")) & (when >= F.col("_version_from")) & (until.isNull() | (when < until))
            out = out.join(versions, met).drop("_version_id", "_version_from", "_version_until")
    if long:
        out = _carried(out if counted is not None else materialize(out, "as-of"), at, long, hot_rows, counted)
    return out.select(*columns, *lookups, *[f"{n}_more" for n, q in lookups.items() if q.more])


def _carried(events: DataFrame, at: str, lookups: Mapping[str, Lookup], hot_rows: int, counted: DataFrame | None) -> DataFrame:
    """`as_of_keys` by putting events and versions of an id in order of time."""
    names, columns = list(lookups), events.columns
    wanted = lambda: F.explode(F.array(*[F.struct(F.lit(i).alias("_lookup"), F.col(q.id).cast("bigint").alias("_id")) for i, q in enumerate(lookups.values())]))
    asked = events.select(F.struct(*columns).alias("_event"), wanted().alias("_q")).select("_q.*", "_event").filter("_id IS NOT NULL")
    asked = asked.withColumn("_at", F.col(f"_event.{at}").cast("timestamp")).filter("_at IS NOT NULL")
    known = None
    for i, q in enumerate(lookups.values()):
        own = q.versions(i)
        known = own if known is None else known.unionByName(own)
    # At most (events / hot_rows) ids for each lookup.
    ids = (events if counted is None else counted).select(wanted().alias("_q")).select("_q.*").filter("_id IS NOT NULL")
    hot = ids.groupBy("_lookup", "_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    hot = F.broadcast(hot.select("_lookup", "_id", F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts")))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    asked = asked.join(hot, ["_lookup", "_id"], "left").withColumn("_part", F.pmod(F.xxhash64("_event"), parts).cast("int")).drop("_parts")
    known = known.join(hot, ["_lookup", "_id"], "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    both = known.withColumn("_event", F.lit(None).cast(asked.schema["_event"].dataType)).unionByName(
        asked.withColumn("_version", F.lit(None).cast(known.schema["_version"].dataType))
    )
    # A version that starts at the time of an event is there before it.
    sofar = Window.partitionBy("_lookup", "_id", "_part").orderBy("_at", F.col("_event").isNotNull())
    carried = both.withColumn("_last", F.last("_version", ignorenulls=True).over(sofar)).filter("_event IS NOT NULL")
    valid = carried.filter(F.col("_last").isNotNull() & (F.col("_last.end").isNull() | (F.col("_at") < F.col("_last.end"))))
    found = valid.select("_event.*", "_lookup", "_last.key", "_last.more")
    shown = [(f"{n}_more", "more", i) for i, n in enumerate(names) if lookups[n].more]
    if len(names) == 1:
        return found.select(*columns, F.col("key").alias(names[0]), *[F.col("more").alias(n) for n, _, _ in shown])
    # Equal events count as many times as they are there.
    pick = [F.max(F.when(F.col("_lookup") == i, F.col(c))).alias(n) for n, c, i in [(n, "key", i) for i, n in enumerate(names)] + shown]
    times = [F.count_if(F.col("_lookup") == i).alias(f"_n{i}") for i in range(len(names))]
    whole = found.groupBy(*columns).agg(*pick, *times)
    for i in range(len(names)):
        whole = whole.filter(F.col(f"_n{i}") > 0)
    again = F.explode(F.array_repeat(F.lit(0), F.col("_n0").cast("int")))
    return whole.withColumn("_again", again).select(*columns, *names, *[n for n, _, _ in shown])
