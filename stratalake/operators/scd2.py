"""Type-2 slowly-changing dimensions: versioned rows with half-open validity intervals.

A specification is a dictionary::

    {"business_keys": [...], "tracked_columns": [...], "update_only_columns": [...],
     "scd_columns": {"valid_from": ..., "valid_to": ..., "is_current": ...,
                     "version": ..., "hash": ...}}

A change in a tracked column opens a new version; a change in an update-only column is written
into the current one. Version ``v`` is valid from ``valid_from`` up to, but not including,
``valid_to``, which is null on the current version.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.hashing import record_hash
from stratalake.operators.checks import require
from stratalake.operators.splits import SPLIT, hot_keys, left_join, with_splits
from stratalake.spec import quoted


@dataclass(frozen=True)
class Scd2Spec:
    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    update_only: tuple[str, ...] = ()
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    is_current: str = "is_current"
    version: str = "version"
    hash: str = "hash"

    @classmethod
    def of(cls, spec: dict[str, Any] | Scd2Spec) -> Scd2Spec:
        if isinstance(spec, Scd2Spec):
            return spec
        return cls(
            tuple(spec["business_keys"]),
            tuple(spec["tracked_columns"]),
            tuple(spec.get("update_only_columns") or ()),
            **spec.get("scd_columns", {}),
        )

    @property
    def payload(self) -> list[str]:
        return [*self.tracked, *self.update_only]

    @property
    def metadata(self) -> list[str]:
        return [self.valid_from, self.valid_to, self.is_current, self.version, self.hash]


def _moment(at: Column | datetime | str) -> Column:
    return at if isinstance(at, Column) else F.lit(at)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _with_keys(df: DataFrame, s: Scd2Spec) -> DataFrame:
    present = _all([quoted(k).isNotNull() for k in s.keys])
    return require(df, present, f"null in business key {list(s.keys)}")


def _checked(snapshot: DataFrame, s: Scd2Spec) -> DataFrame:
    """The snapshot, failing the query on a null or repeated business key.

    Repeats are counted by a subquery over the key columns alone, combined before its shuffle,
    so the check never moves or sorts the other columns and a key repeated very often costs
    no more than one repeated twice.
    """
    complete = _with_keys(snapshot, s)
    groups = complete.groupBy(*[quoted(k) for k in s.keys]).agg(F.count(F.lit(1)).alias("n"))
    repeated = groups.filter("n > 1").agg(F.count(F.lit(1)).alias("n")).scalar()
    message = f"business key {list(s.keys)} repeats in the snapshot"
    return require(complete, repeated == 0, message)


def initial_load(
    snapshot: DataFrame,
    spec: dict[str, Any] | Scd2Spec,
    as_of: Column | datetime | str,
    time_type: str = "timestamp",
) -> DataFrame:
    """Version 1 of every member of the first snapshot."""
    s = Scd2Spec.of(spec)
    return _checked(snapshot, s).select(
        *[quoted(c) for c in snapshot.columns],
        _moment(as_of).cast(time_type).alias(s.valid_from),
        F.lit(None).cast(time_type).alias(s.valid_to),
        F.lit(True).alias(s.is_current),
        F.lit(1).alias(s.version),
        record_hash(snapshot, list(s.tracked)).alias(s.hash),
    )


def merge(
    dim: DataFrame,
    snapshot: DataFrame,
    spec: dict[str, Any] | Scd2Spec,
    as_of: Column | datetime | str,
) -> DataFrame:
    """The dimension after a new snapshot: closed history unchanged, current rows merged.

    Merging the same snapshot again changes nothing. Members that the snapshot lacks stay.
    """
    s = Scd2Spec.of(spec)
    closed = dim.filter(~quoted(s.is_current))
    return closed.unionByName(merge_current(current(dim, s), snapshot, s, as_of))


def merge_current(
    current_rows: DataFrame,
    snapshot: DataFrame,
    spec: dict[str, Any] | Scd2Spec,
    as_of: Column | datetime | str,
) -> DataFrame:
    """What the current rows become: untouched, updated in place, or closed and succeeded.

    One full outer join on the business keys; each joined row yields its one or two results
    in place, so neither side is read twice. History rows take no part.
    """
    s = Scd2Spec.of(spec)
    types = {f.name: f.dataType for f in current_rows.schema.fields}
    data = [c for c in current_rows.columns if c not in s.metadata]
    carried = [c for c in data if c in snapshot.columns]
    typed = snapshot.select(*[quoted(c).cast(types[c]).alias(c) for c in carried])
    keys = [quoted(k) for k in s.keys]
    before = current_rows.select(
        *keys, F.struct(*[quoted(c) for c in current_rows.columns]).alias("__old")
    )
    rest = [quoted(c) for c in carried if c not in s.keys]
    after = F.struct(*rest, record_hash(typed, list(s.tracked)).alias("__hash"))
    arrived = _checked(typed, s).select(*keys, after.alias("__new"))
    joined = before.join(arrived, list(s.keys), "full_outer")

    old, new = F.col("__old"), F.col("__new")
    at = _moment(as_of).cast(types[s.valid_from])
    changed = old.isNotNull() & new.isNotNull() & (old.getField(s.hash) != new.getField("__hash"))
    late = ~changed | (at > old.getField(s.valid_from))
    message = f"as_of is not later than {s.valid_from} of a changed row"
    joined = require(joined, F.coalesce(late, F.lit(True)), message)

    def row(values: dict[str, Column]) -> Column:
        return F.struct(*[values[c].cast(types[c]).alias(c) for c in current_rows.columns])

    kept = {c: old.getField(c) for c in current_rows.columns}
    closed = {**kept, s.valid_to: at, s.is_current: F.lit(False)}
    updated = {**kept, **{c: new.getField(c) for c in s.update_only if c in carried}}
    opened = {c: quoted(c) if c in s.keys else F.lit(None) for c in data}
    opened |= {c: new.getField(c) for c in carried if c not in s.keys}
    opened |= {
        s.valid_from: at,
        s.valid_to: F.lit(None),
        s.is_current: F.lit(True),
        s.version: F.coalesce(old.getField(s.version), F.lit(0)) + 1,
        s.hash: new.getField("__hash"),
    }
    outcome = (
        F.when(new.isNull(), F.array(row(kept)))
        .when(old.isNull(), F.array(row(opened)))
        .when(changed, F.array(row(closed), row(opened)))
        .otherwise(F.array(row(updated)))
    )
    return joined.select(F.inline(outcome))


def current(dim: DataFrame, spec: dict[str, Any] | Scd2Spec) -> DataFrame:
    """Current versions; on a table partitioned by that flag, a pruned read."""
    return dim.filter(quoted(Scd2Spec.of(spec).is_current))


def as_of(
    dim: DataFrame, spec: dict[str, Any] | Scd2Spec, at: Column | datetime | str
) -> DataFrame:
    """The version of each member valid at a moment; at a change instant, the new one."""
    s = Scd2Spec.of(spec)
    at = _moment(at).cast(dim.schema[s.valid_from].dataType)
    ends = quoted(s.valid_to)
    return dim.filter((quoted(s.valid_from) <= at) & (ends.isNull() | (at < ends)))


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    spec: dict[str, Any] | Scd2Spec,
    time: str,
    columns: list[str],
    rows_per_split: int | None = 1_000_000,
) -> DataFrame:
    """Add to each fact the ``columns`` of its member's version at the fact's own time.

    Facts without a version keep their row, with nulls. Facts and versions are merged along
    time: one shuffle by member, in which the last version seen is the only one that can hold, as
    versions of a member do not overlap. Members with more than ``rows_per_split`` facts and versions
    are cut along time (see ``operators.splits``), and each of their splits starts with the version
    that reaches it. None never cuts. Facts without a member or a time belong to no version and
    are spread over many tasks.
    """
    s = Scd2Spec.of(spec)
    keys, names = list(s.keys), [quoted(k) for k in s.keys]
    start, ended = quoted(s.valid_from), quoted(s.valid_to)
    both = facts.select(quoted(time)).limit(0).union(dim.select(start).limit(0))
    kind = both.schema[0].dataType
    version = F.struct(ended.cast(kind).alias("__to"), *[quoted(c) for c in columns])
    versions = dim.filter(_all([n.isNotNull() for n in names]) & start.isNotNull()).select(
        *names, start.cast(kind).alias("__at"), version.alias("__version")
    )
    moved = facts.select(
        *names, quoted(time).cast(kind).alias("__at"),
        F.struct(*[quoted(c) for c in facts.columns]).alias("__fact"),
    )
    merged = moved.unionByName(versions, allowMissingColumns=True)
    cut = None
    if rows_per_split is not None:
        hot = hot_keys(merged.select(*names, "__at"), keys, "__at", rows_per_split)
        cut = None if hot.isEmpty() else hot
    if cut is None:
        merged = merged.withColumn(SPLIT, F.lit(0).cast("bigint"))
    else:
        merged = with_splits(merged, cut, keys, "__at")
        merged = merged.unionByName(_carried(versions, cut, keys), allowMissingColumns=True)
    # Any split will do where there is no version to find.
    nowhere = reduce(lambda a, b: a | b, [n.isNull() for n in [*names, F.col("__at")]])
    spread = -1 - F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))
    is_fact = F.col("__fact").isNotNull()
    merged = merged.withColumn(SPLIT, F.when(is_fact & nowhere, spread).otherwise(F.col(SPLIT)))
    # A version holds from its start on, so it comes before the facts of that instant.
    order = [F.col("__at").asc_nulls_first(), is_fact.cast("int")]
    so_far = Window.partitionBy(*names, SPLIT).orderBy(*order)
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = merged.withColumn("__last", F.last("__version", ignorenulls=True).over(so_far))
    to = F.col("__last").getField("__to")
    holds = F.col("__last").isNotNull() & (to.isNull() | (F.col("__at") < to))
    fact = F.col("__fact")
    return last.filter(is_fact).select(
        *[fact.getField(c).alias(c) for c in facts.columns],
        *[F.when(holds, F.col("__last").getField(c)).alias(c) for c in columns],
    )


def _carried(versions: DataFrame, cut: DataFrame, keys: list[str]) -> DataFrame:
    """For each split of a cut key the last version before it, as a row that opens the split."""
    names = [quoted(k) for k in keys]
    last = with_splits(versions, cut, keys, "__at").filter(F.col(SPLIT) > 0)
    last = last.groupBy(*names, SPLIT).agg(F.max_by("__version", "__at").alias("__version"))
    numbers = F.sequence(F.lit(1).cast("bigint"), F.size("__cuts").cast("bigint") + 1)
    every = cut.select(*names, F.explode(numbers).alias(SPLIT))
    # A key has one row per split and one per split with versions here.
    before = Window.partitionBy(*names).orderBy(SPLIT).rangeBetween(Window.unboundedPreceding, -1)
    carried = every.unionByName(last, allowMissingColumns=True).withColumn(
        "__carry", F.last("__version", ignorenulls=True).over(before)
    )
    opening = carried.filter(F.col("__version").isNull() & F.col("__carry").isNotNull())
    return opening.select(*names, SPLIT, F.col("__carry").alias("__version"))


def build_history(
    feed: DataFrame,
    spec: dict[str, Any] | Scd2Spec,
    time: str,
    tie_breakers: list[str] | None = None,
    rows_per_split: int = 1_000_000,
) -> DataFrame:
    """The whole history from a change feed: repeats collapsed, versions numbered and closed.

    Of several rows of one key at one time the last by ``tie_breakers`` counts. Change means
    a difference in the tracked columns, null against a value included. Keys with more than
    ``rows_per_split`` rows are cut along time (see ``operators.splits``), so their windows
    run in many tasks, and their rows of one time are combined before they move.
    """
    s = Scd2Spec.of(spec)
    ties = tie_breakers or []
    rows = feed.select(
        *[quoted(c) for c in [*s.keys, *s.payload, *ties]],
        quoted(time).alias(s.valid_from),
    )
    rows = _with_keys(rows, s)
    return _versions(rows, rows, s, ties, rows_per_split, seeded=False)


def apply_changes(
    current_rows: DataFrame,
    changes: DataFrame,
    spec: dict[str, Any] | Scd2Spec,
    time: str,
    tie_breakers: list[str] | None = None,
    rows_per_split: int = 1_000_000,
) -> DataFrame:
    """What the current rows become after a batch of changes, each at its own time.

    The current row of a changed member opens its sequence, so a batch may hold any number of
    changes per member, and cutting a feed into batches does not alter the result. A change
    not later than the member's current version is an error.
    """
    s = Scd2Spec.of(spec)
    keys, ties = list(s.keys), tie_breakers or []
    types = {f.name: f.dataType for f in current_rows.schema.fields}
    rows = changes.select(
        *[quoted(c).cast(types[c]).alias(c) for c in [*keys, *s.payload]],
        *[quoted(c) for c in ties],
        quoted(time).cast(types[s.valid_from]).alias(s.valid_from),
        F.lit(None).cast("int").alias("__base"),
    )
    rows = _with_keys(rows, s)
    touched = rows.select(*[quoted(k) for k in keys]).distinct()
    seeds = current_rows.join(touched, keys, "left_semi").select(
        *[quoted(c) for c in [*keys, *s.payload]],
        *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ties],
        quoted(s.valid_from),
        quoted(s.version).alias("__base"),
    )
    untouched = current_rows.join(touched, keys, "left_anti")
    versions = _versions(rows.unionByName(seeds), rows, s, ties, rows_per_split, seeded=True)
    return untouched.select(*versions.columns).unionByName(versions)


LATE = "a change is not later than the start of its member's current version"


def _versions(
    rows: DataFrame,
    changes: DataFrame,
    s: Scd2Spec,
    ties: list[str],
    rows_per_split: int,
    seeded: bool,
) -> DataFrame:
    """Number and close the versions in a feed.

    ``seeded`` feeds hold current rows among the changes: ``__base``, their version, marks them.
    ``changes`` are the rows without them, which decide what is cut.
    """
    keys, start = [quoted(k) for k in s.keys], quoted(s.valid_from)
    rows = require(rows, start.isNotNull(), "null change time")
    changes = require(changes, start.isNotNull(), "null change time")
    hot = hot_keys(changes, list(s.keys), s.valid_from, rows_per_split)
    cut = not hot.isEmpty()
    if cut:
        split = _one_per_time(with_splits(rows, hot, list(s.keys), s.valid_from), s, ties, seeded)
        ties = []
    else:
        split = rows.withColumn(SPLIT, F.lit(0).cast("bigint"))

    # One shuffle by key and split serves all the windows below; they share its sort order.
    w = Window.partitionBy(*keys, SPLIT).orderBy(start, *[quoted(c) for c in ties])
    timed = split.withColumn("__later", F.lead(start).over(w))
    if seeded:
        timed = _seeds_first(timed, s, w)
    timed = timed.filter(F.col("__later").isNull() | (F.col("__later") != start))
    state = F.struct(*[quoted(c) for c in s.tracked])
    ordered = timed.withColumn("__state", state).withColumns(
        {"__n": F.row_number().over(w), "__before": F.lag("__state").over(w)}
    )
    differs = ~F.col("__state").eqNullSafe(F.col("__before"))
    marked = ordered.withColumn("__inner", (F.col("__n") > 1) & differs)

    if cut:
        joined = left_join(marked, _edges(marked, s, seeded), [*s.keys, SPLIT])
    else:
        joined = marked.withColumns({
            "__opens": F.lit(None).cast("boolean"),
            "__edge_base": F.lit(None).cast("int"),
            "__offset": F.lit(0).cast("bigint"),
            "__next_change": F.lit(None).cast(rows.schema[s.valid_from].dataType),
        })
    change = F.when(F.col("__n") == 1, F.coalesce("__opens", F.lit(True)))
    offset = F.coalesce("__offset", F.lit(0))
    if seeded:
        own = F.max("__base").over(Window.partitionBy(*keys, SPLIT))
        offset = offset + F.coalesce("__edge_base", own, F.lit(1)) - 1
    joined = joined.withColumns(
        {"__change": change.otherwise(F.col("__inner")), "__offset": offset}
    )
    out = (_with_last_update if s.update_only else _changes_only)(joined, s, w)
    ended = quoted(s.valid_to)
    out = out.withColumns(
        {s.is_current: ended.isNull(), s.hash: record_hash(out, list(s.tracked))}
    )
    return out.select(*[quoted(c) for c in [*s.keys, *s.payload, *s.metadata]])


def _one_per_time(split: DataFrame, s: Scd2Spec, ties: list[str], seeded: bool) -> DataFrame:
    """Of rows of one key and time the last by ``ties``, found before rows move to their key."""
    keys, start = [quoted(k) for k in s.keys], quoted(s.valid_from)
    latest = F.struct(*[quoted(c) for c in s.payload])
    order = F.struct(*[quoted(c) for c in ties]) if ties else F.lit(0)
    found = [F.max_by(latest, order).alias("__payload")]
    if seeded:
        found += [F.max("__base").alias("__base"), F.count(F.lit(1)).alias("__rows")]
    grouped = split.groupBy(*keys, SPLIT, start).agg(*found)
    if seeded:
        grouped = require(grouped, F.col("__base").isNull() | (F.col("__rows") == 1), LATE)
    return grouped.select(*keys, SPLIT, start, "__payload.*", *(["__base"] if seeded else []))


def _seeds_first(timed: DataFrame, s: Scd2Spec, w: Window) -> DataFrame:
    """Fail where a change does not come after its member's current row."""
    start, seed = quoted(s.valid_from), F.col("__base").isNotNull()
    first = F.lag(start).over(w).isNull()
    alone = first & ~F.coalesce(F.col("__later") == start, F.lit(False))
    return require(timed.withColumn("__alone", alone), ~seed | F.col("__alone"), LATE)


def _edges(marked: DataFrame, s: Scd2Spec, seeded: bool) -> DataFrame:
    """What each split of a frequent key must know of its neighbours.

    ``__opens``: its first row starts a version; ``__offset``: versions before it;
    ``__next_change``: the first change after it. A key has one row per split here, so the
    windows over the key alone are small. Keys that are not cut do not appear.
    """
    keys, start = [quoted(k) for k in s.keys], quoted(s.valid_from)
    inner = F.col("__inner")
    base = F.max("__base") if seeded else F.lit(None).cast("int")
    summary = marked.filter(F.col(SPLIT) > 0).groupBy(*keys, SPLIT).agg(
        F.min_by("__state", "__n").alias("__first"),
        F.max_by("__state", "__n").alias("__last"),
        F.min(start).alias("__first_time"),
        F.min(F.when(inner, start)).alias("__first_inner"),
        F.count_if(inner).alias("__inner_changes"),
        base.alias("__edge_base"),
    )
    forward = Window.partitionBy(*keys).orderBy(SPLIT)
    backward = Window.partitionBy(*keys).orderBy(F.col(SPLIT).desc())
    linked = summary.withColumns(
        {"__place": F.row_number().over(forward), "__carry": F.lag("__last").over(forward)}
    )
    first = F.col("__place") == 1
    if seeded:
        linked = require(linked, F.col("__edge_base").isNull() | first, LATE)
        whole = F.max("__edge_base").over(Window.partitionBy(*keys))
        linked = linked.withColumn("__edge_base", whole)
    opens = first | ~F.col("__first").eqNullSafe(F.col("__carry"))
    linked = linked.withColumn("__opens", opens).withColumns(
        {
            "__changes": F.col("__inner_changes") + F.col("__opens").cast("bigint"),
            "__first_change": F.when(F.col("__opens"), F.col("__first_time")).otherwise(
                F.col("__first_inner")
            ),
        }
    )
    before = forward.rowsBetween(Window.unboundedPreceding, -1)
    after = backward.rowsBetween(Window.unboundedPreceding, -1)
    return linked.select(
        *keys,
        SPLIT,
        "__opens",
        "__edge_base",
        F.coalesce(F.sum("__changes").over(before), F.lit(0)).alias("__offset"),
        F.last("__first_change", ignorenulls=True).over(after).alias("__next_change"),
    )


def _changes_only(joined: DataFrame, s: Scd2Spec, w: Window) -> DataFrame:
    start = quoted(s.valid_from)
    number = F.col("__offset") + F.row_number().over(w)
    return joined.filter("__change").withColumns(
        {
            s.valid_to: F.coalesce(F.lead(start).over(w), F.col("__next_change")),
            s.version: number.cast("int"),
        }
    )


def _with_last_update(joined: DataFrame, s: Scd2Spec, w: Window) -> DataFrame:
    """Versions whose update-only columns hold the last value seen while each was current."""
    keys, start = [quoted(k) for k in s.keys], quoted(s.valid_from)
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Looking ahead as a running frame over the reverse order keeps the window linear.
    ahead = Window.partitionBy(*keys, SPLIT).orderBy(start.desc())
    ahead = ahead.rowsBetween(Window.unboundedPreceding, -1)
    change_time = F.when(F.col("__change"), start)
    numbered = joined.withColumns(
        {
            s.version: (F.col("__offset") + F.sum(F.col("__change").cast("int")).over(so_far)).cast(
                "int"
            ),
            s.valid_to: F.coalesce(
                F.last(change_time, ignorenulls=True).over(ahead), F.col("__next_change")
            ),
        }
    )
    opening = F.struct(*[quoted(c) for c in [*s.tracked, s.valid_from, s.valid_to]])
    latest = F.struct(*[quoted(c) for c in s.update_only])
    grouped = numbered.groupBy(*keys, quoted(s.version)).agg(
        F.min_by(opening, start).alias("__opening"), F.max_by(latest, start).alias("__latest")
    )
    return grouped.select(*keys, quoted(s.version), "__opening.*", "__latest.*")
