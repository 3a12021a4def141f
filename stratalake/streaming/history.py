"""Keeping a Type-2 dimension up to date from a stream of changes."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.operators.scd2 import Scd2Spec, apply_changes, build_history
from stratalake.sinks.history import HistoryStore
from stratalake.spec import quoted


def maintain_history(
    changes: DataFrame,
    store: HistoryStore,
    time: str,
    checkpoint: str,
    tie_breakers: list[str] | None = None,
) -> StreamingQuery:
    """Apply the changes that have arrived to the stored dimension, then stop.

    Every change keeps its own time and opens its own version, so the result does not depend
    on how the feed falls into micro-batches. A commit names the stream, by the identity its
    checkpoint keeps, and the batch: one that Spark repeats finds itself committed and does
    nothing, and a store filled by other means, or by a stream of another checkpoint, skips none.

    A change that equals the member's current version in time and values was delivered again and
    does nothing. Any other change not later than the current version is set aside, whole, below
    the store's ``late`` folder, for a rebuild of its member; the stream goes on.

    A batch is read several times, and a stream's batch is neither columnar nor of known size.
    So the columns in use are first stored next to the dimension, and read from there.
    """
    ties = tie_breakers or []
    spec = store.spec
    needed = list(dict.fromkeys([*spec.keys, *spec.payload, *ties, time]))

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream = spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first().id
        done = store.applied(stream)
        if done is not None and number <= done:
            return
        newest = store.latest()
        epoch = 0 if newest is None else newest + 1
        columns = batch.select(*[quoted(c) for c in needed])
        columns.write.mode("overwrite").parquet(store.batches)
        feed = spark.read.schema(columns.schema).parquet(store.batches)
        if newest is None:
            rows = build_history(feed, spec, time, ties)
        else:
            current = store.current()
            feed, late = _by_arrival(feed, current, spec, time)
            if late.limit(1).count():
                late.write.mode("overwrite").parquet(f"{store.late}/epoch={epoch}")
            rows = apply_changes(current, feed, spec, time, ties)
        store.commit(rows, epoch, stream, number)

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _by_arrival(
    feed: DataFrame, current: DataFrame, spec: Scd2Spec, time: str
) -> tuple[DataFrame, DataFrame]:
    """The changes after their members' current versions, and those that come too late."""
    types = {f.name: f.dataType for f in current.schema.fields}
    held = current.select(
        *[quoted(k).alias(f"__key{i}") for i, k in enumerate(spec.keys)],
        quoted(spec.valid_from).alias("__since"),
        F.struct(*[quoted(c) for c in spec.payload]).alias("__held"),
    )
    same = [quoted(k).cast(types[k]) == F.col(f"__key{i}") for i, k in enumerate(spec.keys)]
    met = feed.join(held, reduce(and_, same), "left")
    at = quoted(time).cast(types[spec.valid_from])
    values = F.struct(*[quoted(c).cast(types[c]).alias(c) for c in spec.payload])
    fresh = F.coalesce(at > F.col("__since"), F.lit(True))
    again = (at == F.col("__since")) & values.eqNullSafe(F.col("__held"))
    kept = [quoted(c) for c in feed.columns]
    return met.filter(fresh).select(*kept), met.filter(~fresh & ~again).select(*kept)
