"""Loads by cursor that also find rows which come late: with the stored value itself, or with none.

A cursor of seconds or days is shared by many rows, and a source may commit some of them after a run
has read the others. Each run therefore reads the stored value's rows again, and those without a
value, and leaves out what it has loaded before. For that a state table keeps the keys of just these
rows. It holds the steps of each batch, too, so that an ordinary run never looks into the target.
"""

from __future__ import annotations

import hashlib
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.hashing import record_hash
from stratalake.plans.ingest import FAILED, STARTED, IngestFailed, Ingested, stamped
from stratalake.session import discard, scratch_dir
from stratalake.sinks.control import WATERMARKS, watermark_row
from stratalake.sinks.tables import ensure_table, load_summary, table_name, write_table
from stratalake.sources.incremental import SUCCESS, incremental_scan, stored_watermark
from stratalake.spec import quoted

KEY = "key"
ROW_KEY = "__row_key"

#: One row per step of a batch, and per key that a later run may meet again.
LOAD_STATE = {
    "columns": [
        {"name": "source_name", "type": "string", "nullable": False},
        {"name": "table_name", "type": "string", "nullable": False},
        {"name": "watermark_column", "type": "string", "nullable": False},
        {"name": "batch_id", "type": "string", "nullable": False},
        {"name": "watermark_value", "type": "string"},
        {"name": "row_key", "type": "string"},
        {"name": "record_count", "type": "bigint"},
        {"name": "recorded_at", "type": "timestamp", "nullable": False},
        {"name": "status", "type": "string", "nullable": False},
    ],
    "partition_columns": ["status"],
}


def ingest_table_overlapping(
    spark: SparkSession,
    rows: DataFrame,
    source_name: str,
    table: str,
    target: dict[str, Any],
    at: datetime,
    cursor: str,
    watermarks: dict[str, Any],
    state: dict[str, Any],
    keys: list[str] | None = None,
    schema: dict[str, Any] | None = None,
    environment: str = "dev",
) -> Ingested:
    """Load the rows past the stored cursor value, and late ones at it or without a value.

    ``keys`` name a row; without them all its columns do. A row at the stored value, or without one,
    is loaded unless a finished batch has loaded this key with this value: so repeated rows of one
    batch all load, and later repeats of them do not. ``late`` of the result counts such rows after
    the first batch. The batch is written aside before the target gets it, so what is counted,
    remembered and loaded is the same although the source goes on changing.

    A run may die anywhere. Its batch is announced before the target gets rows; the next run finds an
    announced batch without an end and looks for it in the target, the only time it is read: a whole one
    is finished, an absent one given up, and one of another size is an error.
    """
    began, scope = datetime.now(), (source_name, table, cursor)
    marks, kept = {**WATERMARKS, **watermarks}, {**LOAD_STATE, **state}
    ensure_table(spark, marks)
    ensure_table(spark, kept)

    def step(status: str, batch_id: str, value: str | None, records: int) -> DataFrame:
        row = [(batch_id, value, None, records)]
        fields = "batch_id string, watermark_value string, row_key string, record_count bigint"
        return _state_rows(spark.createDataFrame(row, fields), scope, status)

    def finish(batch_id: str, value: str | None, records: int) -> None:
        """Store the cursor value, then the end: a run that died between them does both again."""
        stored_now = stored_watermark(spark.table(table_name(marks)), *scope)
        if value is not None and value != stored_now:
            reached = spark.createDataFrame([(value,)], "watermark_value string")
            row = watermark_row(reached, *scope, F.current_timestamp(), environment)
            write_table(row, marks)
        write_table(step(SUCCESS, batch_id, value, records), kept)

    def result(batch_id: str | None, written: int, late: int = 0) -> Ingested:
        summary = load_summary(
            spark, "jdbc", source_name, target, began, datetime.now(), written,
            environment=environment,
        )
        return Ingested(SUCCESS, batch_id, 0, 0, written, summary, late)

    for batch in _open_batches(_mine(spark, kept, scope)):
        if _arrived(spark, target, batch.batch_id, batch.record_count):
            finish(batch.batch_id, batch.watermark_value, batch.record_count)
        else:
            write_table(step(FAILED, batch.batch_id, batch.watermark_value, 0), kept)
    known = _mine(spark, kept, scope)
    attempts, done = known.agg(
        F.count_if(F.col("status") == STARTED), F.count_if(F.col("status") == SUCCESS)
    ).first()
    stored = stored_watermark(spark.table(table_name(marks)), *scope)
    batch_id = hashlib.sha256("|".join([*scope, str(attempts)]).encode()).hexdigest()[:32]

    seen, path = Observation(), scratch_dir(spark, "cursor-batch")
    fresh = _fresh(rows, known, cursor, stored, keys)
    try:
        fresh.observe(
            seen,
            F.count(F.lit(1)).alias("records"),
            F.count_if("__late").alias("late"),
            F.max(quoted(cursor)).cast("string").alias("upper"),
        ).write.parquet(path)
        found = seen.get
        if not found["records"]:
            return result(None, 0)
        batch = spark.read.schema(fresh.schema).parquet(path)
        upper = found["upper"] if found["upper"] is not None else stored
        loaded = stamped(batch.drop(ROW_KEY, "__late"), schema, source_name, batch_id, at)
        ensure_table(spark, target, loaded)
        value = quoted(cursor).cast("string")
        met_again = batch.filter(value.isNull() | (value == F.lit(upper))).select(
            F.lit(batch_id).alias("batch_id"),
            value.alias("watermark_value"),
            F.col(ROW_KEY).alias("row_key"),
            F.lit(None).cast("bigint").alias("record_count"),
        )
        # One append announces the batch and its keys, which count only once the batch has ended.
        announced = step(STARTED, batch_id, upper, found["records"])
        write_table(announced.unionByName(_state_rows(met_again.distinct(), scope, KEY)), kept)
        written = write_table(loaded, target)
        if written != found["records"]:
            raise IngestFailed(f"batch {batch_id}: {written} of {found['records']} rows written")
        finish(batch_id, upper, written)
    finally:
        discard(spark, path)
    return result(batch_id, written, found["late"] if done else 0)


def _fresh(
    rows: DataFrame, known: DataFrame, cursor: str, stored: str | None, keys: list[str] | None
) -> DataFrame:
    """Rows past the stored value, and unseen ones at it or without one.

    Only the latter take part in the anti-join; what lies past the value is not moved.
    """
    value, named = quoted(cursor), rows.withColumn(ROW_KEY, record_hash(rows, keys or rows.columns))
    past, again = incremental_scan(named, cursor, stored).filter(value.isNotNull()), value.isNull()
    if stored is not None:
        again |= value == F.lit(stored).cast(rows.schema[cursor].dataType)
    finished = known.filter(F.col("status") == SUCCESS).select("batch_id").distinct()
    loaded = (
        known.filter(F.col("status") == KEY)
        .filter(F.col("watermark_value").isNull() | (F.col("watermark_value") == F.lit(stored)))
        .join(finished, "batch_id", "left_semi")
        .select(F.col("row_key").alias("__seen"), F.col("watermark_value").alias("__at"))
    )
    same = (F.col(ROW_KEY) == F.col("__seen")) & value.cast("string").eqNullSafe(F.col("__at"))
    late = named.filter(again).join(loaded, same, "left_anti")
    return past.withColumn("__late", F.lit(False)).unionByName(late.withColumn("__late", F.lit(True)))


def _mine(spark: SparkSession, kept: dict[str, Any], scope: tuple[str, str, str]) -> DataFrame:
    names = ("source_name", "table_name", "watermark_column")
    state = spark.table(table_name(kept))
    for name, value in zip(names, scope):
        state = state.filter(F.col(name) == value)
    return state


def _open_batches(known: DataFrame) -> list:
    """Batches announced and neither finished nor given up: at most the one that died last."""
    ended = known.filter(F.col("status").isin(SUCCESS, FAILED)).select("batch_id")
    return known.filter(F.col("status") == STARTED).join(ended, "batch_id", "left_anti").collect()


def _arrived(spark: SparkSession, target: dict[str, Any], batch_id: str, records: int) -> bool:
    if not spark.catalog.tableExists(table_name(target)):
        return False
    found = spark.table(table_name(target)).filter(F.col("batch_id") == batch_id).count()
    if found not in (0, records):
        raise IngestFailed(f"batch {batch_id}: {found} of {records} rows in the table")
    return found == records


def _state_rows(rows: DataFrame, scope: tuple[str, str, str], status: str) -> DataFrame:
    return rows.select(
        F.lit(scope[0]).alias("source_name"),
        F.lit(scope[1]).alias("table_name"),
        F.lit(scope[2]).alias("watermark_column"),
        "batch_id", "watermark_value", "row_key", "record_count",
        F.current_timestamp().alias("recorded_at"),
        F.lit(status).alias("status"),
    )

