"""Ingestion into a raw table as one operator: of files, and of a database's tables.

Files: list, drop files the ledger knows, read all of them as one DataFrame, validate in one
aggregate, enforce, stamp, append, record. A run that dies anywhere can be repeated: files are
announced in the ledger under their batch before the write, and the next run first looks
whether an announced batch reached the table. A batch reaches it only whole: its rows are written
beside it first, counted, and compared with what was validated.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import date, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.columns import add_audit_columns
from stratalake.operators.enforce import enforce_schema
from stratalake.operators.validate import ERROR, INFO, require_valid, validate_schema
from stratalake.session import FAILURES
from stratalake.sinks.control import (
    PROCESSED_FILES, WATERMARKS, processed_file_rows, watermark_row,
)
from stratalake.sinks.tables import (
    RowsMissing, checked, ensure_table, load_summary, table_name, write_table,
)
from stratalake.sources.checksums import file_checksums
from stratalake.sources.files import (
    READ_ERROR, SOURCE_FILE, UNTYPED, dated_paths, discover_files, read_many,
)
from stratalake.sources.incremental import (
    SUCCESS, incremental_scan, next_watermark, stored_watermark, unprocessed_files,
)
from stratalake.spec import quoted

STARTED, FAILED = "started", "failed"
# How a read fails on files: in Spark, or because they have no header.
UNREADABLE = (*FAILURES, ValueError)
LISTED = "file_path string, path string, modified_at timestamp, length bigint"


class IngestFailed(RuntimeError):
    """Files were refused, or a write did not arrive whole."""


@dataclass
class Ingested:
    status: str
    batch_id: str | None
    files_processed: int
    files_failed: int
    records: int
    summary: DataFrame
    late: int = 0


def validate_files(df: DataFrame, source: dict[str, Any]) -> DataFrame:
    """``(source_file, rows, errors)``: per file its rows and what makes it invalid.

    One aggregate for all files, columns and rules. Text sources are judged by casts, typed
    ones by their types; a record or workbook the parser rejected is an error, too.
    """
    also = [(SOURCE_FILE, "rows", INFO, F.lit(True))]
    if READ_ERROR in df.columns:
        also.append((READ_ERROR, "readable", ERROR, F.col(READ_ERROR).isNotNull()))
    findings = validate_schema(
        df,
        source.get("schema", {"columns": []}),
        untyped=source["type"] in UNTYPED,
        by=SOURCE_FILE,
        ignore=(READ_ERROR,),
        also=also,
    )
    wrong = (F.col("level") == ERROR) & ~F.col("passed")
    said = F.concat_ws(" ", "column", "rule", F.col("violations").cast("string"))
    return findings.groupBy(SOURCE_FILE).agg(
        F.max(F.when(F.col("rule") == "rows", F.col("violations"))).alias("rows"),
        F.sort_array(F.collect_list(F.when(wrong, said))).alias("errors"),
    )


def cleansed_rows(
    df: DataFrame, source: dict[str, Any], batch_id: str, at: datetime
) -> DataFrame:
    """Rows as the raw table stores them: enforced schema plus audit columns.

    Without strict validation malformed records load, too, and their text stays beside them.
    """
    schema = source.get("schema", {"columns": []})
    if schema.get("strict_validation", True):
        df = df.drop(READ_ERROR)
    typed = enforce_schema(df, schema)
    name = source.get("name", "file_system")
    return add_audit_columns(typed, name, F.col(SOURCE_FILE), batch_id, at)


def ingest_files(
    spark: SparkSession,
    source: dict[str, Any],
    target: dict[str, Any],
    at: datetime,
    day: date | None = None,
    ledger: dict[str, Any] | None = None,
    fail_on_error: bool = True,
    write_mode: str = "append",
    environment: str | None = None,
) -> Ingested:
    """Load the new files of a source into a table.

    ``source``: ``name``, ``type``, ``connection`` (``path`` or ``path_pattern`` with ``day``,
    ``file_pattern``), ``schema``, ``read_options``, ``ingestion.mode``, ``ingestion.checksum`` (true:
    the ledger gets each loaded file's checksum, which reads the files once more). ``ledger`` is the
    target of the processed-files table; incremental mode needs it. An invalid file stops the
    run; with ``fail_on_error`` false the others load and it is recorded as failed, to be
    offered again. ``at`` is the time written into the rows.
    """
    name, began = source.get("name", "file_system"), datetime.now()
    files = _new_files(spark, source, target, ledger, day, at)
    listed = files.collect()  # the paths; any file scan holds them on the driver
    if not listed:
        summary = load_summary(
            spark, source["type"], name, target, began, datetime.now(), 0,
            environment=environment, message="no files to process",
        )
        return Ingested(SUCCESS, None, 0, 0, 0, summary)
    files = spark.createDataFrame(listed, LISTED)
    try:
        raw = read_many(spark, source, files, report_errors=not fail_on_error)
        verdicts = {r[SOURCE_FILE]: r for r in validate_files(raw, source).collect()}
        refused = {}
    except UNREADABLE:
        if fail_on_error:
            raise
        unreadable = {f.file_path for f in _unreadable(spark, source, listed)}
        rest = [f for f in listed if f.file_path not in unreadable]
        refused = dict.fromkeys(unreadable, "cannot be read")
        verdicts = {}
        if rest:
            raw = read_many(spark, source, spark.createDataFrame(rest, LISTED), True)
            verdicts = {r[SOURCE_FILE]: r for r in validate_files(raw, source).collect()}
    if source.get("schema", {}).get("strict_validation", True):
        refused |= {p: ", ".join(v.errors) for p, v in verdicts.items() if v.errors}
    good = [f for f in listed if f.file_path not in refused]
    batch_id = _batch_id(good)

    def record(rows: list, status: str) -> None:
        if ledger and rows:
            took = (datetime.now() - began).total_seconds()
            fixed = {"batch_id": batch_id, "at": at, "environment": environment}
            sums = status == SUCCESS and source.get("ingestion", {}).get("checksum", False)
            _record(spark, ledger, rows, verdicts, refused, name, status, took, fixed, sums)

    if refused and (fail_on_error or not good):
        record([f for f in listed if f.file_path in refused], FAILED)
        raise IngestFailed("; ".join(f"{p}: {why}" for p, why in sorted(refused.items())))
    record(good, STARTED)
    if refused:
        raw = read_many(spark, source, spark.createDataFrame(good, LISTED), report_errors=True)
    rows = cleansed_rows(raw, source, batch_id, at)
    ensure_table(spark, target, rows)
    expected = sum(verdicts[f.file_path].rows for f in good if f.file_path in verdicts)
    try:
        with checked(rows, expected) as batch:
            written = write_table(batch, target, write_mode)
    except RowsMissing as missing:
        # The table has none of them, so the next run takes the files again.
        raise IngestFailed(f"batch {batch_id}: {missing}") from missing
    record(good, SUCCESS)
    record([f for f in listed if f.file_path in refused], FAILED)
    summary = load_summary(
        spark, source["type"], name, target, began, datetime.now(), written,
        environment=environment,
    )
    return Ingested(SUCCESS, batch_id, len(good), len(refused), written, summary)


def ingest_table(
    spark: SparkSession,
    rows: DataFrame,
    source_name: str,
    table: str,
    target: dict[str, Any],
    at: datetime,
    cursor: str | None = None,
    watermarks: dict[str, Any] | None = None,
    schema: dict[str, Any] | None = None,
    environment: str = "dev",
) -> Ingested:
    """Load a source table, as ``scan_jdbc`` gives it: its rows past the stored cursor, or all.

    Without a cursor the target is replaced. With one, the batch is the rows between the stored
    value and the greatest present when the run starts. A batch whose run died after writing it
    and before storing its cursor value is recognised, and only what came later is loaded.
    """
    began = datetime.now()

    def result(batch_id: str | None, written: int) -> Ingested:
        ended = datetime.now()
        summary = load_summary(
            spark, "jdbc", source_name, target, began, ended, written, environment=environment
        )
        return Ingested(SUCCESS, batch_id, 0, 0, written, summary)

    if cursor is None:
        loaded = stamped(rows, schema, source_name, "full", at)
        return result("full", write_table(loaded, target, "overwrite"))
    if watermarks is None:
        raise ValueError("an incremental load needs the watermarks table")
    marks = {**WATERMARKS, **watermarks}
    ensure_table(spark, marks)
    stored = stored_watermark(spark.table(table_name(marks)), source_name, table, cursor)
    batch_id = _cursor_batch(source_name, table, stored)
    begun, reached = _left_behind(spark, rows, target, cursor, stored, batch_id)

    def advance(to: DataFrame) -> None:
        row = watermark_row(to, source_name, table, cursor, F.current_timestamp(), environment)
        write_table(row, watermarks)

    if reached is not None:
        advance(spark.createDataFrame([(reached,)], "watermark_value string"))
        stored, batch_id = reached, _cursor_batch(source_name, table, reached)
    upper = next_watermark(incremental_scan(rows, cursor, stored), cursor).first().watermark_value
    # The first batch takes the rows without a cursor value, also where no row has one.
    nulls = stored is None and not begun
    batch = _between(rows, cursor, stored, upper, nulls)
    if upper is None and (not nulls or batch.isEmpty()):
        return result(None, 0)
    loaded = stamped(batch, schema, source_name, batch_id, at)
    ensure_table(spark, target, loaded)
    written = write_table(loaded, target)
    if upper is not None:
        advance(spark.createDataFrame([(upper,)], "watermark_value string"))
    return result(batch_id, written)


def _cursor_batch(source_name: str, table: str, stored: str | None) -> str:
    """A batch is named by where it starts, so a repeated run finds what a dead one left."""
    return hashlib.sha256(f"{source_name}|{table}|{stored}".encode()).hexdigest()[:32]


def _between(
    rows: DataFrame, cursor: str, stored: str | None, upper: str | None, nulls: bool
) -> DataFrame:
    """Rows past the stored value up to the upper one, and those without a value if wanted."""
    reached = quoted(cursor) <= F.lit(upper).cast(rows.schema[cursor].dataType)
    if nulls:
        return rows.filter(reached | quoted(cursor).isNull())
    return incremental_scan(rows, cursor, stored).filter(reached)


def _left_behind(spark, rows, target, cursor, stored, batch_id) -> tuple[bool, str | None]:
    """Whether this batch reached the table, and up to which cursor value that is not stored yet.

    A first batch of rows without cursor values has reached the table, but no value. Such rows
    may have come since, so only rows with a value are counted.

    The source may have moved on since: rows that changed have a later cursor value now. So
    the table may hold more rows than the source still shows for that range, but not fewer.
    """
    if not spark.catalog.tableExists(table_name(target)):
        return False, None
    mine = spark.table(table_name(target)).filter(F.col("batch_id") == batch_id)
    found = mine.agg(
        F.max(quoted(cursor)).cast("string").alias("reached"),
        F.count(F.lit(1)).alias("all"),
        F.count(quoted(cursor)).alias("present"),
    ).first()
    if found.reached is None:
        return found["all"] > 0, None
    expected = _between(rows, cursor, stored, found.reached, nulls=False).count()
    if found.present < expected:
        raise IngestFailed(f"batch {batch_id}: {found.present} of {expected} rows in the table")
    return True, found.reached


def stamped(rows, schema, source_name, batch_id, at) -> DataFrame:
    """Rows of a table as the raw table stores them: validated, enforced, with audit columns."""
    if schema:
        require_valid(validate_schema(rows, schema), schema.get("strict_validation", True))
        rows = enforce_schema(rows, schema)
    return add_audit_columns(rows, source_name, None, batch_id, at)


def _new_files(spark, source, target, ledger, day, at) -> DataFrame:
    place = source["connection"]
    if "path_pattern" in place:
        if day is None:
            raise ValueError("a path pattern needs the day to read")
        paths = dated_paths(place["path_pattern"], day)
    else:
        paths = [place["path"]]
    files = discover_files(spark, paths, place.get("file_pattern"))
    if ledger:
        ensure_table(spark, {**PROCESSED_FILES, **ledger})
    if source.get("ingestion", {}).get("mode", "full") != "incremental":
        return files
    if not ledger:
        raise ValueError("incremental mode needs a ledger")
    name = source.get("name", "file_system")
    _settle_started(spark, target, ledger, name, at)
    return unprocessed_files(files, spark.table(table_name(ledger)), name)


def _settle_started(spark, target, ledger, name, at) -> None:
    """Record batches that were announced and written by a run that died before saying so."""
    known = spark.table(table_name(ledger)).filter(F.col("source_name") == name)
    done = known.filter(F.col("status") == SUCCESS).select("batch_id").distinct()
    announced = known.filter(F.col("status") == STARTED).join(done, "batch_id", "left_anti")
    announced = announced.dropDuplicates(["batch_id", "file_path"])
    batches = [r.batch_id for r in announced.select("batch_id").distinct().collect()]
    if not batches or not spark.catalog.tableExists(table_name(target)):
        return
    stored = spark.table(table_name(target)).filter(F.col("batch_id").isin(batches))
    counts = stored.groupBy("batch_id", F.col(SOURCE_FILE).alias("file_path")).agg(
        F.count(F.lit(1)).alias("stored")
    )
    compared = announced.join(counts, ["batch_id", "file_path"], "left")
    state = compared.groupBy("batch_id").agg(
        F.sum(F.coalesce("stored", F.lit(0))).alias("stored"),
        F.sum("record_count").alias("expected"),
    )
    arrived = []
    for r in state.collect():
        if 0 < r.stored < r.expected or r.stored > r.expected:
            raise IngestFailed(f"batch {r.batch_id}: {r.stored} of {r.expected} rows in the table")
        if r.stored == r.expected and r.expected:
            arrived.append(r.batch_id)
    if arrived:
        rows = announced.filter(F.col("batch_id").isin(arrived)).withColumns(
            {"status": F.lit(SUCCESS), "processed_timestamp": F.lit(at)}
        )
        kept = spark.createDataFrame(rows.collect(), rows.schema)
        write_table(kept, _ledger_target(ledger))


def _unreadable(spark: SparkSession, source: dict[str, Any], listed: list) -> list:
    """The files that fail a read, found by halving: a few more scans, after a failure only."""
    try:
        files = spark.createDataFrame(listed, LISTED)
        read_many(spark, source, files, True).write.format("noop").mode("overwrite").save()
        return []
    except UNREADABLE:
        if len(listed) == 1:
            return listed
    half = len(listed) // 2
    return _unreadable(spark, source, listed[:half]) + _unreadable(spark, source, listed[half:])


def _batch_id(files: list) -> str:
    """The same files in the same state give the same batch."""
    text = "\n".join(sorted(f"{f.file_path}|{f.length}|{f.modified_at}" for f in files))
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def _record(spark, ledger, files, verdicts, refused, name, status, took, fixed, sums) -> None:
    data = [
        (
            f.file_path,
            f.length,
            verdicts[f.file_path].rows if f.file_path in verdicts else 0,
            refused.get(f.file_path),
        )
        for f in files
    ]
    fields = "file_path string, length bigint, record_count bigint, error_message string"
    recorded = spark.createDataFrame(data, fields)
    if sums:
        found = file_checksums(spark, spark.createDataFrame(files, LISTED))
        recorded = recorded.join(found, "file_path", "left")
    rows = processed_file_rows(
        recorded,
        name,
        status=status,
        duration_seconds=took,
        created_by=spark.sparkContext.sparkUser(),
        **fixed,
    )
    write_table(rows, _ledger_target(ledger))


def _ledger_target(ledger: dict[str, Any]) -> dict[str, Any]:
    return {**ledger, "partition_columns": PROCESSED_FILES["partition_columns"]}
