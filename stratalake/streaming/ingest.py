"""Incremental file ingestion as a stream: the checkpoint remembers which files were read."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratalake.operators.validate import SchemaInvalid
from stratalake.plans.ingest import LISTED, cleansed_rows, validate_files
from stratalake.session import FAILURES
from stratalake.sources.files import SOURCE_FILE, declared_names, read_many
from stratalake.spec import string_struct, struct_type

BATCH = "ingest_batch"
KINDS = ("csv", "json", "parquet", "excel")
# What Spark's binary reader delivers, for a stream must say it; what makes a path a
# pattern; how verdicts on files look.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"
PATTERN = "{}[]*?\\"
VERDICTS = f"{SOURCE_FILE} string, rows bigint, errors array<string>"


def read_file_stream(
    spark: SparkSession, source: dict[str, Any], path: str, files_per_batch: int | None = None
) -> DataFrame:
    """A stream of a folder's files as ``discover_files`` lists them, with the folder as ``base``.

    Contents are not read. ``ingest_stream`` reads the files of each micro-batch as a batch load
    does, so undeclared columns stay and columns may stand in any order.
    """
    if source["type"] not in KINDS:
        raise ValueError(f"cannot stream files of format {source['type']}")
    options = dict(source.get("read_options", {}))
    if files_per_batch:
        options["maxFilesPerTrigger"] = str(files_per_batch)
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE)
    return reader.options(**options).load(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        "path",
        F.col("modificationTime").alias("modified_at"),
        "length",
        F.lit(path).alias("base"),
    )


def ingest_stream(
    stream: DataFrame,
    source: dict[str, Any],
    out: str,
    checkpoint: str,
    at: datetime | None = None,
    fail_on_error: bool = True,
) -> StreamingQuery:
    """Read, validate, enforce, stamp and store the files that have arrived, then stop.

    Each micro-batch replaces a folder of its own below ``out``, so a batch that Spark repeats
    after a failure is stored once. An invalid or unreadable file stops the stream at its batch;
    with ``fail_on_error`` false it is left out and its errors go to ``out`` + ``_rejected``.
    Files may differ in their undeclared columns: read ``out`` with ``mergeSchema`` to see all.
    """
    schema = source["schema"]
    strict = schema.get("strict_validation", True)

    def store(batch: DataFrame, number: int) -> None:
        spark, files = batch.sparkSession, batch.collect()  # paths; any file scan holds them
        given = _below(source, files)
        groups = _judged(spark, given, [f[:4] for f in files], fail_on_error) if files else []
        invalid = [v for _, verdicts in groups for v in verdicts if v[2] and (strict or v[1] is None)]
        if invalid and fail_on_error:
            raise SchemaInvalid([_Refused(f, ", ".join(why), rows) for f, rows, why in invalid])
        if invalid:
            refused = spark.createDataFrame(invalid, VERDICTS)
            refused.write.mode("overwrite").json(f"{out.rstrip('/')}_rejected/{BATCH}={number}")
        left = {v[0] for v in invalid}
        name, folder = source.get("name", "file_stream"), f"{out.rstrip('/')}/{BATCH}={number}"
        now, mode = at or datetime.now(), "overwrite"
        for listed, _ in groups:
            good = [f for f in listed if f[0] not in left]
            if good:
                raw = read_many(spark, given, spark.createDataFrame(good, LISTED), True)
                rows = cleansed_rows(raw, given, f"{name}-{number}", now)
                rows.write.mode(mode).parquet(folder)
                mode = "append"
        if mode == "overwrite":
            raw = spark.createDataFrame([], _empty(source))
            cleansed_rows(raw, given, f"{name}-{number}", now).write.mode(mode).parquet(folder)

    writer = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _below(source: dict[str, Any], files: list) -> dict[str, Any]:
    """The source with the streamed folder as base, so that folders named ``a=b`` give columns."""
    if source["type"] == "excel" or not files or set(files[0].base) & set(PATTERN):
        return source
    return {**source, "read_options": {"basePath": files[0].base, **source.get("read_options", {})}}


def _empty(source: dict[str, Any]):
    if source["type"] == "parquet":
        return struct_type(source["schema"]).add(SOURCE_FILE, "string")
    return string_struct([*declared_names(source["schema"]), SOURCE_FILE])


def _judged(spark, source, files: list, fail_on_error: bool) -> list[tuple[list, list]]:
    """Files that can be read as one, with their verdicts: all, or by halves where that fails.

    A file that cannot be read on its own has no number of rows.
    """
    try:
        raw = read_many(spark, source, spark.createDataFrame(files, LISTED), report_errors=True)
        return [(files, [tuple(r) for r in validate_files(raw, source).collect()])]
    except (*FAILURES, ValueError) as failed:
        if fail_on_error:
            raise
        if len(files) == 1:
            return [(files, [(files[0][0], None, [f"cannot be read: {str(failed)[:500]}"])])]
    half = len(files) // 2
    return [g for part in (files[:half], files[half:]) for g in _judged(spark, source, part, False)]


class _Refused:
    def __init__(self, file: str, errors: str, rows: int):
        self.column, self.rule, self.violations = file, errors, rows
