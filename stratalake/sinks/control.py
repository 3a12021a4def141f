"""Rows for the three control tables: processed files, watermarks, quality results.

The tables are append-only and partitioned by a stored date or by source. Each function returns
rows in the table's shape; ``write_table`` appends them.
"""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns of the control tables, each with the date it is partitioned by.
PROCESSED_FILES = {
    "columns": [
        {"name": "file_path", "type": "string", "nullable": False},
        {"name": "source_name", "type": "string", "nullable": False},
        {"name": "processed_timestamp", "type": "timestamp", "nullable": False},
        {"name": "file_size_bytes", "type": "bigint"},
        {"name": "record_count", "type": "bigint"},
        {"name": "checksum", "type": "string"},
        {"name": "processing_duration_seconds", "type": "double"},
        {"name": "status", "type": "string"},
        {"name": "error_message", "type": "string"},
        {"name": "batch_id", "type": "string"},
        {"name": "environment", "type": "string"},
        {"name": "created_by", "type": "string"},
        {"name": "processed_date", "type": "date"},
    ],
    "partition_columns": ["source_name", "processed_date"],
}
WATERMARKS = {
    "columns": [
        {"name": "source_name", "type": "string", "nullable": False},
        {"name": "table_name", "type": "string", "nullable": False},
        {"name": "watermark_column", "type": "string", "nullable": False},
        {"name": "watermark_value", "type": "string", "nullable": False},
        {"name": "last_updated", "type": "timestamp", "nullable": False},
        {"name": "environment", "type": "string", "nullable": False},
    ]
}
QUALITY_RESULTS = {
    "columns": [
        {"name": "check_id", "type": "string", "nullable": False},
        {"name": "table_name", "type": "string", "nullable": False},
        {"name": "check_type", "type": "string", "nullable": False},
        {"name": "check_name", "type": "string", "nullable": False},
        {"name": "status", "type": "string", "nullable": False},
        {"name": "result_details", "type": "string"},
        {"name": "records_checked", "type": "bigint"},
        {"name": "records_failed", "type": "bigint"},
        {"name": "check_timestamp", "type": "timestamp", "nullable": False},
        {"name": "batch_id", "type": "string"},
        {"name": "environment", "type": "string"},
        {"name": "check_date", "type": "date"},
    ],
    "partition_columns": ["check_date"],
}


def _shaped(df: DataFrame, table: dict[str, Any], values: dict[str, Column]) -> DataFrame:
    missing = F.lit(None)
    return df.select(
        *[values.get(c["name"], missing).cast(c["type"]).alias(c["name"]) for c in table["columns"]]
    )


def processed_file_rows(
    files: DataFrame,
    source_name: str,
    batch_id: str,
    at: datetime | Column,
    status: Column | str = "success",
    environment: str | None = None,
    created_by: str | None = None,
    duration_seconds: float | None = None,
) -> DataFrame:
    """Ledger rows for files; counts, sizes, checksums and errors are taken where present."""
    present = {
        "file_size_bytes": "length", "record_count": "record_count",
        "checksum": "checksum", "error_message": "error_message",
    }
    moment = at if isinstance(at, Column) else F.lit(at)
    values = {
        "file_path": F.col("file_path"),
        "source_name": F.lit(source_name),
        "processed_timestamp": moment,
        "processing_duration_seconds": F.lit(duration_seconds),
        "status": status if isinstance(status, Column) else F.lit(status),
        "batch_id": F.lit(batch_id),
        "environment": F.lit(environment),
        "created_by": F.lit(created_by),
        "processed_date": moment.cast("date"),
        **{k: F.col(c) for k, c in present.items() if c in files.columns},
    }
    return _shaped(files, PROCESSED_FILES, values)


def rows_per_file(data: DataFrame, files: DataFrame, file_column: str = "source_file") -> DataFrame:
    """The listed files with the number of rows each has in the data, 0 included."""
    counts = data.groupBy(F.col(file_column).alias("file_path")).agg(
        F.count(F.lit(1)).alias("record_count")
    )
    joined = files.join(counts, "file_path", "left")
    return joined.withColumn("record_count", F.coalesce("record_count", F.lit(0)))


def watermark_row(
    advanced: DataFrame,
    source_name: str,
    table_name: str | Column,
    column: str,
    at: datetime | Column,
    environment: str = "dev",
) -> DataFrame:
    """The new cursor value as a row, or no row where nothing new was read."""
    values = {
        "source_name": F.lit(source_name),
        "table_name": table_name if isinstance(table_name, Column) else F.lit(table_name),
        "watermark_column": F.lit(column),
        "watermark_value": F.col("watermark_value"),
        "last_updated": at if isinstance(at, Column) else F.lit(at),
        "environment": F.lit(environment),
    }
    return _shaped(advanced.filter(F.col("watermark_value").isNotNull()), WATERMARKS, values)


def quality_rows(
    results: DataFrame,
    table_name: str,
    batch_id: str,
    at: datetime | Column,
    environment: str | None = None,
) -> DataFrame:
    """Quality results as rows of their control table; the id is fixed by batch and check."""
    moment = at if isinstance(at, Column) else F.lit(at)
    identity = F.concat_ws("|", F.lit(batch_id), F.lit(table_name), F.col("check_name"))
    values = {
        "check_id": F.sha2(identity, 256),
        "table_name": F.lit(table_name),
        "check_type": F.col("check_type"),
        "check_name": F.col("check_name"),
        "status": F.when(F.col("passed"), F.lit("passed")).otherwise(F.lit("failed")),
        "result_details": F.col("details"),
        "records_checked": F.col("records_checked"),
        "records_failed": F.col("records_failed"),
        "check_timestamp": moment,
        "batch_id": F.lit(batch_id),
        "environment": F.lit(environment),
        "check_date": moment.cast("date"),
    }
    return _shaped(results, QUALITY_RESULTS, values)
