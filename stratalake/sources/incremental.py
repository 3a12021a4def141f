"""Reading only what is new: files not yet in the ledger, rows past a stored cursor."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.spec import quoted

SUCCESS = "success"


def unprocessed_files(files: DataFrame, ledger: DataFrame, source_name: str) -> DataFrame:
    """The listed files that no successful ledger row of this source names.

    An anti-join, planned by the sizes Spark sees; the ledger filter prunes to one partition of
    a ledger partitioned by source.
    """
    done = ledger.filter((F.col("source_name") == source_name) & (F.col("status") == SUCCESS))
    return files.join(done.select("file_path"), "file_path", "left_anti")


def incremental_scan(df: DataFrame, cursor: str, watermark: Any | None) -> DataFrame:
    """Rows whose cursor lies past the stored value; all rows where none is stored.

    The comparison reaches the scan, of files as of a database. Rows without a cursor value
    come only with the first, full load.
    """
    if watermark is None:
        return df
    kind = df.schema[cursor].dataType
    return df.filter(quoted(cursor) > F.lit(watermark).cast(kind))


def next_watermark(df: DataFrame, cursor: str) -> DataFrame:
    """One row: the greatest cursor value as text, null where nothing was read."""
    return df.agg(F.max(quoted(cursor)).cast("string").alias("watermark_value"))


def latest_watermarks(watermarks: DataFrame) -> DataFrame:
    """The newest stored value per source, table and column of an append-only table."""
    return watermarks.groupBy("source_name", "table_name", "watermark_column").agg(
        F.max_by("watermark_value", "last_updated").alias("watermark_value"),
        F.max("last_updated").alias("last_updated"),
    )


def stored_watermark(
    watermarks: DataFrame, source_name: str, table_name: str, column: str
) -> str | None:
    """The newest value of one cursor, or None before the first run: a single value."""
    mine = watermarks.filter(
        (F.col("source_name") == source_name)
        & (F.col("table_name") == table_name)
        & (F.col("watermark_column") == column)
    )
    found = latest_watermarks(mine).collect()
    return found[0].watermark_value if found else None
