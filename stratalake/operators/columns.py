"""Column operators, each a narrow projection or filter, and the union by name."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.cleaning import standardize
from stratalake.spec import quoted


def add_audit_columns(
    df: DataFrame,
    source_system: str = "unknown",
    source_file: Column | str | None = None,
    batch_id: str | None = None,
    at: Column | datetime | None = None,
) -> DataFrame:
    """Stamp rows with when and whence they came.

    ``at`` defaults to the time of the query. ``source_file`` may be a column, such as the
    reader's ``_metadata.file_path``, so one multi-file read can stamp each row by its file.
    """
    added = {
        "ingestion_timestamp": _moment(at),
        "source_system": F.lit(source_system),
    }
    if source_file is not None:
        named = isinstance(source_file, str)
        added["source_file"] = F.lit(source_file) if named else source_file
    if batch_id is not None:
        added["batch_id"] = F.lit(batch_id)
    return df.withColumns(added)


def add_processed_timestamp(
    df: DataFrame, at: Column | datetime | None = None, name: str = "processed_timestamp"
) -> DataFrame:
    return df.withColumn(name, _moment(at))


def _moment(at: Column | datetime | None) -> Column:
    if at is None:
        return F.current_timestamp()
    return at if isinstance(at, Column) else F.lit(at)


def derive_columns(df: DataFrame, columns: list[dict[str, str]]) -> DataFrame:
    """Add ``{name, expression}`` columns; an expression may use those listed before it.

    New names go into one projection that refers to its own aliases. A name that replaces an
    existing column needs its own step, so that later expressions see the new value.
    """
    names = [c["name"] for c in columns]
    if len(set(names)) == len(names) and not set(names) & set(df.columns):
        return df.select("*", *[F.expr(c["expression"]).alias(c["name"]) for c in columns])
    return reduce(
        lambda d, c: d.withColumn(c["name"], F.expr(c["expression"])), columns, df
    )


def standardize_columns(df: DataFrame, rules: dict[str, list[dict[str, Any]]]) -> DataFrame:
    """Apply each column's rule list (see ``functions.cleaning``) in one projection."""
    return df.withColumns({name: standardize(quoted(name), todo) for name, todo in rules.items()})


def default_nulls(df: DataFrame, defaults: dict[str, Any]) -> DataFrame:
    """Replace null by a constant, column by column, keeping each column's type."""
    return df.withColumns(
        {
            n: F.coalesce(quoted(n), F.lit(v).cast(df.schema[n].dataType))
            for n, v in defaults.items()
        }
    )


def filter_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with null in any of the columns; reaches the scan as a pushed filter."""
    return df.filter(reduce(lambda a, b: a & b, [quoted(c).isNotNull() for c in columns]))


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Stack frames by column name, null where a frame lacks a column.

    Enforce each frame's schema first: a column that is text in one and a number in another
    would otherwise be widened by Spark's rules rather than by the declaration.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
