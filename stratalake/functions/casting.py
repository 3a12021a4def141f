"""Casts that give null instead of failing, and the defaults that follow them."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.spec import declared_type, quoted


def cast_to_spec(column: dict[str, Any], actual: T.DataType) -> Column:
    """The declared column cast to its declared type; a value that does not fit is null.

    Where the column arrives as a string, a ``format`` on a date or timestamp applies, and
    nested types are read from their JSON text.
    """
    source, target = quoted(column["name"]), declared_type(column)
    if actual == target:
        return source
    if isinstance(actual, T.StringType):
        if column.get("format"):
            return parse_time(source, target, column["format"])
        if isinstance(target, (T.ArrayType, T.MapType, T.StructType)):
            return F.from_json(source, target)
    return source.try_cast(target)


def parse_time(source: Column, target: T.DataType, fmt: str) -> Column:
    """Parse a string by a datetime pattern; null where it does not match."""
    if isinstance(target, T.DateType):
        return F.try_to_date(source, fmt)
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        return F.try_to_timestamp(source, F.lit(fmt)).cast(target)
    return source.try_cast(target)


def with_default(value: Column, column: dict[str, Any]) -> Column:
    """Fill nulls of a non-nullable column that declares a default."""
    default = column.get("default")
    if default is None or column.get("nullable", True):
        return value
    return F.coalesce(value, F.lit(default).cast(declared_type(column)))
