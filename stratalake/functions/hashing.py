"""A record hash that tells apart what ``concat_ws`` would merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.spec import quoted


def record_hash(df: DataFrame, names: list[str]) -> Column:
    """SHA-256 over the named columns.

    Each value is written as ``length:value`` and null as ``N``, so no two different
    records share an encoding: neither null against empty text, nor values that swap columns.
    """
    parts = []
    for name in names:
        text = _as_text(quoted(name), df.schema[name].dataType)
        encoded = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(encoded, F.lit("N")))
    return F.sha2(F.concat(*parts), 256)


def _as_text(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (value + F.lit(0.0)).cast("string")  # -0.0 and 0.0 are one value
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")  # independent of the session time zone
    if isinstance(kind, T.BinaryType):
        return F.base64(value)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    return value.cast("string")
