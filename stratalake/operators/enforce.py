"""Bring a DataFrame to its declared schema. Every function is one projection."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.casting import cast_to_spec, with_default
from stratalake.spec import columns_of, declared_type, quoted


def cast_columns(df: DataFrame, schema: dict[str, Any]) -> DataFrame:
    """Cast each declared column that is present; what does not fit becomes null."""
    return df.withColumns(
        {
            c["name"]: cast_to_spec(c, df.schema[c["name"]].dataType)
            for c in columns_of(schema)
            if c["name"] in df.columns
        }
    )


def fill_defaults(df: DataFrame, schema: dict[str, Any]) -> DataFrame:
    """Put the declared default for null in non-nullable columns."""
    return df.withColumns(
        {
            c["name"]: with_default(quoted(c["name"]), c)
            for c in columns_of(schema)
            if c["name"] in df.columns
        }
    )


def add_missing_columns(df: DataFrame, schema: dict[str, Any]) -> DataFrame:
    """Append absent declared columns as typed nulls, in declared order."""
    return df.withColumns(
        {
            c["name"]: F.lit(None).cast(declared_type(c))
            for c in columns_of(schema)
            if c["name"] not in df.columns
        }
    )


def drop_extra_columns(df: DataFrame, schema: dict[str, Any]) -> DataFrame:
    """Keep only declared columns, in declared order."""
    return df.select(*[quoted(c["name"]) for c in columns_of(schema) if c["name"] in df.columns])


def enforce_schema(
    df: DataFrame, schema: dict[str, Any], drop_extra: bool = False
) -> DataFrame:
    """Cast, fill defaults, add missing columns; undeclared columns stay unless dropped.

    Present columns keep their place and missing ones follow in declared order. Applying it
    twice gives the same as once.
    """
    declared = {c["name"]: c for c in columns_of(schema)}
    kept = [n for n in declared if n in df.columns] if drop_extra else df.columns
    out = []
    for name in kept:
        spec = declared.get(name)
        value = quoted(name)
        if spec:
            value = with_default(cast_to_spec(spec, df.schema[name].dataType), spec)
        out.append(value.alias(name))
    for name, spec in declared.items():
        if name not in df.columns:
            out.append(F.lit(None).cast(declared_type(spec)).alias(name))
    return df.select(*out)
