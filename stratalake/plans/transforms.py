"""User transforms: a SQL text or a Python callable over DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def sql_transform(
    spark: SparkSession, text: str, args: dict[str, Any] | None = None, **frames: DataFrame
) -> DataFrame:
    """Run a statement that names its inputs as ``{name}`` and its parameters as ``:name``.

    Values are bound, not pasted into the text.
    """
    return spark.sql(text, args=args, **frames)


def df_transform(
    df: DataFrame, function: Callable[..., DataFrame], **config: Any
) -> DataFrame:
    """Apply ``function(df, **config)``."""
    return df.transform(function, **config)
