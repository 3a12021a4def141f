"""Conditions that stop a running query: they live in the plan and need no job of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, condition: Column, message: Column | str) -> DataFrame:
    """Pass every row on, but fail the query at the first row that breaks the condition.

    The condition sits in a filter, which the optimizer cannot prune away as it could an
    unused column.
    """
    text = F.lit(message) if isinstance(message, str) else message
    failure = F.raise_error(text).cast("boolean")
    return df.filter(F.when(condition, F.lit(True)).otherwise(failure))
