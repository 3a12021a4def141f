"""Keep-latest de-duplication as an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.spec import quoted


def deduplicate_latest(
    df: DataFrame, keys: list[str], order_by: list[str], tie_breakers: list[str] | None = None
) -> DataFrame:
    """One row per key: the one greatest in ``order_by``, nulls least; null keys are one group.

    Ties go to the greatest in ``tie_breakers``, by default all other columns in order, so the
    survivor never depends on arrival order. An aggregate, not a window: each task first
    reduces its own rows to one per key, so a key that holds a third of the table sends one
    row per task through the shuffle and is never gathered whole.
    """
    payload = [c for c in df.columns if c not in keys]
    ties = [c for c in payload if c not in order_by] if tie_breakers is None else tie_breakers
    rank = F.struct(*[quoted(c) for c in [*order_by, *ties]])
    row = F.struct(*[quoted(c) for c in payload]) if payload else F.struct(F.lit(1))
    latest = df.groupBy(*[quoted(k) for k in keys]).agg(F.max_by(row, rank).alias("__row"))
    picked = [quoted(c) if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns]
    return latest.select(*picked)
