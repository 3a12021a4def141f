"""Profiles that add up: one small row per column and load, merged over any set of loads.

Counts and sums add and extremes compare. Distinct counts come from HyperLogLog registers, quantiles
from a histogram whose buckets grow by a fixed factor, so that a bucket's middle is within
``ACCURACY`` of every value in it. Registers and buckets depend on values alone, so what parts merge to
is what the whole gives, whatever the loads and partitions. The built-in sketches do not promise that:
their estimates depend on the order in which they were merged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.spec import quoted

ACCURACY = 0.01
GROWTH = (1 + ACCURACY) / (1 - ACCURACY)
#: Above the exponent of any double's bucket, so that keys order like the values they stand for.
ORIGIN = 1 << 20
#: Registers of a distinct count, as a power of two: a standard error of some 1.6 %.
HLL_BITS = 12
REGISTERS = 1 << HLL_BITS
NUMERIC = ("byte", "short", "integer", "long", "float", "double", "decimal")


def bucket_of(value: Column) -> Column:
    """The histogram's bucket of a finite number."""
    exponent = F.ceil(F.log(F.abs(value)) / math.log(GROWTH)).cast("long") + F.lit(ORIGIN)
    return (
        F.when(value == 0, F.lit(0).cast("long")).when(value > 0, exponent).otherwise(-exponent)
    )


def middle_of(bucket: Column) -> Column:
    """The value that stands for a bucket."""
    size = F.pow(F.lit(GROWTH), F.abs(bucket) - ORIGIN) * (2 / (GROWTH + 1))
    return F.when(bucket == 0, F.lit(0.0)).otherwise(F.signum(bucket.cast("double")) * size)


def profile_part(df: DataFrame, columns: list[str], load: str) -> DataFrame:
    """One row per column about the rows of one load, to append to a table of profiles.

    Numbers that are not finite count as rows, but not in sums, extremes or quantiles. Other columns have
    their extremes as text. An empty load gives rows with counts of 0. Three aggregates, combined
    before their shuffle; a column has 4,096 registers and at most some 150,000 buckets, the range of
    doubles.
    """
    numbers = [c for c in columns if df.schema[c].dataType.typeName() in NUMERIC]
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    for i, name in enumerate(columns):
        value = quoted(name)
        number = _finite(value) if name in numbers else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if name in numbers else value.cast("string")
        aggs += [
            F.count(value).alias(f"set{i}"),
            F.min(text).alias(f"mintext{i}"),
            F.max(text).alias(f"maxtext{i}"),
            F.min(number).alias(f"min{i}"),
            F.max(number).alias(f"max{i}"),
            F.sum(number).alias(f"sum{i}"),
        ]
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("n").alias("row_count"),
                (F.col("n") - F.col(f"set{i}")).alias("null_count"),
                F.col(f"mintext{i}").alias("min_text"),
                F.col(f"maxtext{i}").alias("max_text"),
                F.col(f"min{i}").alias("min_number"),
                F.col(f"max{i}").alias("max_number"),
                F.col(f"sum{i}").alias("number_sum"),
            )
        )
    summary = df.agg(*aggs).select(F.inline(F.array(*rows))).withColumn("load", F.lit(load))
    summary = summary.join(_registers(df, columns), "column_name", "left")
    if not numbers:
        none = F.lit(None).cast("array<struct<bucket:bigint,n:bigint>>")
        return summary.withColumn("histogram", none)
    pairs = [F.struct(F.lit(c).alias("column_name"), _finite(quoted(c)).alias("x")) for c in numbers]
    histogram = (
        df.select(F.inline(F.array(*pairs)))
        .filter("x IS NOT NULL")
        .groupBy("column_name", bucket_of(F.col("x")).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column_name")
        .agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("histogram"))
    )
    return summary.join(histogram, "column_name", "left")


def merged_profile(parts: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column over all loads in ``parts``, without the loads' own rows.

    ``quantiles`` is a list of values, each within ``ACCURACY`` of the exact quantile (the least value
    that the given share of the numbers does not exceed); null for columns without numbers.
    """
    summed = parts.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.min("min_text").alias("min_text"),
        F.max("max_text").alias("max_text"),
        F.min("min_number").alias("min_number"),
        F.max("max_number").alias("max_number"),
        F.sum("number_sum").alias("number_sum"),
    )
    buckets = (
        parts.select("column_name", F.inline("histogram"))
        .groupBy("column_name", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    whole = Window.partitionBy("column_name")
    ranked = buckets.withColumns(
        {
            "total": F.sum("n").over(whole),
            "reached": F.sum("n").over(whole.orderBy("bucket")),
        }
    )
    found = ranked.groupBy("column_name").agg(
        F.max("total").alias("numbers"),
        F.array(
            *[
                middle_of(F.min(F.when(F.col("reached") >= F.greatest(F.ceil(F.col("total") * q),
                                                                     F.lit(1)), F.col("bucket"))))
                for q in quantiles
            ]
        ).alias("quantiles"),
    )
    distinct = (
        parts.select("column_name", F.inline("registers"))
        .groupBy("column_name", "register")
        .agg(F.max("rank").alias("rank"))
        .groupBy("column_name")
        .agg(_estimate().alias("distinct_count"))
    )
    joined = summed.join(found, "column_name", "left").join(distinct, "column_name", "left")
    return joined.select(
        "column_name", "row_count", "null_count",
        F.coalesce("distinct_count", F.lit(0).cast("long")).alias("distinct_count"),
        "min_text", "max_text",
        "min_number", "max_number", (F.col("number_sum") / F.col("numbers")).alias("mean"),
        "quantiles",
    )


def _registers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column and register the greatest rank of a value's hash: one plus its leading zeros."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), quoted(c).cast("string").alias("value")) for c in columns
    ]
    hashed = F.xxhash64("value")
    rest = F.shiftrightunsigned(hashed, HLL_BITS)
    zeros = F.when(rest > 0, F.lit(64 - HLL_BITS) - F.floor(F.log2(rest)))
    return (
        df.select(F.inline(F.array(*pairs)))
        .filter("value IS NOT NULL")
        .groupBy("column_name", F.pmod(hashed, F.lit(REGISTERS)).alias("register"))
        .agg(F.max(F.coalesce(zeros, F.lit(65 - HLL_BITS)).cast("int")).alias("rank"))
        .groupBy("column_name")
        .agg(F.array_sort(F.collect_list(F.struct("register", "rank"))).alias("registers"))
    )


def _estimate() -> Column:
    """HyperLogLog's estimate over a group's registers; few values are counted by empty registers."""
    empty = F.lit(REGISTERS) - F.count(F.lit(1))
    # Ranks are at most 53, so every term is an exact multiple of the least and order does not matter.
    inverse = F.sum(F.pow(F.lit(2.0), -F.col("rank"))) + empty
    raw = F.lit(0.7213 / (1 + 1.079 / REGISTERS) * REGISTERS**2) / inverse
    few = F.lit(float(REGISTERS)) * F.log(F.lit(float(REGISTERS)) / empty)
    return F.round(F.when((raw <= 2.5 * REGISTERS) & (empty > 0), few).otherwise(raw)).cast("long")


def _finite(value: Column) -> Column:
    number = value.cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)
