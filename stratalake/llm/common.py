"""What the text operators share: registration, staged tables, words and bounded broadcasts."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Words are what stands between runs of ASCII punctuation, spaces, controls and capitals.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def query(name: str, sql: str | None = None) -> Callable:
    def register(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = function
        if sql:
            ORACLE[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write rows below ``spark.checkpoint.dir`` and read them back: lineage ends there."""
    path = scratch_dir(df.sparkSession, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words_of(text: Column) -> Column:
    """Lower-cased words; null has none.

    Text is split, which takes a small part of the time that extracting matches takes.
    """
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN_WORDS)
    return F.array_remove(parts, "")


def document_keys(identifier: Column, text: Column) -> list[Column]:
    """What tells documents apart: the identifier and the text.

    Rows that agree in both are repeats of one row and get one and the same result, so a join on
    these two columns never multiplies rows. The first may be null: join null-safe.
    """
    return [identifier.alias("__id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("__text")]


def same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["__id"].eqNullSafe(right["__id"]) & (left["__text"] == right["__text"])


#: Bits of a filter by hash for every key, and the most it ever holds: 64 MiB.
FILTER_BITS, MOST_FILTER_BITS = 64, 2**29
#: Bits of one row of a filter, as ``bitmap_construct_agg`` has it.
ROW_BITS = 32768


def perhaps_among(df: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """The rows of ``df`` whose columns may be among ``keys``: all that are, and few others.

    Before a large table is shuffled for a join with few keys, this leaves most of it where it is.
    A bit for each hash, in rows that are broadcast: eight bytes a key, and never more than 64 MiB,
    beyond which more of the other rows pass. The exact join must follow. Nulls are equal here.
    """
    count = max(keys.count(), 1)
    bits = min(max(ROW_BITS, 1 << (count * FILTER_BITS - 1).bit_length()), MOST_FILTER_BITS)

    def place(of: DataFrame) -> Column:
        missing = [of[c].isNull() for c in columns]
        return F.pmod(F.xxhash64(*missing, *[of[c] for c in columns]), F.lit(bits))

    marked = keys.select(place(keys).alias("__place")).groupBy(
        F.shiftright("__place", 15).alias("__row")
    )
    held = marked.agg(F.bitmap_construct_agg(F.pmod("__place", F.lit(ROW_BITS))).alias("__bits"))
    found = df.withColumn("__place", place(df))
    found = found.withColumn("__row", F.shiftright("__place", 15)).join(F.broadcast(held), "__row")
    within = F.pmod("__place", F.lit(ROW_BITS))
    byte = F.substring("__bits", F.floor(within / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(within, F.lit(8)).cast("int"))
    return found.filter(bit == 1).select(*df.columns)


def broadcast_below(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint for a table counted to hold at most ``rows``; larger ones get none."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
