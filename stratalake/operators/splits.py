"""Splitting the rows of very frequent keys, so that no key needs one task to itself.

A window over a key gathers all its rows in one task. Where a key may hold a third of a
table, its rows are first cut along their order into splits, numbered upwards, at quantiles of the
key's own values: a burst is cut as finely as its rows ask for, and stray values cost nothing.
Windows then run per key *and* split, and a summary row per split carries what one split must
know of the others.

Quantiles come from sketches, which need not agree between two runs of one plan. They are therefore
written once, below ``spark.checkpoint.dir``, and every use reads the same ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.session import scratch_dir
from stratalake.spec import quoted

SPLIT = "__split"
#: A key has at most so many splits; beyond, its splits grow.
MOST_SPLITS = 1024
#: Quantiles asked for per split, of which the cuts are chosen.
FINENESS = 8


def position(df: DataFrame, column: str) -> Column:
    """The ordering value on a numeric line; keeps order, equal values stay equal."""
    value, kind = quoted(column), df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, T.TimestampNTZType):
        # Microseconds of the wall clock, free of the session time zone and its gaps.
        minutes = F.unix_date(value.cast("date")).cast("bigint") * 1440 + F.hour(value) * 60
        seconds = (F.date_part(F.lit("SECOND"), value) * 1_000_000).cast("bigint")
        value = (minutes + F.minute(value)) * 60_000_000 + seconds
    elif isinstance(kind, T.DateType):
        value = F.unix_date(value)
    elif not isinstance(kind, T.NumericType):
        raise TypeError(f"{column}: cannot split along a column of type {kind.simpleString()}")
    return value.cast("double")


def hot_keys(
    df: DataFrame, keys: list[str], order: str, rows_per_split: int, share: float = 0.0
) -> DataFrame:
    """Keys with more than ``rows_per_split`` rows and ``share`` of the table, and their ``__cuts``.

    A key of n splits has n - 1 cuts, in order. Both passes read only the keys and the order and
    combine before their shuffle; the second one keeps a sketch per frequent key. Keys with a null
    are never cut.
    """
    names = [quoted(k) for k in keys]
    where = df.filter(reduce(lambda a, b: a & b, [n.isNotNull() for n in names])).select(
        *names, position(df, order).alias("__at")
    )
    found = where.groupBy(*names).agg(F.count(F.lit(1)).alias("__rows"))
    found = found.filter(F.col("__rows") > rows_per_split)
    if share > 0:
        total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
        found = found.filter(F.col("__rows") > total * F.lit(share))
    splits = F.least(F.lit(MOST_SPLITS), F.ceil(F.col("__rows") / F.lit(max(1, rows_per_split))))
    found = _kept(found.select(*names, splits.cast("int").alias("__splits")), "hot-keys")
    # Keys of similar size share a grid of quantiles, so a small one carries no long list.
    grid = F.lit(FINENESS) * F.pow(F.lit(2), F.ceil(F.log2("__splits"))).cast("int")
    found = found.withColumn("__grid", grid)
    sizes = sorted(r[0] for r in found.select("__grid").distinct().collect())
    if not sizes:
        return found.select(*names, F.lit(None).cast("array<double>").alias("__cuts"))
    sketched = where.join(found, keys).groupBy(*names, "__splits", "__grid").agg(*[
        F.percentile_approx(
            F.when(F.col("__grid") == size, F.col("__at")), [i / size for i in range(1, size)], 4 * size
        ).alias(f"__grid_{size}")
        for size in sizes
    ])
    values = F.coalesce(*[F.col(f"__grid_{size}") for size in sizes])
    place = F.col("__grid") / F.col("__splits")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("__splits") - 1),
        lambda n: F.get(values, F.round(n * place).cast("int") - 1),
    )
    cuts = F.when((F.col("__splits") > 1) & values.isNotNull(), cuts)
    none = F.array().cast("array<double>")
    return _kept(sketched.select(*names, F.coalesce(cuts, none).alias("__cuts")), "cuts")


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_number(where: Column) -> Column:
    """The split that a position falls in, from 1; a value that is a cut ends its split.

    Null where the row's key is not split. The cuts below the position are counted by bisection.
    """
    cuts = F.col("__cuts")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(MOST_SPLITS.bit_length()))])
    below = F.aggregate(
        steps,
        F.lit(0),
        lambda n, step: F.when(F.get(cuts, n + step - 1) < where, n + step).otherwise(n),
    )
    return F.when(cuts.isNotNull(), below + 1)


def with_splits(df: DataFrame, hot: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add the split number, 0 for rows whose key is not split."""
    number = F.coalesce(split_number(position(df, order)), F.lit(0)).cast("bigint")
    joined = left_join(df, hot, keys)
    return joined.select(*[quoted(c) for c in df.columns], number.alias(SPLIT))


def left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on equal keys, keeping only the left side's copy of them."""
    named = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [quoted(k) == quoted(f"__r_{k}") for k in keys])
    return left.join(named, on, "left").drop(*[f"__r_{k}" for k in keys])
