"""Mixing sources to target weights by Poisson replication.

Each document's number of copies is the Poisson quantile, with its source's target repetition rate
as mean, of a number in [0, 1) made from its identifier. Copies of one document do not depend on
other documents or on the partitioning, and the expected amount of each source is its target
exactly. The copies then move to their places in a global order by hash.

The rates need one pass that combines per partition. There is one rate per listed source and one
for all others together, so the table of quantiles that is broadcast is bounded by the caller's
own list; a source with a third of all rows needs no shuffle of its own.

A source with little text may need a document millions of times. A Poisson number of a large mean is
the sum of independent ones of smaller means, so such a document becomes parts, each of a mean of at
most ``PART_MEAN`` with a draw of its own. Parts are dealt over tasks before they become copies, so
neither the table of quantiles nor a task's rows grow with the mean.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHERS = "\x00others"

#: Greatest mean that one draw inverts.
PART_MEAN = 256.0


def named(identifier: Column, text: Column) -> Column:
    """What a document's draws are made from: its identifier, or without one its text."""
    return F.coalesce(
        identifier.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit(""))))
    )


def uniform(seed: str, name: Column, part: Column) -> Column:
    """52 bits of a hash as a number in [0, 1); each part of a document has its own."""
    of_part = F.when(part > 1, F.concat(F.lit("part "), part.cast("string"), F.lit("|"))).otherwise("")
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), of_part, name)), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(2**52))


def poisson_cdf(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... up to where it is 1 in double precision."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")
    start = F.struct(
        (-mean).alias("log_p"), F.exp(-mean).alias("sum"), F.array(F.exp(-mean)).alias("cdf")
    )

    def step(state: Column, k: Column) -> Column:
        log_p = state["log_p"] + F.log(mean / k)
        total = state["sum"] + F.exp(log_p)
        return F.struct(
            log_p.alias("log_p"),
            total.alias("sum"),
            F.concat(state["cdf"], F.array(total)).alias("cdf"),
        )

    return F.when(mean > 0, F.aggregate(F.sequence(F.lit(1), last), start, step)["cdf"]).otherwise(
        F.array(F.lit(1.0))
    )


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float],
    other_weight: float = 0.0,
    amount: float = 1.0,
    seed: str = "mix",
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """Copies of documents, each source in its share of characters, in a global random order.

    ``weights`` are relative; sources that it does not list, null among them, share
    ``other_weight``. ``amount`` is the expected size of the result as a multiple of the input.
    Groups without a character are left out of the targets, and their weight goes to the rest.
    Returns all columns of ``docs`` with ``copy`` and ``shuffle_key``, sorted by that key over all
    partitions. Copies of a document are numbered from 1; those of a further part start at a multiple of
    the number of quantiles, so numbers of documents with several parts are distinct but have gaps. Rows without identifier draw by their text; repeated rows draw alike.
    Null and empty texts have no characters but are drawn like the rest of their source.
    Columns named like a result are replaced; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    if any(not w >= 0 or math.isinf(w) for w in (*weights.values(), other_weight)):
        raise ValueError("weights must be finite and not negative")
    source = F.col(source_column)
    group = F.when(source.isin(list(weights)), source).otherwise(F.lit(OTHERS))
    sizes = docs.groupBy(group.alias("__group")).agg(
        F.sum(F.coalesce(F.length(text_column), F.lit(0))).alias("chars")
    )
    # At most one row per listed source and one more.
    sizes = {r["__group"]: r["chars"] for r in sizes.collect()}
    wanted = {**weights, OTHERS: other_weight}
    present = {g: wanted[g] for g, chars in sizes.items() if chars and wanted[g] > 0}
    total, shares = sum(sizes.values()), math.fsum(present.values())
    rates = {g: amount * w / shares * total / sizes[g] for g, w in present.items()}
    parts = {g: max(1, math.ceil(rate / PART_MEAN)) for g, rate in rates.items()}
    quantiles = spark.createDataFrame(
        [(g, rate / parts[g], parts[g]) for g, rate in rates.items()],
        "__group string, rate double, __parts long",
    ).select("__group", "__parts", poisson_cdf(F.col("rate")).alias("__cdf"))
    given = docs.drop("copy", "shuffle_key").withColumns(
        {"__group": group, "__name": named(F.col(id_column), F.col(text_column))}
    )
    split = [g for g, n in parts.items() if n > 1]
    # Sources of one part stay where they are; the rows of the others move to be copied by many tasks.
    whole = given.filter(~F.col("__group").isin(split)).withColumn("__part", F.lit(1).cast("long"))
    if split:
        cut = given.filter(F.col("__group").isin(split)).join(
            F.broadcast(quantiles.select("__group", "__parts")), "__group"
        )
        cut = cut.withColumn("__part", F.explode(F.sequence(F.lit(1).cast("long"), "__parts")))
        whole = whole.unionByName(cut.drop("__parts").repartition("__name", "__part"))
    drawn = whole.withColumn("__draw", uniform(seed, F.col("__name"), F.col("__part"))).join(
        F.broadcast(quantiles.drop("__parts")), "__group"
    )
    copies = F.size(F.filter("__cdf", lambda p: F.col("__draw") >= p))
    # A part has no more copies than its quantiles, so numbers of different parts never meet.
    first = (F.col("__part") - 1) * F.size("__cdf")
    return (
        drawn.withColumn("__copies", copies)
        .filter("__copies > 0")
        .withColumn("__first", first)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .withColumn("copy", F.col("__first") + F.col("copy"))
        .withColumn(
            "shuffle_key",
            F.md5(
                F.concat(
                    F.lit(f"{seed}|order|"), F.col("__name"), F.lit("|"), F.col("copy").cast("string")
                )
            ),
        )
        .drop("__group", "__name", "__part", "__first", "__draw", "__cdf", "__copies")
        .repartitionByRange("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )
