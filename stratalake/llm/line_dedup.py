"""Lines that many documents share, found with levelled sorted runs of line hashes.

Documents arrive in batches. A run holds the line hashes of one batch with the number of
documents that have each, bucketed and sorted by hash. A new batch is anti-joined with the runs,
bucket against bucket, to leave out lines that a run has already settled as frequent, and then
becomes a run of level 0. A level that holds ``fanout`` runs is compacted into one run of the
next level, so a batch meets a number of runs that grows with the logarithm of the batches.

A line is known by 128 bits of hash; nothing but hashes and counts moves until the frequent lines
are known. Counting combines before its shuffle; the one join on line hashes reads two plain
tables, whose large partitions adaptive execution splits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import ascii_lower, document_keys, same_document, stage
from stratalake.session import scratch_dir

BLANKS = " \t\n\x0b\x0c\r"
HASH = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


class LineRuns:
    """Runs of ``h1, h2, docs`` by level, as bucketed tables in the cluster's shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def add(self, counts: DataFrame) -> None:
        """Take a batch of ``h1, h2, docs``; its documents are in no other batch."""
        for name in self._names():
            settled = self.spark.table(name).filter(F.col("docs") >= self.min_docs)
            counts = counts.join(settled, HASH, "left_anti")
        self._put(counts, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(self._summed(full), level + 1)
            self._drop(full)
            level += 1

    def frequent(self) -> DataFrame:
        """Hashes of lines in ``min_docs`` documents or more, written out; the runs go."""
        found = self._summed(self._names()).filter(F.col("docs") >= self.min_docs)
        out = stage(found.select(*HASH), "frequent-lines")
        self._drop(self._names())
        self.levels = []
        return out

    def _names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _summed(self, names: list[str]) -> DataFrame:
        runs = self.spark.table(names[0])
        for name in names[1:]:
            runs = runs.unionAll(self.spark.table(name))
        return runs.groupBy(*HASH).agg(F.sum("docs").alias("docs"))

    def _put(self, counts: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"line_run_{uuid.uuid4().hex}"
        (
            counts.repartition(self.buckets, *HASH)
            .write.bucketBy(self.buckets, *HASH)
            .sortBy(*HASH)
            .option("path", scratch_dir(self.spark, f"line-run-{level}"))
            .saveAsTable(name)
        )
        self.levels[level].append(name)

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")


def hashed_lines(docs: DataFrame, id_column: str, text_column: str, min_chars: int) -> DataFrame:
    """One row per line whose key is long enough; ``first`` marks a key's first in its document."""
    text = F.col(text_column)
    keys = F.transform(
        lines_of(text),
        lambda line, i: F.struct(
            F.xxhash64(line_key(line)).alias("h1"),
            F.xxhash64(F.lit(1), line_key(line)).alias("h2"),
            i.alias("position"),
            F.length(line_key(line)).alias("chars"),
        ),
    )
    ordered = F.array_sort(F.filter(keys, lambda k: k["chars"] >= min_chars))
    return (
        docs.select(*document_keys(F.col(id_column), text), ordered.alias("k"))
        .select(
            "__id",
            "__text",
            F.explode(
                F.transform(
                    "k",
                    lambda k, i: F.struct(
                        k["h1"].alias("h1"),
                        k["h2"].alias("h2"),
                        k["position"].alias("position"),
                        (
                            (i == 0)
                            | (F.col("k")[F.greatest(i - 1, F.lit(0))]["h1"] != k["h1"])
                            | (F.col("k")[F.greatest(i - 1, F.lit(0))]["h2"] != k["h2"])
                        ).alias("first"),
                    ),
                )
            ).alias("line"),
        )
        .select("__id", "__text", "line.*")
    )


def drop_frequent_lines(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Every document with ``n_lines``, ``n_dropped`` and ``kept_text``.

    A line's key is the line without blanks at its ends, A-Z lower-cased. Keys of at least
    ``min_chars`` code points in at least ``min_docs`` rows lose all their lines; empty lines have
    no key of one code point and stay. Null text counts as one empty line and gives an empty
    ``kept_text``; repeated rows count as documents of their own and get equal results; an empty
    table gives an empty one. Columns of ``docs`` other than text and identifier pass through,
    and those named like a result are replaced.
    """
    spark = docs.sparkSession
    lines = hashed_lines(docs, id_column, text_column, min_chars)
    lines = lines.withColumn("batch", F.pmod(F.xxhash64("__id", "__text"), F.lit(batches)))
    lines = stage(lines, "lines", partition_by="batch")
    runs = LineRuns(spark, min_docs)
    for batch in range(batches):
        arrived = lines.filter((F.col("batch") == batch) & F.col("first"))
        runs.add(arrived.groupBy(*HASH).agg(F.count("*").alias("docs")))
    dropped = (
        lines.select("__id", "__text", "position", *HASH)
        .join(runs.frequent(), HASH)
        .groupBy("__id", "__text")
        .agg(F.collect_set("position").alias("__dropped"))
    )
    keyed = docs.select("*", *document_keys(F.col(id_column), F.col(text_column)))
    lines_at = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__dropped"))
    return (
        keyed.join(dropped, same_document(keyed, dropped), "left")
        .drop(dropped["__id"], dropped["__text"])
        .withColumn("__lines", lines_of(F.col(text_column)))
        .withColumns(
            {
                "n_lines": F.size("__lines").cast("long"),
                "n_dropped": F.when(F.col("__dropped").isNull(), F.lit(0))
                .otherwise(F.size("__dropped"))
                .cast("long"),
                "kept_text": F.when(
                    F.col("__dropped").isNull(), F.coalesce(text_column, F.lit(""))
                ).otherwise(
                    F.array_join(F.transform(lines_at, lambda i: F.get("__lines", i)), "\n")
                ),
            }
        )
        .drop("__id", "__text", "__dropped", "__lines")
    )
