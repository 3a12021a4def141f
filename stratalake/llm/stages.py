"""The operators as filters over documents: what each stage of a corpus pipeline does."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import decontamination, line_dedup, minhash, mixing, toxicity
from stratalake.llm.common import table
from stratalake.llm.queries import WEIGHTS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay."""
    machine = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    kept = toxicity.score(docs, machine).filter(F.col("score") < 0.5)
    return kept.select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents lose the lines that at least ten documents share; ``n_chars`` follows.

    Every document stays, also one of which no text is left.
    """
    done = line_dedup.drop_frequent_lines(docs)
    text = F.when(F.col("n_dropped") > 0, F.col("kept_text")).otherwise(F.col("text"))
    chars = F.when(F.col("n_dropped") > 0, F.length("kept_text")).otherwise(F.col("n_chars"))
    kinds = dict(docs.dtypes)
    return done.select(
        *[
            text.alias(c) if c == "text" else chars.cast(kinds[c]).alias(c) if c == "n_chars" else F.col(c)
            for c in docs.columns
        ]
    )


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, of the least identifier.

    Documents without text are like no other, and all stay.
    """
    blank = ~F.coalesce("text", F.lit("")).rlike(r"\S")
    kept = minhash.near_duplicates(docs.filter(~blank)).filter("keep").select(*docs.columns)
    # Rows that agree in identifier and text are one document.
    return kept.dropDuplicates(["doc_id", "text"]).unionAll(docs.filter(blank))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark's window stay."""
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.filter("not contaminated").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies by source, in a global random order."""
    return mixing.mix_sources(docs, WEIGHTS, other_weight=1.0)
