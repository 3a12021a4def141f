"""A corpus from raw documents to a training mix: stages, each written and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratalake.llm import stages
from stratalake.session import scratch_dir

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stages.drop_toxic),
    ("line_dedup", stages.drop_shared_lines),
    ("near_dedup", stages.keep_one_of_each_group),
    ("decontamination", stages.drop_contaminated),
    ("mixing", stages.mix),
]

#: The model of the first stage and the signatures of the third are not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        path = scratch_dir(spark, f"pipeline-{name}")
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
