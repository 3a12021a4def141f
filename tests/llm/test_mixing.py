"""Poisson replication where a source needs each of its documents very often."""

import statistics
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from stratalake.llm import mixing, queries

FIELDS = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"{i:04d} " + "long text " * 50, "src1") for i in range(100)]
    rows += [(1000 + i, f"short {i}", "src2") for i in range(10)]
    rows += [(2000, None, "src3"), (None, "tiny", "src2"), (2001, "", None), (2002, "", "src1")]
    return spark.createDataFrame(rows, FIELDS)


def test_a_source_of_little_text_is_drawn_in_parts(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op6_mix_sources(spark, str(tmp_path))
    rows = [tuple(r) for r in found.collect()]
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        expected = db.execute(queries.OP6_SQL).fetchall()
    assert Counter(rows) == Counter(expected)
    by_doc = Counter(r[0] for r in rows if r[1] == "src2")
    assert max(by_doc.values()) > 100 and len(by_doc) == 11
    assert len({(r[0], r[3]) for r in rows}) == len(rows)


def test_means_above_one_part_keep_mean_and_variance(spark):
    rows = [(i, "x", "src2") for i in range(300)] + [(900, "y" * 300, "src1")]
    docs = spark.createDataFrame(rows, FIELDS)
    mixed = mixing.mix_sources(docs, {"src1": 1.0, "src2": 9.0}, amount=600.0)
    counts = [r["count"] for r in mixed.filter("source = 'src2'").groupBy("doc_id").count().collect()]
    # Each of the 300 is wanted 1,080 times: five parts.
    assert len(counts) == 300
    assert abs(statistics.mean(counts) - 1080) < 4 * (1080 / 300) ** 0.5
    assert 0.7 < statistics.variance(counts) / 1080 < 1.4


def test_a_mean_of_a_million_ends(spark):
    docs = spark.createDataFrame([(1, "x", "src2"), (2, "y" * 1_000_000, "src1")], FIELDS)
    mixed = mixing.mix_sources(docs, {"src1": 1.0, "src2": 1.0})
    n, distinct = mixed.filter("doc_id = 1").agg(F.count("*"), F.count_distinct("copy")).first()
    assert n == distinct and abs(n - 500_000) < 5000


def test_a_group_without_characters_leaves_its_weight_to_the_rest(spark):
    docs = spark.createDataFrame([(1, "", "src2"), (2, None, "src2"), (3, "abc", "src1")], FIELDS)
    mixed = mixing.mix_sources(docs, {"src1": 1.0, "src2": 1.0}, amount=50.0).collect()
    assert {r.doc_id for r in mixed} == {3} and 20 < len(mixed) < 90
