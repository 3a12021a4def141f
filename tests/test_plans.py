"""What the planner makes of the operators: scans, shuffles, pushed filters, jobs."""

import re

import pytest

import __spark_entry__ as entry
from queries.inputs import DAILY_SALES, SALES_STEPS, daily_sales_text
from stratalake.operators import scd2
from stratalake.operators.enforce import enforce_schema
from stratalake.operators.quality import quality_results
from stratalake.operators.validate import validate_schema
from stratalake.sources.incremental import incremental_scan
from tests.test_scd2 import SPEC, FIELDS, D1

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return len(re.findall(r"FileScan", plan(df)))


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def jobs_of(spark, label, action):
    context = spark.sparkContext
    context.setJobGroup(label, label)
    try:
        action()
        return len(context.statusTracker().getJobIdsForGroup(label))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_validation_is_one_scan_without_a_keyed_shuffle(spark):
    schema = {
        "columns": [
            {"name": n, "type": "double", "nullable": False, "constraints": {"min": 0, "max": 9}}
            for n in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        ]
    }
    df = validate_schema(table(spark, "lineitem"), schema)
    assert scans(df) == 1 and shuffles(df) == 0
    # Adaptive execution runs an aggregate as one job per stage: the scan, the final sum.
    assert jobs_of(spark, "validation", df.collect) <= 2


def test_checks_evaluate_their_rows_once(spark):
    rows = enforce_schema(daily_sales_text(spark, SF_DIR), DAILY_SALES)
    assert scans(quality_results(rows, SALES_STEPS[0]["checks"])) == 2  # lines and orders


def test_checks_read_only_their_columns(spark):
    df = quality_results(
        table(spark, "lineitem"),
        [{"type": "null_check", "columns": ["l_tax"]},
         {"type": "duplicate_check", "columns": ["l_orderkey"]}],
    )
    assert scans(df) == 1
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan(df)).group(1)
    assert read == "l_orderkey:bigint,l_tax:double"


def test_cursor_filter_reaches_the_scan(spark):
    df = incremental_scan(table(spark, "orders"), "o_orderdate", "1998-06-15 00:00:00")
    assert "GreaterThan(o_orderdate" in plan(df)


def test_current_rows_are_a_pruned_read(spark, frame, tmp_path):
    dim = scd2.initial_load(frame(FIELDS, (1, "a", "b", 1)), SPEC, D1)
    dim.write.partitionBy("is_current").parquet(str(tmp_path / "dim"))
    stored = spark.read.parquet(str(tmp_path / "dim"))
    stored = stored.withColumn("is_current", stored.is_current.cast("boolean"))
    now = plan(scd2.current(stored, SPEC))
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", now).group(1)
    assert "is_current" in filters


def test_merge_joins_once_and_sorts_no_payload_for_its_check(spark, frame):
    current = frame(
        FIELDS
        + ", valid_from timestamp, valid_to timestamp, is_current boolean, version int, hash string"
    )
    text = plan(scd2.merge_current(current, frame(FIELDS), SPEC, D1))
    assert text.count("SortMergeJoin") == 1 and "SortAggregate" not in text


def test_history_moves_the_feed_once(spark):
    feed = table(spark, "events")
    spec = {"business_keys": ["user_id"], "tracked_columns": ["event_type"]}
    text = plan(scd2.build_history(feed, spec, "ts", ["event_id"]))
    main, _, _ = text.partition("BroadcastExchange")
    assert main.count("Exchange hashpartitioning(user_id") == 1


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_query_multiplies_rows_by_rows(spark, name):
    stored = ("stream_scd2", "bronze_ingest", "stream_ingest_files")
    if name in stored or name.startswith("cleansing_"):
        pytest.skip("reads back what it stored")
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
