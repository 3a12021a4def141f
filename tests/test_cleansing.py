from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.operators.quality import QualityGateFailed
from stratalake.plans.cleansing import run_cleansing
from stratalake.plans.transforms import df_transform, sql_transform
from stratalake.sinks.history import HistoryStore
from stratalake.sinks.tables import load_summary, replace_table_as, table_name, write_table
from tests.conftest import rows_of


@pytest.fixture
def places(tmp_path, request):
    label = f"c{abs(hash((request.node.name, str(tmp_path)))):x}"
    return [{"table": f"{label}_{n}", "path": str(tmp_path / n)} for n in ("source", "target")]


CHECKS = {
    "type": "data_quality_checks",
    "checks": [{"type": "duplicate_check", "columns": ["id"]},
               {"type": "null_check", "columns": ["id"]}],
}


def test_a_definition_runs_from_table_to_table(spark, frame, places):
    source, target = places
    rows = frame("id int, d date, p string", (1, datetime(2024, 5, 6), "CC"), (2, None, "x"))
    write_table(rows, source)
    definition = {
        "source": source,
        "target": target,
        "transformations": [
            CHECKS,
            {"type": "standardization", "rules": {"p": [{"from": ["CC"], "to": "Credit Card"}]}},
            {"type": "derived_columns", "columns": [{"name": "y", "expression": "YEAR(d)"}]},
        ],
        "write_mode": "overwrite",
        "partition_by": ["y"],
    }
    for _ in range(2):
        assert run_cleansing(spark, definition) == 2
    stored = spark.table(table_name(target))
    assert rows_of(stored, "id", "p", "y") == [(1, "Credit Card", 2024), (2, "x", None)]
    layout = spark.sql(f"SHOW PARTITIONS {table_name(target)}").collect()
    assert sorted(r.partition for r in layout) == ["y=2024", "y=__HIVE_DEFAULT_PARTITION__"]


def test_failed_checks_stop_before_anything_is_written(spark, frame, places):
    source, target = places
    write_table(frame("id int", (1,), (1,)), source)
    definition = {"source": source, "target": target, "transformations": [CHECKS]}
    kept = {"table": target["table"] + "_quality", "path": target["path"] + "_quality"}
    with pytest.raises(QualityGateFailed):
        run_cleansing(spark, definition, quality_table=kept, batch_id="b")
    recorded = spark.table(table_name(kept))
    assert rows_of(recorded, "check_name", "status", "records_failed", "batch_id") == [
        ("duplicate_check:id", "failed", 1, "b"), ("null_check:id", "passed", 0, "b"),
    ]
    assert not spark.catalog.tableExists(table_name(target))
    assert run_cleansing(spark, definition, fail_on_error=False) == 2
    assert run_cleansing(spark, definition, max_error_threshold=1) == 2


def test_a_check_that_raises_is_a_failed_check(spark, frame, places):
    source, target = places
    write_table(frame("id int, p string", (1, "x"), (2, "3")), source)
    checks = [{"type": "custom_sql", "condition": "cast(p as int) > 0"},
              {"type": "null_check", "columns": ["id"]}]
    definition = {
        "source": source, "target": target,
        "transformations": [{"type": "data_quality_checks", "checks": checks}],
    }
    with pytest.raises(QualityGateFailed, match="1 checks failed"):
        run_cleansing(spark, definition, environment="prod")
    assert run_cleansing(spark, definition, environment="test") == 2
    assert run_cleansing(spark, definition, fail_on_error=False) == 2


def test_sql_and_callable_transforms_come_first(spark, frame, places):
    source, target = places
    write_table(frame("id int", (1,), (2,)), source)
    definition = {
        "source": source, "target": target,
        "sql": "SELECT id, id * :n AS n FROM {source_table} WHERE id > 1", "args": {"n": 10},
        "transform": lambda df, plus: df.withColumn("n", F.col("n") + plus),
        "config": {"plus": 1},
    }
    run_cleansing(spark, definition)
    assert rows_of(spark.table(table_name(target))) == [(2, 21)]


def test_change_data_capture_keeps_history(spark, frame, places):
    source, target = places
    definition = {
        "source": source, "target": target,
        "transformations": [
            CHECKS, {"type": "standardization", "rules": {"a": [{"trim": True}, {"upper_case": True}]}},
        ],
        "change_data_capture": {
            "type": "scd_type_2", "business_keys": ["id"], "tracked_columns": ["a"],
            "scd_columns": {"valid_from": "f", "valid_to": "t", "is_current": "now",
                            "version": "v", "hash": "h"},
        },
    }
    with pytest.raises(ValueError):
        replace_table_as(frame("id int, a string", (1, "x")), source)
        run_cleansing(spark, definition)
    for n, value in enumerate(["x", " X ", "y"], 1):
        replace_table_as(frame("id int, a string", (1, value), (2, "z")), source)
        run_cleansing(spark, definition, as_of=f"2024-0{n}-01")
    store = HistoryStore(spark, target["path"], definition["change_data_capture"])
    assert rows_of(store.read(), "id", "a", "v", "now") == [
        (1, "X", 1, False), (1, "Y", 2, True), (2, "Z", 1, True),
    ]


def test_sql_values_are_bound_not_pasted(spark, frame):
    df = frame("a string", ("x' OR '1'='1",), ("y",))
    got = sql_transform(spark, "SELECT a FROM {s} WHERE a = :v", {"v": "x' OR '1'='1"}, s=df)
    assert rows_of(got) == [("x' OR '1'='1",)]
    assert df_transform(df, lambda d, n: d.limit(n), n=1).count() == 1


def test_summary_row(spark):
    began = datetime(2024, 1, 1, 10)
    row = load_summary(spark, "csv", "s", {"schema": "raw", "table": "t"}, began,
                       datetime(2024, 1, 1, 10, 0, 30), 5, environment="dev").first()
    assert (row.target_table, row.duration_seconds, row.records_processed) == ("raw.t", 30.0, 5)
