from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.hashing import record_hash
from stratalake.operators.columns import (
    add_audit_columns, default_nulls, derive_columns, filter_not_null, standardize_columns,
    union_by_name,
)
from stratalake.operators.dedup import deduplicate_latest
from stratalake.operators.enforce import cast_columns, enforce_schema
from stratalake.plans.cleansing import apply_steps
from stratalake.spec import SpecError, columns_of, is_compatible
from tests.conftest import rows_of


@pytest.mark.parametrize(
    "text, kind, value",
    [
        ("x", "integer", None),
        ("1.7", "integer", None),
        (" 5 ", "integer", 5),
        ("2.345", "decimal(10,2)", Decimal("2.35")),
        ("12345678901", "decimal(10,2)", None),
        ("12345678901", "long", 12345678901),
        ("2024-01-31", "date", date(2024, 1, 31)),
        ("2024-13-01", "date", None),
        ("true", "boolean", True),
        ("yes?", "boolean", None),
        ("2024-01-01 10:00:00", "timestamp_ntz", datetime(2024, 1, 1, 10)),
    ],
)
def test_a_cast_gives_the_value_or_null(frame, text, kind, value):
    schema = {"columns": [{"name": "v", "type": kind}]}
    assert cast_columns(frame("v string", (text,)), schema).first().v == value


def test_a_format_rules_over_the_plain_cast(frame):
    schema = {"columns": [{"name": "d", "type": "date", "format": "dd/MM/yyyy"}]}
    df = frame("d string", ("31/01/2024",), ("2024-01-31",), (None,))
    assert rows_of(cast_columns(df, schema)) == [(None,), (None,), (date(2024, 1, 31),)]


def test_defaults_fill_only_non_nullable_columns(frame):
    schema = {
        "columns": [
            {"name": "a", "type": "boolean", "nullable": False, "default": True},
            {"name": "b", "type": "boolean", "nullable": False},
            {"name": "c", "type": "boolean", "default": True},
            {"name": "z", "type": "int", "nullable": False, "default": 0},
        ]
    }
    row = enforce_schema(frame("a string, b string, c string, z string", (None,) * 4), schema).first()
    assert (row.a, row.b, row.c, row.z) == (True, None, None, 0)


def test_enforcing_keeps_places_adds_missing_last_and_is_idempotent(frame):
    schema = {
        "columns": [
            {"name": "id", "type": "long"},
            {"name": "gone", "type": "date"},
            {"name": "a.b", "type": "int"},
        ]
    }
    df = frame("extra string, `a.b` string, id string", ("e", "3", "7"))
    once = enforce_schema(df, schema)
    assert once.dtypes == [("extra", "string"), ("a.b", "int"), ("id", "bigint"), ("gone", "date")]
    assert tuple(once.first()) == ("e", 3, 7, None)
    assert enforce_schema(once, schema).collect() == once.collect()
    assert enforce_schema(df, schema, drop_extra=True).columns == ["id", "a.b", "gone"]


def test_value_mapping_leaves_unlisted_spellings_and_null(frame):
    rules = {
        "m": [
            {"from": ["CC", "CREDIT CARD", "Credit Card"], "to": "Credit Card"},
            {"from": ["CASH", "Cash", "cash"], "to": "Cash"},
            {"from": ["Cash"], "to": "never"},
        ]
    }
    df = frame("m string", ("CC",), ("CREDIT CARD",), ("cash",), ("Cash",), ("cAsH",), (None,))
    got = rows_of(standardize_columns(df, rules))
    assert got == sorted(
        [("Credit Card",), ("Credit Card",), ("Cash",), ("Cash",), ("cAsH",), (None,)],
        key=lambda t: (t[0] is not None, str(t[0])),
    )


def test_string_rules_run_in_listed_order(frame):
    rules = {
        "a": [
            {"trim": True},
            {"regex_replace": {"pattern": "[^a-zA-Z]", "replacement": ""}},
            {"from": ["nyc"], "to": "New York"},
            {"upper_case": True},
            {"lower_case": False},
        ]
    }
    df = frame("a string", (" n-y-c ",), ("NYC",), (None,))
    assert rows_of(standardize_columns(df, rules)) == [(None,), ("NEW YORK",), ("NYC",)]
    with pytest.raises(ValueError):
        standardize_columns(df, {"a": [{"shout": True}]})


def test_derived_columns_may_build_on_each_other_and_replace(frame):
    df = frame("a int", (2,))
    added = [{"name": "b", "expression": "a * 2"}, {"name": "c", "expression": "b + 1"}]
    assert tuple(derive_columns(df, added).first()) == (2, 4, 5)
    replaced = [{"name": "a", "expression": "a + 1"}, {"name": "b", "expression": "a * 2"}]
    assert tuple(derive_columns(df, replaced).first()) == (3, 6)


def test_audit_columns_default_and_take_a_column(frame):
    df = add_audit_columns(frame("f string", ("x.csv",)), source_file=F.col("f"), batch_id="b")
    row = df.first()
    assert (row.source_system, row.source_file, row.batch_id) == ("unknown", "x.csv", "b")
    assert isinstance(df.schema["ingestion_timestamp"].dataType, T.TimestampType)


def test_null_handling_and_filter(frame):
    df = frame("a string, n int", ("x", None), (None, 1))
    assert rows_of(default_nulls(df, {"a": "?", "n": 0})) == [("?", 1), ("x", 0)]
    assert rows_of(filter_not_null(df, ["a"])) == [("x", None)]


def test_union_fills_and_aligns_by_name(frame):
    a, b = frame("x int, y string", (1, "a")), frame("y string, z int", ("b", 2))
    assert rows_of(union_by_name([a, b])) == [(None, "b", 2), (1, "a", None)]


def test_dedup_keeps_the_latest_and_groups_null_keys(frame):
    df = frame(
        "k int, t int, v string",
        (1, 1, "old"), (1, 2, "new"), (1, 2, "alt"), (None, 5, "n"), (None, None, "m"),
        (2, 1, "same"), (2, 1, "same"), (3, None, None),
    )
    got = rows_of(deduplicate_latest(df, ["k"], ["t"]))
    assert got == [(None, 5, "n"), (1, 2, "new"), (2, 1, "same"), (3, None, None)]


def test_hash_tells_null_empty_swapped_and_split_values_apart(frame):
    df = frame(
        "a string, b string",
        ("a", None), (None, "a"), ("", "a"), ("a", ""), (None, None), ("", ""), ("N", None),
        ("1:a", "b"), ("1:a1:b", None), ("ab", "c"), ("a", "bc"),
    )
    hashes = df.select(record_hash(df, ["a", "b"]).alias("h"))
    assert hashes.distinct().count() == df.count()


def test_hash_of_zero_ignores_its_sign(frame):
    df = frame("d double", (0.0,), (-0.0,))
    assert df.select(record_hash(df, ["d"])).distinct().count() == 1


def test_specs_reject_repeated_names_and_empty_ranges():
    with pytest.raises(SpecError):
        columns_of({"columns": [{"name": "a"}, {"name": "a"}]})
    with pytest.raises(SpecError):
        columns_of({"columns": [{"name": "a", "constraints": {"min": 2, "max": 1}}]})


@pytest.mark.parametrize(
    "actual, expected, fits",
    [
        (T.IntegerType(), "integer", True),
        (T.LongType(), "long", True),
        (T.LongType(), "int", False),
        (T.ShortType(), "int", True),
        (T.FloatType(), "double", True),
        (T.DoubleType(), "float", False),
        (T.DecimalType(38, 5), "decimal(10,2)", True),
        (T.DoubleType(), "decimal(10,2)", False),
        (T.StringType(), "date", False),
        (T.TimestampNTZType(), "timestamp", True),
        (T.BinaryType(), "binary", True),
    ],
)
def test_type_compatibility(spark, actual, expected, fits):
    assert is_compatible(actual, T.DataType.fromDDL(expected)) is fits


def test_steps_run_in_listed_order(frame):
    df = frame("k int, t int, s string", (1, 1, "a"), (1, 2, None), (None, 1, "c"))
    steps = [
        {"type": "data_quality_checks", "checks": [{"type": "null_check", "columns": ["s"]}]},
        {"type": "filter_not_null", "columns": ["k"]},
        {"type": "default_nulls", "defaults": {"s": "cc"}},
        {"type": "standardization", "rules": {"s": [{"from": ["cc"], "to": "Credit Card"}]}},
        {"type": "deduplicate", "keys": ["k"], "order_by": ["t"]},
        {"type": "derived_columns", "columns": [{"name": "n", "expression": "length(s)"}]},
        {"type": "data_quality_checks", "checks": [{"type": "null_check", "columns": ["s"]}]},
    ]
    out = apply_steps(df, steps)
    assert rows_of(out.rows) == [(1, 2, "Credit Card", 11)]
    assert [r.first().passed for r in out.checks] == [False, True]
    with pytest.raises(ValueError):
        apply_steps(df, [{"type": "unheard of"}])
