import json

import pytest

from stratalake.operators.quality import (
    QualityGateFailed, enforce_gate, profile_columns, quality_gate, quality_results,
    quality_summary, run_quality_checks,
)
from stratalake.operators.validate import (
    SchemaInvalid, require_valid, structure_findings, validate_schema,
)
from tests.conftest import rows_of


def verdicts(df, *checks):
    return {r.check_name: r for r in quality_results(df, list(checks)).collect()}


def test_null_share_is_compared_in_percent(frame):
    df = frame("a int, b int", (None, 1), (1, 1), (1, 1), (1, None))
    checks = [
        {"name": "at", "type": "null_check", "columns": ["a", "b"], "threshold": 25},
        {"name": "over", "type": "null_check", "columns": ["b", "a"], "threshold": 24.9},
    ]
    got = verdicts(df, *checks)
    assert got["at"].passed and got["at"].failed_columns is None
    assert not got["over"].passed and got["over"].failed_columns == "b,a"
    assert json.loads(got["over"].details) == {"b": 1, "a": 1}


def test_an_empty_table_passes_everything(frame):
    df = frame("a int, s string")
    got = verdicts(
        df,
        {"type": "null_check", "columns": ["a"]},
        {"type": "duplicate_check", "columns": ["a"]},
        {"type": "range_check", "column": "a", "min": 1, "max": 2},
        {"type": "pattern_check", "column": "s", "pattern": "x"},
        {"type": "custom_sql", "condition": "a > 0"},
    )
    assert len(got) == 5 and all(r.passed and r.records_checked == 0 for r in got.values())


def test_null_keys_are_one_group_of_duplicates(frame):
    df = frame("a int, b int", (None, 1), (None, 1), (1, None), (1, None), (1, 2), (None, None))
    got = verdicts(df, {"name": "d", "type": "duplicate_check", "columns": ["a", "b"]})["d"]
    assert (got.passed, got.records_failed, got.records_checked) == (False, 2, 6)
    ok = {"name": "d", "type": "duplicate_check", "columns": ["a", "b"], "threshold": 2}
    assert verdicts(df, ok)["d"].passed


def test_bounds_pass_and_null_passes(frame):
    df = frame("a int", (1,), (5,), (None,))
    closed = {"name": "r", "type": "range_check", "column": "a", "min": 1, "max": 5}
    assert verdicts(df, closed)["r"].passed
    open_ends = {"name": "r", "type": "range_check", "column": "a", "min": 1, "max": 5,
                 "inclusive": False}
    assert verdicts(df, open_ends)["r"].records_failed == 2
    low = {"name": "r", "type": "range_check", "column": "a", "min": 2, "max": 4}
    assert json.loads(verdicts(df, low)["r"].details) == {"below": 1, "above": 1}


def test_pattern_finds_a_substring_and_sql_null_passes(frame):
    df = frame("s string", ("xaby",), ("b",), (None,))
    got = verdicts(
        df,
        {"name": "p", "type": "pattern_check", "column": "s", "pattern": "a"},
        {"name": "c", "type": "custom_sql", "condition": "s LIKE '%b%'"},
    )
    assert got["p"].records_failed == 1 and got["c"].passed


def test_names_are_made_unique_and_broken_checks_fail(frame):
    df = frame("a int", (1,))
    results = quality_results(
        df,
        [
            {"type": "null_check", "columns": ["a"]},
            {"type": "null_check", "columns": ["a"], "threshold": 5},
            {"type": "range_check", "column": "b", "min": 0},
            {"type": "range_check", "column": "a", "min": 3, "max": 2},
            {"type": "custom_sql", "condition": "no_such > 1"},
            {"type": "custom_sql", "condition": "a >"},
            {"type": "moon_phase"},
        ],
    )
    got = {r.check_name: r.passed for r in results.collect()}
    assert got == {
        "null_check:a": True, "null_check:a#2": True, "range_check:b": False,
        "range_check:a": False, "custom_sql": False, "custom_sql#2": False, "moon_phase": False,
    }
    summary = quality_summary(results).first()
    assert (summary.total_checks, summary.passed_checks, summary.passed) == (7, 2, False)


def test_no_checks_give_no_results_and_pass(frame):
    results = quality_results(frame("a int", (1,)), [])
    assert results.count() == 0 and quality_summary(results).first().passed


def test_checks_together_equal_checks_alone(frame):
    df = frame(
        "k int, v int, s string",
        (1, 5, "a"), (1, None, "b"), (2, 50, None), (None, 7, "abc"), (None, 8, "x"),
    )
    checks = [
        {"name": "n", "type": "null_check", "columns": ["k", "v"], "threshold": 30},
        {"name": "d1", "type": "duplicate_check", "columns": ["k"]},
        {"name": "d2", "type": "duplicate_check", "columns": ["k", "v"]},
        {"name": "r", "type": "range_check", "column": "v", "max": 10},
        {"name": "p", "type": "pattern_check", "column": "s", "pattern": "^[a-c]+$"},
        {"name": "c", "type": "custom_sql", "condition": "v + k < 20"},
    ]
    together = sorted(map(tuple, quality_results(df, checks).collect()))
    alone = sorted(tuple(r) for c in checks for r in quality_results(df, [c]).collect())
    assert together == alone


def test_the_runner_isolates_a_check_that_fails_while_running(frame):
    df = frame("a string", ("1",), ("x",))
    report = run_quality_checks(
        df,
        [
            {"name": "bad", "type": "custom_sql", "condition": "cast(a AS int) > 0"},
            {"name": "good", "type": "null_check", "columns": ["a"]},
        ],
    )
    assert not report["passed"] and report["summary"] == {
        "total_checks": 2, "passed_checks": 1, "total_rows": 2,
    }
    assert not report["checks"]["bad"]["passed"] and report["checks"]["good"]["passed"]


def test_gates(frame):
    results = quality_results(
        frame("a int", (None,)),
        [{"type": "null_check", "columns": ["a"]}, {"type": "duplicate_check", "columns": ["a"]}],
    )
    assert quality_gate(results, 0).first().passed is False
    assert quality_gate(results, 1).first().passed is True
    assert enforce_gate(results, max_error_threshold=1) is True
    assert enforce_gate(results, fail_on_error=False) is False
    with pytest.raises(QualityGateFailed):
        enforce_gate(results)


def test_profile_exact_and_sketched_agree_on_small_data(frame):
    df = frame("a int, s string", (1, "x"), (None, "y"), (3, "y"), (3, None))
    exact = rows_of(profile_columns(df, ["a", "s"], exact=True))
    assert exact == rows_of(profile_columns(df, ["a", "s"]))
    assert exact == [("a", 4, 1, 2, "1", "3", 7 / 3), ("s", 4, 1, 2, "x", "y", None)]


SCHEMA = {
    "columns": [
        {"name": "n", "type": "integer", "nullable": False, "constraints": {"min": 1, "max": 9}},
        {"name": "s", "type": "string", "constraints": {"max_length": 255}, "pattern": "^a"},
        {"name": "need", "type": "string", "nullable": False},
        {"name": "may", "type": "string"},
    ]
}


def test_text_is_validated_by_its_cast(frame):
    df = frame(
        "n string, s string, other string",
        ("1", "a", "o"), ("9", "b" * 255, "o"), ("0", "a" * 256, "o"), ("x", None, "o"),
        (None, "ba", "o"), ("10", "a", "o"),
    )
    got = {(r.column, r.rule): r for r in validate_schema(df, SCHEMA, untyped=True).collect()}
    counts = {k: r.violations for k, r in got.items()}
    assert counts == {
        ("n", "cast"): 1, ("n", "not_null"): 2, ("n", "min"): 1, ("n", "max"): 1,
        ("s", "cast"): 0, ("s", "max_length"): 1, ("s", "pattern"): 2,
        ("need", "missing"): 1, ("other", "unexpected"): 1,
    }
    assert got["s", "pattern"].level == got["other", "unexpected"].level == "warning"


def test_strict_gate_ignores_warnings(frame):
    schema = {"columns": [{"name": "s", "type": "string", "pattern": "^a"}]}
    warned = validate_schema(frame("s string, x int", ("b", 1)), schema)
    assert require_valid(warned) == []
    broken = validate_schema(frame("s int", (1,)), schema)
    with pytest.raises(SchemaInvalid):
        require_valid(broken)
    assert len(require_valid(broken, strict=False)) == 1


def test_a_mistyped_column_is_reported_not_raised(frame):
    schema = {"columns": [{"name": "s", "type": "int", "constraints": {"min": 3}}]}
    findings = validate_schema(frame("s string", ("x",), ("1",)), schema).collect()
    got = {r.rule: r.violations for r in findings}
    assert got == {"type": 1, "min": 1}


def test_findings_per_file_in_one_result(frame):
    df = frame("n string, f string", ("1", "a"), ("x", "a"), ("2", "b"))
    schema = {"columns": [{"name": "n", "type": "int"}]}
    got = validate_schema(df, schema, untyped=True, by="f")
    assert rows_of(got, "f", "violations") == [("a", 1), ("b", 0)]


def test_extra_columns_only_matter_when_strict(frame):
    df = frame("a int", (1,))
    assert structure_findings(df, {"columns": []}, strict=False) == []
    assert len(structure_findings(df, {"columns": []}, strict=True)) == 1
