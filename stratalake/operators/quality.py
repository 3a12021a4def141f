"""Data-quality checks, fused: all row-level checks share one aggregate over one evaluation.

A check is a dictionary with a ``type``, an optional ``name`` and the parameters of its type:

============== ============================================ ==================================
type           parameters                                   passes when
============== ============================================ ==================================
null_check     columns, threshold (percent of rows, 0)      no column has a larger null share
duplicate_check columns, threshold (rows, 0)                rows beyond the first of each key
                                                            number at most the threshold; null
                                                            keys form one group
range_check    column, min, max, inclusive (true)           no value lies outside; null passes
pattern_check  column, pattern                              every non-null value contains a match
custom_sql     condition                                    no row makes the condition false
============== ============================================ ==================================

A duplicate check needs its key's groups brought together, so each distinct key adds one
aggregation, combined before its shuffle: however often one key repeats, a task sends it once.
"""

from __future__ import annotations

import json
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.session import FAILURES
from stratalake.spec import SpecError, check_bounds, quoted

RESULT_COLUMNS = [
    "check_name", "check_type", "passed", "records_checked", "records_failed",
    "failed_columns", "details",
]


# Per environment, whether too many failed checks stop a run, and how many are.
GATES = {
    "dev": {"fail_on_error": False, "max_error_threshold": 10},
    "test": {"fail_on_error": True, "max_error_threshold": 5},
    "prod": {"fail_on_error": True, "max_error_threshold": 0},
}


class QualityGateFailed(ValueError):
    """More checks failed than the gate tolerates."""


def named_checks(checks: list[dict[str, Any]]) -> list[dict[str, Any]]:
    """Give each check a unique name: its own, or its type and columns, numbered on a clash."""
    taken: dict[str, int] = {}
    out = []
    for check in checks:
        columns = check.get("columns") or [check[k] for k in ("column",) if k in check]
        base = check.get("name") or ":".join([str(check.get("type")), ",".join(columns)]).strip(":")
        taken[base] = taken.get(base, 0) + 1
        name = base if taken[base] == 1 else f"{base}#{taken[base]}"
        out.append({**check, "name": name})
    return out


def quality_results(df: DataFrame, checks: list[dict[str, Any]]) -> DataFrame:
    """One row per check: name, type, verdict, rows checked and failed, details as JSON.

    Lazy, and the rows are evaluated once per distinct duplicate key, at least once: the
    row-level counts ride along with the first key's grouping, so costly rows, such as a join,
    are not computed again for them. An unknown type or a column that does not exist gives a
    failed row, not an error.
    """
    row_level, duplicates, broken = [], {}, []
    for check in named_checks(checks):
        problem = _problem(df, check)
        if problem:
            broken.append((check, problem))
        elif check["type"] == "duplicate_check":
            duplicates.setdefault(tuple(check["columns"]), []).append(check)
        else:
            row_level.append(check)
    key_sets = list(duplicates) or [()]
    parts = [_measured(df, key_sets[0], duplicates.get(key_sets[0], []), row_level, broken)]
    parts += [_measured(df, keys, duplicates[keys], [], []) for keys in key_sets[1:]]
    return reduce(DataFrame.unionAll, parts)


def _problem(df: DataFrame, check: dict[str, Any]) -> str | None:
    """Why a check cannot run, found without a job."""
    try:
        named = check["columns"] if "columns" in check else [check.get("column")]
        missing = [c for c in named if c is not None and c not in df.columns]
        if missing:
            return f"no column {missing}"
        if check["type"] == "duplicate_check":
            return None
        conditions = _conditions(check)
        if check["type"] == "custom_sql":
            df.select(*[c for _, c in conditions]).schema
    except (SpecError, KeyError, ValueError) as e:
        return f"{type(e).__name__}: {e}"
    except (AnalysisException, ParseException) as e:
        return e.getCondition() or type(e).__name__
    return None


def _conditions(check: dict[str, Any]) -> list[tuple[str, Column]]:
    """Named conditions of one check, each true on a violating row."""
    kind = check["type"]
    if kind == "null_check":
        return [(c, quoted(c).isNull()) for c in check["columns"]]
    if kind == "range_check":
        name, value = check["column"], quoted(check["column"])
        check_bounds(name, check)
        closed = check.get("inclusive", True)
        sides = []
        if check.get("min") is not None:
            low = F.lit(check["min"])
            sides.append(("below", value < low if closed else value <= low))
        if check.get("max") is not None:
            high = F.lit(check["max"])
            sides.append(("above", value > high if closed else value >= high))
        return sides or [("below", F.lit(False))]
    if kind == "pattern_check":
        return [("mismatch", ~quoted(check["column"]).rlike(check["pattern"]))]
    if kind == "custom_sql":
        return [("false", F.expr(f"NOT ({check['condition']})"))]
    raise ValueError(f"unknown check type: {kind}")


def _measured(
    df: DataFrame, keys: tuple[str, ...], duplicates: list, row_level: list, broken: list
) -> DataFrame:
    """The results of checks that share one evaluation of the rows."""
    counts, rows = {}, []
    for i, check in enumerate(row_level):
        labelled = []
        for j, (label, condition) in enumerate(_conditions(check)):
            counts[f"c{i}_{j}"] = F.count_if(condition)
            labelled.append((label, F.col(f"c{i}_{j}")))
        rows.append(_row_level_result(check, labelled))
    rows += [_duplicate_result(check) for check in duplicates]
    rows += [_broken_result(check, problem) for check, problem in broken]
    counts["total"] = F.count(F.lit(1))
    named = [c.alias(n) for n, c in counts.items()]
    if keys:
        groups = df.groupBy(*[quoted(k) for k in keys]).agg(*named)
        summed = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts]
        totals = groups.agg(F.count(F.lit(1)).alias("distinct"), *summed)
    else:
        totals = df.agg(*named)
    if rows:
        return totals.select(F.inline(F.array(*rows)))
    nothing = _result({"name": "", "type": ""}, F.lit(True), F.lit(0), F.lit(None), F.lit(None))
    return totals.select(F.inline(F.slice(F.array(nothing), 1, 0)))


def _row_level_result(check: dict[str, Any], counts: list[tuple[str, Column]]) -> Column:
    failed = reduce(lambda a, b: a + b, [n for _, n in counts])
    details = F.to_json(F.struct(*[n.alias(label) for label, n in counts]))
    if check["type"] != "null_check":
        return _result(check, failed == 0, failed, F.lit(None), details)
    limit = F.lit(float(check.get("threshold", 0)))
    over = [
        F.when(F.coalesce(n * 100.0 / F.nullif(F.col("total"), F.lit(0)), F.lit(0.0)) > limit,
               F.lit(label))
        for label, n in counts
    ]
    failing = F.array_compact(F.array(*over))
    listed = F.nullif(F.array_join(failing, ","), F.lit(""))
    return _result(check, F.size(failing) == 0, failed, listed, details)


def _broken_result(check: dict[str, Any], problem: str) -> Column:
    details = F.lit(json.dumps({"error": problem}))
    return _result(check, F.lit(False), F.lit(None), F.lit(None), details)


def _duplicate_result(check: dict[str, Any]) -> Column:
    total, distinct = F.col("total"), F.col("distinct")
    extra = total - distinct
    counts = F.struct(
        total.alias("total_rows"),
        distinct.alias("distinct_rows"),
        extra.alias("duplicate_count"),
    )
    passed = extra <= F.lit(check.get("threshold", 0))
    return _result(check, passed, extra, F.lit(None), F.to_json(counts))


def _result(
    check: dict[str, Any], passed: Column, failed: Column, columns: Column, details: Column
) -> Column:
    values = [
        F.lit(check["name"]),
        F.lit(str(check.get("type"))),
        passed.cast("boolean"),
        F.col("total").cast("bigint"),
        failed.cast("bigint"),
        columns.cast("string"),
        details.cast("string"),
    ]
    return F.struct(*[v.alias(n) for v, n in zip(values, RESULT_COLUMNS)])


def quality_summary(results: DataFrame) -> DataFrame:
    """One row: total, passed and failed checks, rows checked, and whether all passed."""
    return results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.max("records_checked").alias("total_rows"),
        F.coalesce(F.every("passed"), F.lit(True)).alias("passed"),
    )


def quality_gate(results: DataFrame, max_error_threshold: int = 0) -> DataFrame:
    """One row: failed checks against the number tolerated."""
    failed = F.col("failed_checks")
    limit = F.lit(max_error_threshold).cast("bigint")
    return quality_summary(results).select(
        "total_checks",
        failed,
        limit.alias("max_error_threshold"),
        (failed <= limit).alias("passed"),
    )


def enforce_gate(
    results: DataFrame, fail_on_error: bool = True, max_error_threshold: int = 0
) -> bool:
    """Decide on a batch: true when it may pass, an error when it may not and must stop."""
    failed = [r.check_name for r in results.filter(~F.col("passed")).collect()]
    if len(failed) <= max_error_threshold:
        return True
    if fail_on_error:
        raise QualityGateFailed(f"{len(failed)} checks failed: {failed}")
    return False


def checked_now(df: DataFrame, checks: list[dict[str, Any]]) -> DataFrame:
    """Run the checks now; their results, one row each, as ``quality_results`` gives them.

    A check whose expression fails while running, say on a bad cast in its SQL, would fail the
    aggregate it shares. Then each check runs alone, and only the faulty one counts as failed.
    """
    results = quality_results(df, checks)
    try:
        rows = results.collect()
    except FAILURES:
        rows = [r for c in named_checks(checks) for r in _run_alone(df, c)]
    # A check that raised has counted nothing.
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in results.schema.fields])
    return df.sparkSession.createDataFrame(rows, schema)


def run_quality_checks(df: DataFrame, checks: list[dict[str, Any]]) -> dict[str, Any]:
    """Run the checks now and return ``{passed, checks: {name: result}, summary}``."""
    rows = checked_now(df, checks).collect()
    found = {r.check_name: r for r in rows}
    ordered = [found[c["name"]] for c in named_checks(checks)]
    passed = sum(r.passed for r in ordered)
    totals = [r.records_checked for r in ordered if r.records_checked is not None]
    return {
        "passed": passed == len(ordered),
        "checks": {r.check_name: {**r.asDict(), "details": json.loads(r.details)} for r in ordered},
        "summary": {
            "total_checks": len(ordered),
            "passed_checks": passed,
            "total_rows": max(totals) if totals else df.count(),
        },
    }


def _run_alone(df: DataFrame, check: dict[str, Any]) -> list:
    try:
        return quality_results(df, [check]).collect()
    except FAILURES as e:
        reason = e.getCondition() if isinstance(e, PySparkException) else None
        row = _broken_result(check, reason or type(e).__name__)
        return df.agg(F.count(F.lit(1)).alias("total")).select(F.inline(F.array(row))).collect()


#: Rows whose distinct values one task holds, and values per column that any task may hold.
ROWS_PER_TASK, FEW_VALUES = 500_000, 50_000


def profile_columns(df: DataFrame, columns: list[str], exact: bool = False) -> DataFrame:
    """Per column: rows, nulls, distinct values, min, max (as text) and mean (numeric columns).

    Distinct counts are sketches by default, and the profile is one aggregate over one scan. With
    ``exact``, Spark groups each column's values apart from the rest, see ``distinct_counts``.
    """
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    for i, name in enumerate(columns):
        value = quoted(name)
        numeric = df.schema[name].dataType.typeName() in (
            "byte", "short", "integer", "long", "float", "double", "decimal",
        )
        mean = F.avg(value.cast("double")) if numeric else F.lit(None).cast("double")
        aggs += [
            F.count(value).alias(f"set{i}"),
            F.min(value).cast("string").alias(f"min{i}"),
            F.max(value).cast("string").alias(f"max{i}"),
            mean.alias(f"mean{i}"),
        ]
        if not exact:
            aggs.append(F.approx_count_distinct(value).alias(f"distinct{i}"))
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("n").alias("row_count"),
                (F.col("n") - F.col(f"set{i}")).alias("null_count"),
                F.col(f"distinct{i}").alias("distinct_count"),
                F.col(f"min{i}").alias("min_value"),
                F.col(f"max{i}").alias("max_value"),
                F.col(f"mean{i}").alias("mean_value"),
            )
        )
    found = df.agg(*aggs)
    if exact and columns:
        # One row each: a subquery, not a join.
        counts = distinct_counts(df, columns)
        found = found.withColumn("counts", counts.select(F.struct(*counts.columns)).scalar())
        found = found.select("*", "counts.*")
    return found.select(F.inline(F.array(*rows)))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the exact number of distinct values of each column, as ``distinct0, ...``.

    The values are grouped by hash with nothing beside them: least and greatest strings in the same
    aggregate would make every task sort all its rows, once per column. A pass with sketches comes
    first. Where a column has many values, rows are dealt out before they are grouped, so that a
    task holds the values of some ``ROWS_PER_TASK`` rows however large the files it reads.
    """
    values = df.select(*[quoted(c).alias(f"v{i}") for i, c in enumerate(columns)])
    sizes = values.agg(
        F.count(F.lit(1)), *[F.approx_count_distinct(c) for c in values.columns]
    ).first()
    tasks = -(-sizes[0] // ROWS_PER_TASK)
    if tasks > 1 and max(sizes[1:]) > FEW_VALUES:
        values = values.repartition(tasks, *values.columns)
    return values.agg(
        *[F.count_distinct(c).alias(f"distinct{i}") for i, c in enumerate(values.columns)]
    )
