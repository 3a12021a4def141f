"""From raw to cleansed: a listed sequence of steps over one DataFrame.

A definition is a dictionary::

    {"source": {...target-like...}, "target": {...},
     "transformations": [
        {"type": "data_quality_checks", "checks": [...]},
        {"type": "filter_not_null", "columns": [...]},
        {"type": "default_nulls", "defaults": {column: value}},
        {"type": "standardization", "rules": {column: [rule, ...]}},
        {"type": "derived_columns", "columns": [{"name": ..., "expression": ...}]},
        {"type": "deduplicate", "keys": [...], "order_by": [...]}],
     "change_data_capture": {...scd2 specification..., "type": "scd_type_2"},
     "write_mode": "overwrite", "partition_by": [...]}

Before the steps may run ``"sql"``, a statement over ``{source_table}`` with ``"args"``, or
``"transform"``, a callable from DataFrame to DataFrame with ``"config"``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.columns import (
    default_nulls, derive_columns, filter_not_null, standardize_columns,
)
from stratalake.operators.dedup import deduplicate_latest
from stratalake.operators.quality import GATES, checked_now, enforce_gate, quality_results
from stratalake.operators.scd2 import initial_load, merge_current
from stratalake.plans.transforms import df_transform, sql_transform
from stratalake.sinks.control import QUALITY_RESULTS, quality_rows
from stratalake.sinks.history import HistoryStore
from stratalake.sinks.tables import ensure_table, table_name, write_table


@dataclass
class Cleansed:
    """The resulting rows and, per checks step, the results, and the rows and checks of that step."""

    rows: DataFrame
    checks: list[DataFrame] = field(default_factory=list)
    checked: list[tuple[DataFrame, list[dict[str, Any]]]] = field(default_factory=list)


def apply_steps(df: DataFrame, steps: list[dict[str, Any]]) -> Cleansed:
    """Fold the steps over the DataFrame in listed order; nothing runs yet."""
    out = Cleansed(df)
    for step in steps:
        kind = step["type"]
        if kind == "data_quality_checks":
            out.checks.append(quality_results(out.rows, step["checks"]))
            out.checked.append((out.rows, step["checks"]))
        elif kind == "standardization":
            out.rows = standardize_columns(out.rows, step["rules"])
        elif kind == "derived_columns":
            out.rows = derive_columns(out.rows, step["columns"])
        elif kind == "default_nulls":
            out.rows = default_nulls(out.rows, step["defaults"])
        elif kind == "filter_not_null":
            out.rows = filter_not_null(out.rows, step["columns"])
        elif kind == "deduplicate":
            out.rows = deduplicate_latest(out.rows, step["keys"], step["order_by"])
        else:
            raise ValueError(f"unknown transformation: {kind}")
    return out


def run_cleansing(
    spark: SparkSession,
    definition: dict[str, Any],
    fail_on_error: bool = True,
    max_error_threshold: int = 0,
    as_of: datetime | str | None = None,
    quality_table: dict[str, Any] | None = None,
    batch_id: str = "",
    environment: str | None = None,
) -> int:
    """Read the source table, decide by its checks, write the target; returns the row count.

    The checks run on the stored table before anything is written; their results, one row
    each, are kept in the quality table where one is given, also when they stop the run. A check
    that raises while running is a failed check. An environment's gate, where one is named, takes
    the place of ``fail_on_error`` and ``max_error_threshold``. With
    change data capture the target's ``path`` is a ``HistoryStore``, which the cleansed rows
    join as a snapshot taken at ``as_of``.
    """
    rows = spark.table(table_name(definition["source"]))
    if "sql" in definition:
        rows = sql_transform(spark, definition["sql"], definition.get("args"), source_table=rows)
    if "transform" in definition:
        rows = df_transform(rows, definition["transform"], **definition.get("config", {}))
    cleansed = apply_steps(rows, definition.get("transformations", []))
    found = [checked_now(*step) for step in cleansed.checked]
    if quality_table and found:
        ensure_table(spark, {**QUALITY_RESULTS, **quality_table})
        kept = {**quality_table, "partition_columns": QUALITY_RESULTS["partition_columns"]}
        checked = table_name(definition["source"]).replace("`", "")
        for results in found:
            rows = quality_rows(results, checked, batch_id, F.current_timestamp(), environment)
            write_table(rows, kept)
    gate = {"fail_on_error": fail_on_error, "max_error_threshold": max_error_threshold}
    for results in found:
        enforce_gate(results, **(GATES[environment] if environment else gate))
    target = dict(definition["target"])
    if "change_data_capture" in definition:
        return _keep_history(spark, cleansed.rows, definition["change_data_capture"], target, as_of)
    if definition.get("partition_by"):
        target["partition_columns"] = definition["partition_by"]
    return write_table(cleansed.rows, target, definition.get("write_mode", "overwrite"))


def _keep_history(spark, snapshot, capture, target, as_of) -> int:
    if capture.get("type") != "scd_type_2":
        raise ValueError(f"unknown change data capture: {capture.get('type')}")
    if as_of is None:
        raise ValueError("a snapshot needs the time it was taken")
    store = HistoryStore(spark, target["path"], capture)
    newest = store.latest()
    if newest is None:
        return store.commit(initial_load(snapshot, store.spec, as_of), 0)
    merged = merge_current(store.current(), snapshot, store.spec, as_of)
    return store.commit(merged, newest + 1)
