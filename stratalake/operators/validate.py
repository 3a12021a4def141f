"""Schema validation: any number of columns and rules, one aggregate over one scan."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.casting import cast_to_spec
from stratalake.spec import columns_of, declared_type, is_compatible, quoted

ERROR, WARNING, INFO = "error", "warning", "info"


class SchemaInvalid(ValueError):
    """Strict validation found errors."""

    def __init__(self, failures: list):
        self.failures = failures
        super().__init__("; ".join(f"{f.column}: {f.rule} ({f.violations})" for f in failures))


def structure_findings(
    df: DataFrame,
    schema: dict[str, Any],
    strict: bool = True,
    untyped: bool = False,
    ignore: tuple[str, ...] = (),
) -> list[tuple[str, str, str, int]]:
    """``(column, rule, level, violations)`` known from the schema alone, without a job.

    ``missing``: a non-nullable column is absent. ``unexpected``: a column is not declared,
    looked for when strict. ``type``: the type does not satisfy the declaration, looked for
    in typed sources. ``ignore`` names columns that belong to the reader.
    """
    columns = columns_of(schema)
    names = {c["name"] for c in columns}
    found = []
    for c in columns:
        if c["name"] in df.columns:
            if not untyped:
                fits = is_compatible(df.schema[c["name"]].dataType, declared_type(c))
                found.append((c["name"], "type", ERROR, int(not fits)))
        elif not c.get("nullable", True):
            found.append((c["name"], "missing", ERROR, 1))
    if strict:
        extra = [n for n in df.columns if n not in names and n not in ignore]
        found += [(n, "unexpected", WARNING, 1) for n in extra]
    return found


def violation_conditions(
    df: DataFrame, schema: dict[str, Any], untyped: bool = False
) -> list[tuple[str, str, str, Column]]:
    """``(column, rule, level, condition)``, the condition true on a violating row.

    Null never violates a range, length or pattern rule. Comparisons run on the column cast
    to its declared type, so a mistyped column cannot fail the whole aggregate.
    """
    out = []
    for c in columns_of(schema):
        name = c["name"]
        if name not in df.columns:
            continue
        actual, target = df.schema[name].dataType, declared_type(c)
        value, limits = cast_to_spec(c, actual), c.get("constraints", {})
        if untyped:
            bad = quoted(name).isNotNull() & value.isNull()
            out.append((name, "cast", ERROR, bad))
        if not c.get("nullable", True):
            out.append((name, "not_null", ERROR, value.isNull()))
        if "min" in limits:
            out.append((name, "min", ERROR, value < F.lit(limits["min"])))
        if "max" in limits:
            out.append((name, "max", ERROR, value > F.lit(limits["max"])))
        if "max_length" in limits:
            too_long = F.length(quoted(name).cast("string")) > limits["max_length"]
            out.append((name, "max_length", ERROR, too_long))
        if c.get("pattern") and isinstance(target, T.StringType):
            if isinstance(actual, T.StringType):
                out.append((name, "pattern", WARNING, ~quoted(name).rlike(c["pattern"])))
    return out


def validate_schema(
    df: DataFrame,
    schema: dict[str, Any],
    strict: bool = True,
    untyped: bool = False,
    by: str | None = None,
    ignore: tuple[str, ...] = (),
    also: list[tuple[str, str, str, Column]] | None = None,
) -> DataFrame:
    """``(column, rule, level, violations, passed)``, one row per rule.

    ``untyped`` says the columns were read as strings: the type rule gives way to a cast rule
    (a value is present but does not fit its declared type). ``by`` names a column, such as
    the source file, to report each rule once per value of it: still one aggregate, combined
    before the shuffle, so one large file costs no more than many small ones. ``also`` adds
    the caller's own ``(column, rule, level, condition)`` to the aggregate.
    """
    ignore = ignore + ((by,) if by else ())
    known = structure_findings(df, schema, strict, untyped, ignore)
    measured = violation_conditions(df, schema, untyped) + (also or [])
    counts = [F.count_if(cond).alias(f"v{i}") for i, (*_, cond) in enumerate(measured)]
    if not counts:
        counts = [F.count(F.lit(1)).alias("v")]
    grouped = df.groupBy(quoted(by)) if by else df.groupBy()
    rows = [_finding(n, r, lv, F.lit(v).cast("bigint")) for n, r, lv, v in known]
    rows += [_finding(n, r, lv, F.col(f"v{i}")) for i, (n, r, lv, _) in enumerate(measured)]
    if not rows:
        rows = [_finding("", "none", WARNING, F.lit(0).cast("bigint"))]
    kept = [quoted(by)] if by else []
    return grouped.agg(*counts).select(*kept, F.inline(F.array(*rows)))


def _finding(name: str, rule: str, level: str, violations: Column) -> Column:
    return F.struct(
        F.lit(name).alias("column"),
        F.lit(rule).alias("rule"),
        F.lit(level).alias("level"),
        violations.alias("violations"),
        (violations == 0).alias("passed"),
    )


def errors_in(result: DataFrame) -> DataFrame:
    """The findings that make a batch invalid; warnings never do."""
    return result.filter((F.col("level") == ERROR) & ~F.col("passed"))


def require_valid(result: DataFrame, strict: bool = True) -> list:
    """Run the validation; raise on errors when strict, else hand them back.

    What reaches the driver is one row per failed rule, a number set by the specification.
    """
    failures = errors_in(result).collect()
    if failures and strict:
        raise SchemaInvalid(failures)
    return failures
