"""Writing tables and files, and the summary of a load.

A target is a dictionary: ``table`` and optionally ``catalog``, ``schema``, ``path`` (makes the
table external), ``format`` (parquet), ``partition_columns``, ``write_options``,
``table_properties``, ``columns`` (a schema specification's list, for ``ensure_table``).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.session import discard, scratch_dir
from stratalake.spec import columns_of, declared_type, quoted


class RowsMissing(RuntimeError):
    """A batch has not as many rows as it should; its table holds none of them."""


def table_name(target: dict[str, Any]) -> str:
    parts = [target[k] for k in ("catalog", "schema", "table") if target.get(k)]
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def counted(df: DataFrame, partition_columns: list[str] | None) -> tuple[DataFrame, Observation]:
    """Lay rows out by partition and count them in the same job that writes them.

    The rebalancing lets adaptive execution cut a large partition into several files and pack
    small ones, where a plain repartitioning would send a large one to a single task. Counting
    comes after it, in the writing stage itself, whose tasks count once even if one is retried.
    """
    seen = Observation()
    if partition_columns:
        df = df.hint("rebalance", *[quoted(c) for c in partition_columns])
    return df.observe(seen, F.count(F.lit(1)).alias("records")), seen


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns cast to and ordered as the table's, absent ones as null; extra ones go last."""
    known = [
        quoted(f.name).cast(f.dataType).alias(f.name)
        if f.name in df.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    names = {f.name for f in schema.fields}
    return df.select(*known, *[quoted(c) for c in df.columns if c not in names])


def write_table(df: DataFrame, target: dict[str, Any], mode: str = "append") -> int:
    """Write to a table and return the number of rows written, counted on the way.

    An append adds columns the table does not have yet to the table first, and fills those the
    data lacks with null.
    """
    spark, name = df.sparkSession, table_name(target)
    if mode == "append" and spark.catalog.tableExists(name):
        table = spark.table(name).schema
        added = [f for f in df.schema.fields if f.name not in table.fieldNames()]
        if added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_nullable(added).toDDL()})")
        df = align_to(df, T.StructType([*table.fields, *added]))
    parts = target.get("partition_columns")
    rows, seen = counted(df, parts)
    writer = rows.write.mode(mode).format(target.get("format", "parquet"))
    if target.get("path"):
        writer = writer.option("path", target["path"])
    if parts:
        writer = writer.partitionBy(*parts)
    writer.options(**target.get("write_options", {})).saveAsTable(name)
    return seen.get["records"]


@contextmanager
def checked(df: DataFrame, expected: int) -> Iterator[DataFrame]:
    """The rows, once they are known to be as many as ``expected``: else an error and none of them.

    They are written below ``spark.checkpoint.dir`` and counted on the way. What a table then
    receives are these very rows, whatever happens to their source meanwhile.
    """
    spark, seen = df.sparkSession, Observation()
    path = scratch_dir(spark, "batch")
    try:
        df.observe(seen, F.count(F.lit(1)).alias("records")).write.parquet(path)
        found = seen.get["records"]
        if found != expected:
            raise RowsMissing(f"{found} rows to write, {expected} expected")
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        discard(spark, path)


def replace_table_as(df: DataFrame, target: dict[str, Any]) -> int:
    """Make the table hold exactly the query's result; it must not read that table."""
    return write_table(df, target, "overwrite")


def ensure_table(spark: SparkSession, target: dict[str, Any], like: DataFrame | None = None) -> str:
    """Create the table and its schema where they do not exist; returns the table's name.

    Columns come from ``like``, or from the target's own ``columns``, whose ``nullable`` and
    ``comment`` are kept in the catalog. Files do not enforce NOT NULL: validation does.
    """
    name = table_name(target)
    if target.get("schema"):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table_name({**target, 'table': None})}")
    if spark.catalog.tableExists(name):
        return name
    if like is not None:
        columns = _nullable(like.schema.fields)
    elif target.get("columns"):
        columns = T.StructType(
            [
                T.StructField(
                    c["name"],
                    declared_type(c),
                    c.get("nullable", True),
                    {"comment": c["comment"]} if c.get("comment") else None,
                )
                for c in columns_of(target)
            ]
        )
    else:
        raise ValueError(f"no columns to create {name} from")
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({columns.toDDL()}) "
    ddl += f"USING {target.get('format', 'parquet')}"
    if target.get("partition_columns"):
        ddl += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in target['partition_columns'])})"
    ddl += _clause(" LOCATION", target.get("path"))
    if target.get("table_properties"):
        pairs = [f"{_text(k)} = {_text(v)}" for k, v in target["table_properties"].items()]
        ddl += f" TBLPROPERTIES ({', '.join(pairs)})"
    spark.sql(ddl)
    return name


def _nullable(fields: list[T.StructField]) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def _text(value: Any) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _clause(keyword: str, value: Any) -> str:
    return f"{keyword} {_text(value)}" if value else ""


def write_files(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    mode: str = "overwrite",
    options: dict[str, Any] | None = None,
    partition_columns: list[str] | None = None,
) -> int:
    """Write files and return the number of rows written. ``delta`` needs its own package."""
    if file_format not in ("delta", "parquet", "csv", "json"):
        raise ValueError(f"unsupported output format: {file_format}")
    rows, seen = counted(df, partition_columns)
    writer = rows.write.format(file_format).mode(mode).options(**(options or {}))
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    writer.save(path)
    return seen.get["records"]


def load_summary(
    spark: SparkSession,
    source_type: str,
    source_name: str,
    target: dict[str, Any],
    started: datetime,
    ended: datetime,
    records: int,
    status: str = "success",
    environment: str | None = None,
    message: str | None = None,
) -> DataFrame:
    """One row about one load; the count comes from the write, not from another pass."""
    fields = (
        "status string, source_type string, source_name string, target_table string, "
        "start_time timestamp, end_time timestamp, duration_seconds double, "
        "records_processed bigint, environment string, message string"
    )
    took = (ended - started).total_seconds()
    name = ".".join(target[k] for k in ("catalog", "schema", "table") if target.get(k))
    row = (status, source_type, source_name, name, started, ended, took, records, environment,
           message)
    return spark.createDataFrame([row], fields)
