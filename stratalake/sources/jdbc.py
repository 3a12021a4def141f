"""Relational sources and sinks through Spark's JDBC connector.

``connection`` is a dictionary of connector options: ``url``, ``driver``, ``user``,
``password`` and whatever else the driver takes. Filters, column choice and, on a dialect that
supports it, aggregates reach the database by themselves.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from stratalake.session import FAILURES


def qualified(table: str, schema: str | None = None) -> str:
    return f"{schema}.{table}" if schema else table


def partition_options(partition: dict[str, Any]) -> dict[str, Any]:
    """``{column, lower, upper, partitions}`` as connector options.

    The number of partitions alone leaves a read in one task, so all four are required. The
    bounds only set the strides: rows outside them are read by the first and last task.
    """
    missing = [k for k in ("column", "lower", "upper", "partitions") if k not in partition]
    if missing:
        raise ValueError(f"a partitioned read needs {missing} as well")
    return {
        "partitionColumn": partition["column"],
        "lowerBound": str(partition["lower"]),
        "upperBound": str(partition["upper"]),
        "numPartitions": str(partition["partitions"]),
    }


def read_options(
    connection: dict[str, Any],
    table: str | None = None,
    schema: str | None = None,
    query: str | None = None,
    partition: dict[str, Any] | None = None,
    options: dict[str, Any] | None = None,
) -> dict[str, Any]:
    """The connector options of one read, of a table or of a query.

    The connector refuses to partition its ``query`` option, so a partitioned query is read as
    a derived table; its alias has no ``AS``, which not every database accepts there.
    """
    if (table is None) == (query is None):
        raise ValueError("name either a table or a query")
    given = {**connection, **(options or {})}
    if "numPartitions" in given and partition is None and "partitionColumn" not in given:
        raise ValueError("numPartitions needs a partition column and bounds to take effect")
    if query is None:
        given["dbtable"] = qualified(table, schema)
    elif partition:
        given["dbtable"] = f"({query}) source_query"
    else:
        given["query"] = query
    return {**given, **(partition_options(partition) if partition else {})}


def scan_jdbc(
    spark: SparkSession,
    connection: dict[str, Any],
    table: str,
    schema: str | None = None,
    partition: dict[str, Any] | None = None,
    predicates: list[str] | None = None,
    options: dict[str, Any] | None = None,
) -> DataFrame:
    """A table as a lazy DataFrame.

    Split it by ``partition``, an equal-width cut of a numeric, date or timestamp column, or by
    ``predicates``, one task each: disjoint conditions that cover all rows, for a column whose
    values crowd together.
    """
    if predicates:
        given = {**connection, **(options or {})}
        url = given.pop("url")
        properties = {k: str(v) for k, v in given.items()}
        return spark.read.jdbc(
            url, qualified(table, schema), predicates=predicates, properties=properties
        )
    given = read_options(connection, table, schema, None, partition, options)
    return spark.read.format("jdbc").options(**given).load()


def scan_jdbc_query(
    spark: SparkSession,
    connection: dict[str, Any],
    query: str,
    partition: dict[str, Any] | None = None,
    options: dict[str, Any] | None = None,
) -> DataFrame:
    given = read_options(connection, None, None, query, partition, options)
    return spark.read.format("jdbc").options(**given).load()


def scan_jdbc_many(
    spark: SparkSession,
    connection: dict[str, Any],
    tables: list[dict[str, Any]],
    options: dict[str, Any] | None = None,
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Lazy DataFrames by name, and the reasons of the tables that could not be opened.

    A table is ``{name, source_table, source_schema, partition, predicates}``.
    """
    frames, errors = {}, {}
    for t in tables:
        table, schema = t.get("source_table", t["name"]), t.get("source_schema")
        try:
            frames[t["name"]] = scan_jdbc(
                spark, connection, table, schema, t.get("partition"), t.get("predicates"), options
            )
        except (*FAILURES, ValueError) as e:
            errors[t["name"]] = str(e)
    return frames, errors


def write_jdbc(
    df: DataFrame,
    connection: dict[str, Any],
    table: str,
    schema: str | None = None,
    mode: str = "overwrite",
    options: dict[str, Any] | None = None,
) -> None:
    """Write to a table; ``numPartitions`` in the options bounds the connections opened."""
    given = {**connection, **(options or {}), "dbtable": qualified(table, schema)}
    df.write.format("jdbc").options(**given).mode(mode).save()
