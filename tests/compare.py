"""Run registered queries next to their SQL in DuckDB and compare whole results.

``python tests/compare.py /root/testdata/sf0.01 [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def bag(columns: list[str], rows: list) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, name: str, sf_dir: str) -> str:
    """Empty when Spark and DuckDB agree on columns, types and rows."""
    df = entry.queries()[name](spark, sf_dir)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return ""
    with duckdb.connect() as db:
        for t in TABLES:
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
        result = db.execute(sql)
        expected_columns = [d[0] for d in result.description]
        expected_types = {d[0]: str(d[1]) for d in result.description}
        expected = result.fetchall()
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} against {sorted(expected_columns)}"
    types = {
        c: (t, expected_types[c])
        for c, t in df.dtypes
        if SAME_TYPE.get(t) not in (expected_types[c],) and expected_types[c] != "STRING"
    }
    mine, other = bag(df.columns, rows), bag(expected_columns, expected)
    if mine != other:
        lost, extra = list((other - mine).items())[:2], list((mine - other).items())[:2]
        return f"{len(rows)} rows against {len(expected)}; SQL has {lost}, Spark has {extra}"
    return f"types {types}" if types else ""


def main() -> None:
    from tests.session import local_session

    spark, sf_dir = local_session(), sys.argv[1]
    for name in sys.argv[2:] or entry.queries():
        began = time.time()
        try:
            problem = compare(spark, name, sf_dir)
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{name:26} {time.time() - began:6.1f}s {problem or 'ok'}", flush=True)


if __name__ == "__main__":
    main()
