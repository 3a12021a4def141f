"""Every registered query with SQL gives what DuckDB gives, on whole tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, name, SF_DIR) == ""


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
