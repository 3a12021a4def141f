"""Connector options; no database is started for these tests."""

from types import SimpleNamespace

import pytest

from stratalake.sources import jdbc

CONNECTION = {"url": "jdbc:x:y", "user": "u", "password": "p", "driver": "d"}
SPLIT = {"column": "id", "lower": 0, "upper": 1000, "partitions": 4}


def test_tables_queries_and_schemas():
    assert jdbc.read_options(CONNECTION, "T", "S")["dbtable"] == "S.T"
    assert jdbc.read_options(CONNECTION, "T")["dbtable"] == "T"
    assert jdbc.read_options(CONNECTION, query="SELECT 1 FROM d")["query"] == "SELECT 1 FROM d"
    for wrong in ({}, {"table": "T", "query": "SELECT 1"}):
        with pytest.raises(ValueError):
            jdbc.read_options(CONNECTION, **wrong)


def test_a_split_read_needs_all_four_settings():
    given = jdbc.read_options(CONNECTION, "T", partition=SPLIT, options={"fetchsize": 10000})
    assert given["numPartitions"] == "4" and given["partitionColumn"] == "id"
    assert given["fetchsize"] == 10000 and given["upperBound"] == "1000"
    with pytest.raises(ValueError):
        jdbc.read_options(CONNECTION, "T", partition={"column": "id", "partitions": 4})
    with pytest.raises(ValueError):
        jdbc.read_options(CONNECTION, "T", options={"numPartitions": 4})


def test_a_split_query_becomes_a_derived_table_without_as():
    given = jdbc.read_options(CONNECTION, query="SELECT * FROM t", partition=SPLIT)
    assert given["dbtable"] == "(SELECT * FROM t) source_query" and "query" not in given


class FakeReader:
    """Stands in for the session's reader, and knows one table that cannot be opened."""

    def __init__(self):
        self.opened = []

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **given):
        self.given = given
        return self

    def load(self):
        if self.given["dbtable"].endswith("BROKEN"):
            raise ValueError("no such table")
        self.opened.append(self.given["dbtable"])
        return self.given["dbtable"]

    def jdbc(self, url, table, predicates, properties):
        assert url == CONNECTION["url"] and "url" not in properties
        self.opened.append((table, tuple(predicates)))
        return table


def test_many_tables_open_lazily_and_failures_are_named():
    reader = FakeReader()
    tables = [
        {"name": "orders", "source_table": "ORDERS", "source_schema": "SALES"},
        {"name": "broken", "source_table": "BROKEN", "source_schema": "SALES"},
        {"name": "stock", "predicates": ["a < 1", "a >= 1"]},
    ]
    frames, errors = jdbc.scan_jdbc_many(SimpleNamespace(read=reader), CONNECTION, tables)
    assert frames == {"orders": "SALES.ORDERS", "stock": "stock"}
    assert errors == {"broken": "no such table"}
    assert reader.opened == ["SALES.ORDERS", ("stock", ("a < 1", "a >= 1"))]


def test_writing_passes_mode_and_options():
    calls = {}

    class Writer:
        def format(self, name):
            return self

        def options(self, **given):
            calls.update(given)
            return self

        def mode(self, name):
            calls["mode"] = name
            return self

        def save(self):
            calls["saved"] = True

    jdbc.write_jdbc(SimpleNamespace(write=Writer()), CONNECTION, "T", "S", options={"batchsize": 5})
    assert calls["dbtable"] == "S.T" and calls["mode"] == "overwrite" and calls["saved"]
    assert calls["batchsize"] == 5
