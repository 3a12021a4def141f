"""Streams of files that differ in their columns, or cannot be read."""

import json

import pytest

from stratalake.streaming.ingest import ingest_stream, read_file_stream
from tests.conftest import rows_of
from tests.test_files import AT, SCHEMA, put


@pytest.fixture
def stream(spark, tmp_path):
    def run(kind, **options):
        given = {"name": "sales", "type": kind, "schema": SCHEMA}
        files = read_file_stream(spark, given, str(tmp_path / "in"))
        out = f"{tmp_path}/out"
        ingest_stream(files, given, out, f"{tmp_path}/cp", AT, **options).awaitTermination()
        return spark.read.option("mergeSchema", "true").parquet(out)

    return run


def refused(spark, tmp_path):
    rows = spark.read.json(f"{tmp_path}/out_rejected").collect()
    return sorted(r.source_file.rpartition("/")[2] for r in rows)


def test_csv_streams_keep_extra_and_reordered_columns(spark, tmp_path, stream):
    inbox = tmp_path / "in"
    put(inbox / "day=6", "a.csv", "id,amount\n1,1.00\n")
    put(inbox / "day=7", "b.csv", "amount,extra,id\n2.00,x,2\n")
    assert [(r.id, str(r.amount), r.extra, r.day) for r in stream("csv").orderBy("id").collect()] == [
        (1, "1.00", None, 6), (2, "2.00", "x", 7),
    ]


def test_streams_set_unreadable_files_aside(spark, tmp_path, stream):
    inbox = tmp_path / "in"
    put(inbox, "a.csv", "id,amount\n1,1.00\n")
    put(inbox, "b.csv", "\n\n")
    put(inbox, "c.csv", "other\n3\n")
    with pytest.raises(Exception, match="no header"):
        stream("csv")
    assert rows_of(stream("csv", fail_on_error=False), "id") == [(1,)]
    assert refused(spark, tmp_path) == ["b.csv", "c.csv"]


def test_json_streams_keep_undeclared_columns(spark, tmp_path, stream):
    put(tmp_path / "in", "a.json", json.dumps({"extra": 5, "amount": "1.00", "id": 1}))
    assert rows_of(stream("json"), "id", "extra") == [(1, "5")]


def test_parquet_streams_keep_undeclared_columns(spark, tmp_path, stream, frame):
    inbox = tmp_path / "in"
    fields = "extra int, amount decimal(10,2), id int"
    frame(fields, (5, None, 1)).coalesce(1).write.parquet(str(inbox))
    assert rows_of(stream("parquet"), "id", "extra") == [(1, 5)]
    put(inbox, "bad.parquet", "not parquet")
    frame("id int, amount string", (2, "x")).coalesce(1).write.mode("append").parquet(str(inbox))
    assert rows_of(stream("parquet", fail_on_error=False), "id", "extra") == [(1, 5)]
    assert len(refused(spark, tmp_path)) == 2
