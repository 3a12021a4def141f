"""File checksums against a plain recomputation."""

import hashlib
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.plans.ingest import ingest_files
from stratalake.sinks.tables import table_name
from stratalake.sources.checksums import file_checksums
from stratalake.sources.files import discover_files
from tests.conftest import FAILURES


def plain(data: bytes, size: int, fanout: int) -> str:
    level = [hashlib.sha256(data[i : i + size]).hexdigest() for i in range(0, max(len(data), 1), size)]
    for width in (fanout, fanout, len(level)):
        groups = [level[i : i + width] for i in range(0, len(level), width)]
        level = [g[0] if len(g) == 1 else hashlib.sha256("".join(g).encode()).hexdigest() for g in groups]
    return level[0]


def test_every_length_equals_a_plain_recomputation(spark, tmp_path):
    numbers, contents = random.Random(1), {}
    for n in (0, 1, 99, 100, 101, 200, 300, 301, 900, 901, 2_700, 3_333):
        contents[f"f {n}.bin"] = numbers.randbytes(n)
        (tmp_path / f"f {n}.bin").write_bytes(contents[f"f {n}.bin"])
    listed = discover_files(spark, str(tmp_path))
    # A listing by scan leaves files without a byte out; other listings name them.
    empty = listed.limit(1).select(
        F.lit("f 0.bin").alias("file_path"), F.lit("/f 0.bin").alias("path"), "modified_at",
        F.lit(0).cast("long").alias("length"),
    )
    files = listed.filter("length > 0").unionByName(empty)
    found = file_checksums(spark, files, range_bytes=100, fanout=3).join(files, "file_path").collect()
    assert len(found) == len(contents)
    by_name = {r.path.rsplit("/", 1)[1].replace("%20", " "): r.checksum for r in found}
    assert by_name == {name: plain(data, 100, 3) for name, data in contents.items()}
    usual = {r.checksum for r in file_checksums(spark, files).collect()}
    assert usual == {hashlib.sha256(data).hexdigest() for data in contents.values()}
    assert file_checksums(spark, files.limit(0)).count() == 0


def test_a_file_that_became_shorter_is_an_error(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"x" * 500)
    files = spark.createDataFrame(discover_files(spark, str(tmp_path)).collect())
    longer = files.withColumn("length", F.lit(900).cast("long"))
    with pytest.raises(FAILURES):
        file_checksums(spark, longer, range_bytes=100).collect()


def test_a_load_records_the_checksums_of_loaded_files(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    texts = {"s_1.csv": "id\n1\n2\n", "s_2.csv": "id\n3\n", "s_3.csv": "id\nx\n"}
    for name, text in texts.items():
        (inbox / name).write_text(text)
    source = {
        "name": "sales", "type": "csv", "connection": {"path": str(inbox), "file_pattern": "s_*.csv"},
        "schema": {"columns": [{"name": "id", "type": "int", "nullable": False}]},
        "ingestion": {"mode": "incremental", "checksum": True},
    }
    data, ledger = (
        {"table": f"{label}_{tmp_path.name}", "path": str(tmp_path / label)}
        for label in ("sums_data", "sums_ledger")
    )
    ingest_files(spark, source, data, datetime(2024, 1, 15), ledger=ledger, fail_on_error=False)
    rows = spark.table(table_name(ledger)).select("file_path", "status", "checksum").collect()
    done = {r.file_path.rsplit("/", 1)[1]: r.checksum for r in rows if r.status == "success"}
    assert done == {n: hashlib.sha256(texts[n].encode()).hexdigest() for n in ("s_1.csv", "s_2.csv")}
    assert all(r.checksum is None for r in rows if r.status != "success")
