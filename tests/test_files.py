import gzip
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stratalake.operators.enforce import enforce_schema
from stratalake.operators.validate import SchemaInvalid
from stratalake.plans import ingest
from stratalake.plans.ingest import IngestFailed, cleansed_rows, ingest_files, ingest_table
from stratalake.sinks import control
from stratalake.sinks.tables import ensure_table, table_name, write_files, write_table
from stratalake.sources import files, incremental
from stratalake.streaming.ingest import ingest_stream, read_file_stream
from tests.conftest import FAILURES, rows_of

AT = datetime(2024, 1, 15, 12)
SCHEMA = {
    "columns": [
        {"name": "id", "type": "int", "nullable": False},
        {"name": "amount", "type": "decimal(10,2)", "constraints": {"min": 0}},
    ]
}


def put(folder, name, text):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text(text)
    return str(folder / name)


def source(folder, kind="csv", **more):
    return {
        "name": "sales", "type": kind, "schema": SCHEMA,
        "connection": {"path": str(folder), "file_pattern": f"s_*.{kind}"},
        "ingestion": {"mode": "incremental"}, **more,
    }


@pytest.fixture
def places(tmp_path, request):
    label = f"t{abs(hash((request.node.name, str(tmp_path)))):x}"
    return (
        {"table": f"{label}_data", "path": str(tmp_path / "data")},
        {"table": f"{label}_ledger", "path": str(tmp_path / "ledger")},
    )


def test_listing_matches_names_and_reads_no_content(spark, tmp_path):
    put(tmp_path, "s_1 a.csv", "x")
    put(tmp_path, "other.csv", "x")
    put(tmp_path / "sub", "s_2.csv", "x")
    listed = files.discover_files(spark, str(tmp_path), "s_*.csv")
    row = listed.first()
    assert listed.count() == 1 and row.length == 1
    assert row.file_path.endswith("s_1%20a.csv") and row.path.endswith("s_1 a.csv")
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    (tmp_path / "empty").mkdir()
    assert files.discover_files(spark, str(tmp_path / "empty")).count() == 0
    with pytest.raises(AnalysisException):
        files.discover_files(spark, str(tmp_path / "absent"))


def test_dated_paths_follow_the_given_days():
    pattern = "sales/{year}/{month}/{day}/s_{date}_*.csv"
    assert files.dated_paths(pattern, date(2024, 2, 29)) == ["sales/2024/02/29/s_20240229_*.csv"]
    assert files.dated_paths("m/{year}-{month}", date(2024, 1, 31), date(2024, 2, 2)) == [
        "m/2024-01", "m/2024-02",
    ]


def test_csv_header_mismatch_fails_instead_of_shifting(spark, tmp_path):
    put(tmp_path, "a.csv", "amount,id\n1.5,1\n")
    with pytest.raises(FAILURES):
        files.scan_csv(spark, str(tmp_path), SCHEMA).collect()


def test_csv_without_schema_is_inferred_and_options_rule(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'a;b\n1;"x;""y"""\n')
    df = files.scan_csv(spark, path, options={"delimiter": ";"})
    assert df.dtypes == [("a", "int"), ("b", "string")] and tuple(df.first()) == (1, 'x;"y"')


def test_json_lines_and_whole_files(spark, tmp_path):
    lines = put(tmp_path, "a.json", '{"id": 1, "amount": 2.5}\n{broken\n')
    df = files.scan_json(spark, lines, SCHEMA)
    assert rows_of(df, "id", "amount", files.READ_ERROR) == [
        (None, None, "{broken"), ("1", "2.5", None),
    ]
    whole = put(tmp_path, "b.json", '[{"id": 1,\n "x": {"y": [1, 2]}}]')
    nested = files.scan_json(spark, whole, options={"multiLine": "true"})
    assert nested.first().x.y == [1, 2]


def test_files_of_differing_headers_are_read_by_name(spark, tmp_path):
    put(tmp_path, "s_1.csv", "id,amount\n1,1.00\n")
    put(tmp_path, "s_2.csv", "amount,id,note\n2.00,2,hey\n")
    put(tmp_path, "s_3.csv", "id,amount\n3,3.00\n")
    put(tmp_path, "s_4 odd.csv", 'id,"amount"\n4,4.00\n')
    put(tmp_path, "s_5.csv", "")
    listed = files.discover_files(spark, str(tmp_path), "s_*.csv")
    df = files.read_many(spark, source(tmp_path), listed)
    assert rows_of(df, "id", "amount", "note") == [
        ("1", "1.00", None), ("2", "2.00", "hey"), ("3", "3.00", None), ("4", "4.00", None),
    ]
    # Spark never lists files without a byte, so s_5 is neither read nor recorded.
    names = {r.file_path for r in listed.collect()}
    assert {r.source_file for r in df.collect()} == names


def test_csv_files_are_one_scan_where_headers_cannot_be_read(spark, tmp_path, monkeypatch):
    put(tmp_path, "s_1.csv", "id,amount\n1,1.00\n")
    put(tmp_path, "s_2.csv", "id,amount\n2,2.00\n")
    monkeypatch.setattr(
        files, "csv_headers", lambda listed, options: listed.selectExpr("raise_error('no access')")
    )
    listed = files.discover_files(spark, str(tmp_path), "s_*.csv")
    df = files.read_many(spark, source(tmp_path), listed)
    assert rows_of(df, "id") == [("1",), ("2",)]
    put(tmp_path, "s_3.csv", "amount,id\n3.00,3\n")
    listed = files.discover_files(spark, str(tmp_path), "s_*.csv")
    with pytest.raises(FAILURES):
        files.read_many(spark, source(tmp_path), listed).collect()


def test_new_files_load_once_and_with_their_ledger(spark, tmp_path, places):
    data, ledger = places
    inbox = tmp_path / "in"
    put(inbox, "s_1.csv", "id,amount\n1,1.00\n2,2.00\n")
    put(inbox, "ignored.txt", "id\n")
    run = lambda: ingest_files(spark, source(inbox), data, AT, ledger=ledger)
    first = run()
    assert (first.files_processed, first.records) == (1, 2)
    assert run().files_processed == 0
    put(inbox, "s_2.csv", "id,amount,extra\n3,3.00,e\n")
    put(inbox, "s_3.csv", "id,amount\n")
    second = run()
    assert (second.files_processed, second.records) == (2, 1)
    assert run().files_processed == 0
    table = spark.table(table_name(data))
    assert rows_of(table, "id", "extra", "source_system") == [
        (1, None, "sales"), (2, None, "sales"), (3, "e", "sales"),
    ]
    assert dict(table.dtypes)["amount"] == "decimal(10,2)"
    kept = spark.table(table_name(ledger)).filter("status = 'success'")
    counts = {r.file_path.split("/")[-1]: r.record_count for r in kept.collect()}
    assert counts == {"s_1.csv": 2, "s_2.csv": 1, "s_3.csv": 0}
    assert all(r.created_by and r.processing_duration_seconds > 0 for r in kept.collect())
    assert second.summary.first().records_processed == 1


def test_a_bad_file_stops_the_run_or_is_left_for_later(spark, tmp_path, places):
    data, ledger = places
    inbox = tmp_path / "in"
    put(inbox, "s_1.csv", "id,amount\n1,1.00\n")
    put(inbox, "s_2.csv", "id,amount\nx,-1.00\n")
    with pytest.raises(IngestFailed, match="id cast 1"):
        ingest_files(spark, source(inbox), data, AT, ledger=ledger)
    assert not spark.catalog.tableExists(table_name(data))
    lenient = ingest_files(spark, source(inbox), data, AT, ledger=ledger, fail_on_error=False)
    assert (lenient.files_processed, lenient.files_failed, lenient.records) == (1, 1, 1)
    put(inbox, "s_2.csv", "id,amount\n2,2.00\n")
    again = ingest_files(spark, source(inbox), data, AT, ledger=ledger)
    assert (again.files_processed, again.records) == (1, 1)
    assert rows_of(spark.table(table_name(data)), "id") == [(1,), (2,)]


def test_lenient_schemas_load_what_fits(spark, tmp_path, places):
    inbox = tmp_path / "in"
    put(inbox, "s_1.csv", "id,amount\n1,x\n")
    loose = source(inbox, schema={**SCHEMA, "strict_validation": False})
    assert ingest_files(spark, loose, places[0], AT, ledger=places[1]).records == 1
    assert rows_of(spark.table(table_name(places[0])), "id", "amount") == [(1, None)]


def test_rejected_records_make_a_file_invalid(spark, tmp_path, places):
    inbox = tmp_path / "in"
    put(inbox, "s_1.json", '{"id": 1, "amount": 2}\n{oops\n')
    with pytest.raises(IngestFailed, match="_read_error readable 1"):
        ingest_files(spark, source(inbox, "json"), places[0], AT, ledger=places[1])


def test_typed_files_are_judged_by_their_types(spark, tmp_path, places, frame):
    inbox = tmp_path / "in"
    good = frame("id int, amount decimal(10,2)", (1, None))
    good.coalesce(1).write.parquet(str(inbox / "p"))
    (part,) = (inbox / "p").glob("*.parquet")
    (inbox / "s_1.parquet").write_bytes(part.read_bytes())
    (inbox / "s_2.parquet").write_text("not parquet")
    given = source(inbox, "parquet")
    with pytest.raises((*FAILURES, IngestFailed)):
        ingest_files(spark, given, places[0], AT, ledger=places[1])
    with pytest.raises((*FAILURES, IngestFailed)):
        ingest_files(
            spark, {**given, "schema": {"columns": [{"name": "id", "type": "date"}]},
                    "connection": {"path": str(inbox), "file_pattern": "s_1*"}},
            places[0], AT, ledger=places[1],
        )


def test_a_run_that_died_after_its_write_is_settled_by_the_next(spark, tmp_path, places, monkeypatch):
    data, ledger = places
    inbox = tmp_path / "in"
    put(inbox, "s_1.csv", "id,amount\n1,1.00\n2,2.00\n")
    record = ingest._record

    def die_on_success(*args):
        if args[6] == "success":
            raise KeyboardInterrupt
        record(*args)

    monkeypatch.setattr(ingest, "_record", die_on_success)
    with pytest.raises(KeyboardInterrupt):
        ingest_files(spark, source(inbox), data, AT, ledger=ledger)
    monkeypatch.setattr(ingest, "_record", record)
    put(inbox, "s_2.csv", "id,amount\n3,3.00\n")
    assert ingest_files(spark, source(inbox), data, AT, ledger=ledger).files_processed == 1
    assert rows_of(spark.table(table_name(data)), "id") == [(1,), (2,), (3,)]
    done = spark.table(table_name(ledger)).filter("status = 'success'")
    assert done.select("file_path").distinct().count() == done.count() == 2


def test_a_run_that_died_before_its_write_is_repeated(spark, tmp_path, places, monkeypatch):
    data, ledger = places
    inbox = tmp_path / "in"
    put(inbox, "s_1.csv", "id,amount\n1,1.00\n")

    def die(*args, **kwargs):
        raise KeyboardInterrupt

    write = ingest.write_table
    monkeypatch.setattr(
        ingest, "write_table", lambda df, t, *a: die() if t is data else write(df, t, *a)
    )
    with pytest.raises(KeyboardInterrupt):
        ingest_files(spark, source(inbox), data, AT, ledger=ledger)
    monkeypatch.setattr(ingest, "write_table", write)
    assert ingest_files(spark, source(inbox), data, AT, ledger=ledger).records == 1
    assert spark.table(table_name(data)).count() == 1


def test_full_mode_reads_everything_again_and_patterns_need_a_day(spark, tmp_path, places):
    inbox = tmp_path / "2024" / "01"
    put(inbox, "s_1.csv", "id,amount\n1,1.00\n")
    full = source(
        inbox, ingestion={"mode": "full"},
        connection={"path_pattern": f"{tmp_path}/{{year}}/{{month}}", "file_pattern": "s_*.csv"},
    )
    for _ in range(2):
        got = ingest_files(spark, full, places[0], AT, day=date(2024, 1, 9), write_mode="overwrite")
        assert got.records == 1
    assert spark.table(table_name(places[0])).count() == 1
    with pytest.raises(ValueError):
        ingest_files(spark, full, places[0], AT)


def test_ledger_is_scoped_by_source_and_by_success(frame):
    listed = frame("file_path string", ("a",), ("b",), ("c",))
    ledger = frame(
        "file_path string, source_name string, status string",
        ("a", "me", "success"), ("b", "other", "success"), ("c", "me", "failed"),
        ("a", "me", "started"),
    )
    assert rows_of(incremental.unprocessed_files(listed, ledger, "me")) == [("b",), ("c",)]


def test_cursors(spark, frame):
    df = frame("id int, c date", (1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, None))
    scan = lambda w: rows_of(incremental.incremental_scan(df, "c", w), "id")
    assert scan(None) == [(1,), (2,), (3,)]
    assert scan("2024-01-01") == [(2,)] and scan("2024-01-02") == []
    newest = incremental.next_watermark(df, "c")
    assert newest.first().watermark_value == "2024-01-02"
    row = control.watermark_row(newest, "erp", "t", "c", AT)
    older = control.watermark_row(newest, "erp", "t", "c", datetime(2023, 1, 1))
    stored = row.unionAll(older.withColumn("watermark_value", F.lit("old")))
    assert incremental.stored_watermark(stored, "erp", "t", "c") == "2024-01-02"
    assert incremental.stored_watermark(stored, "erp", "t", "d") is None
    nothing = incremental.next_watermark(df.filter("id > 9"), "c")
    assert control.watermark_row(nothing, "erp", "t", "c", AT).count() == 0


def test_tables_are_created_once_with_their_declaration(spark, tmp_path, places):
    target = {
        **places[0],
        "columns": [
            {"name": "id", "type": "long", "nullable": False, "comment": "it's a key"},
            {"name": "d", "type": "date"},
        ],
        "partition_columns": ["d"],
        "table_properties": {"layer": "raw"},
    }
    name = ensure_table(spark, target)
    assert ensure_table(spark, target) == name
    described = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    assert described["id"] == "it's a key"
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert properties["layer"] == "raw"
    with pytest.raises(ValueError):
        ensure_table(spark, {"table": places[0]["table"] + "_x"})


def test_appends_align_and_add_columns(frame, places, spark):
    assert write_table(frame("a int, b string", (1, "x")), places[0]) == 1
    assert write_table(frame("b string, c int, a long", ("y", 3, 2)), places[0]) == 1
    assert write_table(frame("c int", (4,)), places[0]) == 1
    assert rows_of(spark.table(table_name(places[0]))) == [
        (None, None, 4), (1, "x", None), (2, "y", 3),
    ]


def test_unknown_formats_are_refused(spark, frame, tmp_path):
    with pytest.raises(ValueError):
        write_files(frame("a int", (1,)), str(tmp_path / "x"), "orc")
    with pytest.raises(ValueError):
        files.read_many(spark, {"type": "xml"}, files.discover_files(spark, str(tmp_path)))


def test_workbooks_stream_like_other_files(spark, tmp_path):
    from tests.test_workbook import HEADER, text, write_book

    inbox, out = tmp_path / "in", f"{tmp_path}/out"
    inbox.mkdir()
    schema = {"columns": [{"name": "id", "type": "int", "nullable": False}, {"name": "name"}]}
    given = {"name": "books", "type": "excel", "schema": schema,
             "read_options": {"sheet_name": "S", "pathGlobFilter": "*.xlsx"}}
    for n in (1, 2):
        row = f'<row>{text("A2", n)}{text("B2", "x")}</row>'
        write_book(inbox / f"{n}.xlsx", {"S": HEADER + row})
        stream = read_file_stream(spark, given, str(inbox))
        ingest_stream(stream, given, out, f"{tmp_path}/cp", AT).awaitTermination()
    assert rows_of(spark.read.parquet(out), "id", "name", "batch_id") == [
        (1, "x", "books-0"), (2, "x", "books-1"),
    ]
    (inbox / "3.xlsx").write_text("garbage")
    stream = read_file_stream(spark, given, str(inbox))
    ingest_stream(stream, given, out, f"{tmp_path}/cp", AT, fail_on_error=False).awaitTermination()
    assert spark.read.json(f"{out}_rejected").first().source_file.endswith("3.xlsx")


def test_a_stream_stores_each_file_once_and_rejects_bad_ones(spark, tmp_path):
    inbox, out = tmp_path / "in", f"{tmp_path}/out"
    given = {"name": "sales", "type": "csv", "schema": SCHEMA}
    put(inbox, "a.csv", "id,amount\n1,1.00\n")

    def run(**options):
        stream = read_file_stream(spark, given, str(inbox))
        ingest_stream(stream, given, out, f"{tmp_path}/cp", AT, **options).awaitTermination()

    run()
    run()
    put(inbox, "b.csv", "id,amount\n2,2.00\n")
    put(inbox, "c.csv", "id,amount\n3,-3.00\n")
    with pytest.raises(Exception, match="amount min 1"):
        run()
    assert spark.read.parquet(out).count() == 1
    run(fail_on_error=False)
    assert rows_of(spark.read.parquet(out), "id", "batch_id") == [(1, "sales-0"), (2, "sales-1")]
    refused = spark.read.json(f"{out}_rejected").first()
    assert refused.source_file.endswith("c.csv") and refused.errors == ["amount min 1"]


def test_unreadable_typed_files_are_left_for_later(spark, tmp_path, places, frame):
    inbox = tmp_path / "in"
    frame("id int, amount decimal(10,2)", (1, None)).coalesce(1).write.parquet(str(inbox / "p"))
    (part,) = (inbox / "p").glob("*.parquet")
    (inbox / "s_1.parquet").write_bytes(part.read_bytes())
    (inbox / "s_2.parquet").write_text("not parquet")
    got = ingest_files(
        spark, source(inbox, "parquet"), places[0], AT, ledger=places[1], fail_on_error=False
    )
    assert (got.files_processed, got.files_failed, got.records) == (1, 1, 1)
    failed = spark.table(table_name(places[1])).filter("status = 'failed'").first()
    assert failed.error_message == "cannot be read"


def test_nested_types_are_read_from_their_text(spark, tmp_path):
    path = put(tmp_path, "a.json", '{"id": 1, "l": [1, 2], "s": {"x": "y"}}\n{"id": 2, "l": "no"}\n')
    schema = {
        "columns": [
            {"name": "id", "type": "int"},
            {"name": "l", "type": "array<int>"},
            {"name": "s", "type": "struct<x: string>"},
        ]
    }
    rows = enforce_schema(files.scan_json(spark, path, schema), schema).orderBy("id").collect()
    assert rows[0].l == [1, 2] and rows[0].s.x == "y" and rows[1].l is None


TABLE = "id int, c date, v string"
ROWS = [(1, date(2024, 1, 1), "a"), (2, date(2024, 1, 2), "b"), (3, None, "c"),
        (4, date(2024, 1, 3), "d")]


def test_tables_load_by_cursor_once(spark, frame, places):
    data, marks = places

    def run(*rows):
        return ingest_table(
            spark, frame(TABLE, *rows), "erp", "t", data, AT, cursor="c", watermarks=marks
        ).records

    assert run(*ROWS[:3]) == 3  # the first load takes rows without a cursor value, too
    assert run(*ROWS[:3]) == 0
    assert run(*ROWS) == 1
    assert rows_of(spark.table(table_name(data)), "id") == [(1,), (2,), (3,), (4,)]
    stored = spark.table(table_name(marks))
    assert rows_of(stored, "watermark_value") == [("2024-01-02",), ("2024-01-03",)]


def test_a_first_load_without_any_cursor_value_loads_once(spark, frame, places):
    data, marks = places

    def run(*rows):
        return ingest_table(
            spark, frame(TABLE, *rows), "erp", "t", data, AT, cursor="c", watermarks=marks
        ).records

    bare = [(8, None, "e"), (9, None, "f")]
    assert run() == 0
    assert run(*bare) == 2
    assert run(*bare) == 0
    assert run(*bare, *ROWS) == 3  # a value came; rows without one are there already
    assert run(*bare, *ROWS) == 0
    assert rows_of(spark.table(table_name(data)), "id") == [(1,), (2,), (4,), (8,), (9,)]


def test_a_table_load_that_died_before_its_cursor_is_not_repeated(
    spark, frame, places, monkeypatch
):
    data, marks = places
    load = lambda *rows: ingest_table(
        spark, frame(TABLE, *rows), "erp", "t", data, AT, cursor="c", watermarks=marks
    )
    write = ingest.write_table

    def die_on_marks(df, target, *mode):
        if target is marks:
            raise KeyboardInterrupt
        return write(df, target, *mode)

    monkeypatch.setattr(ingest, "write_table", die_on_marks)
    with pytest.raises(KeyboardInterrupt):
        load(*ROWS[:3])
    monkeypatch.setattr(ingest, "write_table", write)
    # Since then one row has come and one has changed, which moved its cursor value.
    moved = (1, date(2024, 1, 9), "changed")
    assert load(*ROWS[1:], moved).records == 2 and load(*ROWS[1:], moved).records == 0
    assert rows_of(spark.table(table_name(data)), "id") == [(1,), (1,), (2,), (3,), (4,)]
    assert spark.table(table_name(marks)).count() == 2


def test_a_table_load_that_lost_rows_is_reported(spark, frame, places):
    data, marks = places
    load = lambda *rows: ingest_table(
        spark, frame(TABLE, *rows), "erp", "t", data, AT, cursor="c", watermarks=marks
    )
    load(ROWS[0])
    forgotten = {**marks, "table": marks["table"] + "_new", "path": marks["path"] + "_new"}
    with pytest.raises(IngestFailed):
        ingest_table(
            spark, frame(TABLE, ROWS[0], (9, date(2023, 1, 1), "x")), "erp", "t", data, AT,
            cursor="c", watermarks=forgotten,
        )


def test_full_table_loads_replace_and_validate(spark, frame, places):
    schema = {"columns": [{"name": "id", "type": "int", "nullable": False}]}
    for rows in (ROWS, ROWS[:2]):
        ingest_table(spark, frame(TABLE, *rows), "erp", "t", places[0], AT, schema=schema)
    assert spark.table(table_name(places[0])).count() == 2
    with pytest.raises(SchemaInvalid):
        ingest_table(spark, frame(TABLE, (None, None, "")), "erp", "t", places[0], AT, schema=schema)
    with pytest.raises(ValueError):
        ingest_table(spark, frame(TABLE), "erp", "t", places[0], AT, cursor="c")


def test_a_damaged_compressed_file_loads_none_of_its_rows(spark, tmp_path, places):
    inbox = tmp_path / "in"
    text = "id,amount\n" + "".join(f"{i},{i}.00\n" for i in range(200_000))
    packed = gzip.compress(text.encode())
    for name, content in [("s_1", packed), ("s_2", packed[: len(packed) // 2]), ("s_3", packed)]:
        inbox.mkdir(exist_ok=True)
        (inbox / f"{name}.csv.gz").write_bytes(content)
    given = source(inbox, connection={"path": str(inbox), "file_pattern": "s_*.csv.gz"})
    with pytest.raises(FAILURES):
        ingest_files(spark, given, places[0], AT, ledger=places[1])
    got = ingest_files(spark, given, places[0], AT, ledger=places[1], fail_on_error=False)
    assert (got.files_processed, got.files_failed, got.records) == (2, 1, 400_000)


@pytest.mark.parametrize(
    ("content", "options"),
    [
        (b"\n\nid,name\n1,x\n2,y\n", {}),
        (b"\xef\xbb\xbfid,name\n1,x\n2,y\n", {}),
        (b"id;name\n1;x\n2;y\n", {"sep": ";"}),
        (b"# made by hand\nid,name\n1,x\n2,y\n", {"comment": "#"}),
        ("id,name\n1,x\n2,y\n".encode("utf-16"), {"charset": "utf-16", "multiLine": "true"}),
    ],
)
def test_headers_are_found_where_spark_finds_them(spark, tmp_path, content, options):
    (tmp_path / "a.csv").write_bytes(content)
    source = {"type": "csv", "read_options": options}
    got = files.read_many(spark, source, files.discover_files(spark, str(tmp_path)))
    assert rows_of(got, "id", "name") == [("1", "x"), ("2", "y")]


def test_a_file_of_bytes_without_header_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"id\n1\n")
    (tmp_path / "b.csv").write_bytes(b"\n \n")
    (tmp_path / "c.csv").write_bytes(b"")
    listed = files.discover_files(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no header in 1 files"):
        files.read_many(spark, {"type": "csv"}, listed)


def test_scratch_needs_a_shared_folder_off_local_mode():
    from types import SimpleNamespace

    from stratalake.session import scratch_dir

    def session(master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: default),
            sparkContext=SimpleNamespace(master=master),
        )

    assert scratch_dir(session("local[4]"), "x").startswith("file://")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_dir(session(master), "x")


def test_undeclared_json_columns_and_malformed_text_are_kept(spark, tmp_path):
    path = put(tmp_path, "a.json", '{"id": 1, "more": {"x": 1}}\n{"id": 2, "note": "n"}\n{oops\n')
    schema = {"columns": [{"name": "id", "type": "integer"}], "strict_validation": False}
    df = files.scan_json(spark, path, schema)
    assert df.columns == ["id", "more", "note", files.READ_ERROR]
    rows = cleansed_rows(
        df.withColumn("source_file", F.lit("a")), {"type": "json", "schema": schema}, "b", AT
    )
    found = {r.id: (r.more, r.note, r[files.READ_ERROR]) for r in rows.collect()}
    assert found == {1: ('{"x": 1}', None, None), 2: (None, "n", None), None: (None, None, "{oops")}


def test_a_batch_that_lost_a_row_is_never_visible_and_the_next_run_loads_it(
    spark, tmp_path, places, monkeypatch
):
    data, ledger = places
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "s_1.csv").write_text("id,amount\n1,2\n2,3\n")
    assert ingest_files(spark, source(inbox), data, AT, ledger=ledger).records == 2
    (inbox / "s_2.csv").write_text("id,amount\n3,4\n4,5\n")
    whole = ingest.cleansed_rows
    monkeypatch.setattr(ingest, "cleansed_rows", lambda *a: whole(*a).filter("id <> 4"))
    with pytest.raises(IngestFailed, match="1 rows to write, 2 expected"):
        ingest_files(spark, source(inbox), data, AT, ledger=ledger)
    assert rows_of(spark.table(table_name(data)), "id") == [(1,), (2,)]
    monkeypatch.undo()
    assert ingest_files(spark, source(inbox), data, AT, ledger=ledger).records == 2
    assert rows_of(spark.table(table_name(data)), "id") == [(1,), (2,), (3,), (4,)]


def test_files_without_header_are_refused_alone(spark, tmp_path, places):
    data, ledger = places
    inbox = tmp_path / "in"
    inbox.mkdir()
    for n in range(4):
        (inbox / f"{n}.csv").write_text(f"id,amount\n{n},2\n")
    (inbox / "blank.csv").write_text("\n\n\n")
    with gzip.open(inbox / "cut.csv.gz", "wb") as out:
        out.write(b"id,amount\n" + b"7,1\n" * 5000)
    (inbox / "cut.csv.gz").write_bytes((inbox / "cut.csv.gz").read_bytes()[:-15])
    given = source(inbox)
    given["connection"] = {"path": str(inbox), "file_pattern": "*"}
    done = ingest_files(spark, given, data, AT, ledger=ledger, fail_on_error=False)
    assert (done.files_processed, done.files_failed, done.records) == (4, 2, 4)
    assert rows_of(spark.table(table_name(data)), "id") == [(0,), (1,), (2,), (3,)]
    failed = spark.table(table_name(ledger)).filter("status = 'failed'").collect()
    assert sorted(r.file_path.rsplit("/")[-1] for r in failed) == ["blank.csv", "cut.csv.gz"]
