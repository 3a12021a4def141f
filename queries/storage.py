"""Sources, sinks, control tables and ingestion, each reading back what it stored."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from datetime import datetime
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.registry import query, table
from stratalake.functions.shipping import by_value
from stratalake.operators.enforce import enforce_schema
from stratalake.operators.quality import quality_results
from stratalake.plans.cursors import ingest_table_overlapping
from stratalake.plans.ingest import IngestFailed, ingest_files, ingest_table
from stratalake.plans.transforms import sql_transform
from stratalake.session import scratch_dir
from stratalake.sinks import control
from stratalake.sinks.tables import (
    ensure_table, load_summary, replace_table_as, table_name, write_files, write_table,
)
from stratalake.sources import files as sources
from stratalake.sources.checksums import file_checksums
from stratalake.sources.incremental import (
    incremental_scan, latest_watermarks, next_watermark, unprocessed_files,
)
from stratalake.sources.workbook import scan_excel
from stratalake.streaming.ingest import ingest_stream, read_file_stream

NOON = datetime(2024, 1, 15, 12)
ORDERS = {
    "columns": [
        {"name": "o_orderkey", "type": "long", "nullable": False},
        {"name": "o_custkey", "type": "long", "nullable": False},
        {"name": "o_totalprice", "type": "double", "constraints": {"min": 0}},
        {"name": "o_orderdate", "type": "timestamp_ntz", "format": "yyyy-MM-dd"},
        {"name": "o_orderpriority", "type": "string", "pattern": "^[1-5]-"},
    ]
}
ORDER_NAMES = [c["name"] for c in ORDERS["columns"]]
ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders"


def target(folder: str, label: str, **more) -> dict:
    """A table of its own per call, stored below the folder."""
    return {"table": f"{label}_{uuid.uuid4().hex}", "path": f"{folder}/{label}", **more}


def orders_for_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", day, "o_orderpriority", "o_orderstatus"
    )


@query("scan_csv", ORDERS_SQL)
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "scan-csv")
    rows = orders_for_files(spark, sf_dir).select(*ORDER_NAMES)
    write_files(rows, folder, "csv", options={"header": "true"})
    text = sources.scan_csv(spark, folder, ORDERS)
    return enforce_schema(text.drop(sources.READ_ERROR), ORDERS)


@query(
    "scan_json",
    """SELECT c_custkey, c_name, c_acctbal, c_mktsegment,
      cast(c_nationkey AS varchar) AS c_nationkey -- not declared: kept, as text
    FROM customer""",
)
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = {
        "columns": [
            {"name": "c_custkey", "type": "bigint"},
            {"name": "c_name"},
            {"name": "c_acctbal", "type": "double"},
            {"name": "c_mktsegment"},
        ]
    }
    folder = scratch_dir(spark, "scan-json")
    write_files(table(spark, sf_dir, "customer"), folder, "json")
    return enforce_schema(
        sources.scan_json(spark, folder, schema).drop(sources.READ_ERROR), schema
    )


@query("scan_parquet", "SELECT p_partkey, p_brand, p_retailprice FROM part")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = sources.scan_parquet(spark, f"{sf_dir}/part.parquet")
    return part.select("p_partkey", "p_brand", "p_retailprice")


def workbook_bytes(names: list[str], rows: list[list]) -> bytes:
    """A minimal workbook, an input for the reader: inline text, plain numbers, one sheet."""

    def cell(value) -> str:
        if isinstance(value, str):
            return f'<c t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        return f"<c><v>{value}</v></c>"

    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    packs = "http://schemas.openxmlformats.org/package/2006/relationships"
    lines = "".join(f"<row>{''.join(map(cell, row))}</row>" for row in [names, *rows])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook {space} xmlns:r="{links}"><sheets>'
            '<sheet name="Customers" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{packs}"><Relationship Id="rId1" Type="{links}/worksheet" '
            'Target="worksheets/sheet1.xml"/></Relationships>',
        )
        book.writestr(
            "xl/worksheets/sheet1.xml",
            f"<worksheet {space}><sheetData>{lines}</sheetData></worksheet>",
        )
    return out.getvalue()


def write_workbooks(df: DataFrame, folder: str) -> None:
    """Store rows as workbooks, one per Arrow batch, named by content so a retry repeats it."""
    names = df.columns

    def store(batches: Iterator) -> Iterator:
        import hashlib

        system, root = sources.file_system(folder)
        system.create_dir(root, recursive=True)
        for rows in batches:
            content = workbook_bytes(names, rows.values.tolist())
            name = hashlib.sha256(rows.to_csv().encode()).hexdigest()[:32]
            with system.open_output_stream(f"{root}/{name}.xlsx") as out:
                out.write(content)
            yield rows.iloc[:0]

    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    df.mapInPandas(by_value(store), df.schema).write.format("noop").mode("overwrite").save()


@query("scan_excel", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def scan_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = {
        "columns": [
            {"name": "c_custkey", "type": "bigint"},
            {"name": "c_name"},
            {"name": "c_acctbal", "type": "double"},
            {"name": "c_mktsegment"},
        ]
    }
    names = sources.declared_names(schema)
    folder = scratch_dir(spark, "scan-excel")
    write_workbooks(table(spark, sf_dir, "customer").select(*names), folder)
    options = {"sheet_name": "Customers", "pathGlobFilter": "*.xlsx"}
    text = scan_excel(spark, folder, options, names)
    return enforce_schema(text.select(*names), schema)


@query(
    "discover_files",
    """SELECT o_orderstatus AS status, cast(1 AS bigint) AS files, true AS sized
    FROM orders GROUP BY 1""",
)
def discover_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files listed by name pattern, without reading them: one of two kinds, one file a status."""
    folder = scratch_dir(spark, "discover")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for kind in ("parquet", "json"):
        one_each = orders.repartition("o_orderstatus")
        one_each.write.mode("append").partitionBy("o_orderstatus").format(kind).save(folder)
    listed = sources.discover_files(spark, folder, "*.parquet", recursive=True)
    status = F.regexp_extract("file_path", "o_orderstatus=([^/]*)/", 1)
    return listed.groupBy(status.alias("status")).agg(
        F.count(F.lit(1)).alias("files"), F.every(F.col("length") > 0).alias("sized")
    )


@query(
    "incremental_files",
    """SELECT 'crawl/' || d.source || '/' || d.doc_id AS file_path, d.n_chars AS length
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id AND l.quality = 1
    WHERE l.doc_id IS NULL""",
)
def incremental_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files, labels as the ledger: only a success counts as processed."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    path = F.concat_ws("/", F.lit("crawl"), "source", "doc_id").alias("file_path")
    files = documents.select(path, F.col("n_chars").alias("length"))
    ledger = documents.join(labels, "doc_id").select(
        path,
        F.lit("crawl").alias("source_name"),
        F.when(F.col("quality") == 1, "success").otherwise("failed").alias("status"),
    )
    return unprocessed_files(files, ledger, "crawl").select("file_path", "length")


@query(
    "incremental_watermark",
    """SELECT o_orderkey, o_totalprice, o_orderdate,
      (SELECT cast(max(o_orderdate) AS varchar) FROM orders
       WHERE o_orderdate > timestamp '1998-06-15') AS next_value
    FROM orders WHERE o_orderdate > timestamp '1998-06-15'""",
)
def incremental_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    new = incremental_scan(orders, "o_orderdate", "1998-06-15 00:00:00")
    value = next_watermark(new, "o_orderdate").scalar()
    return new.select("o_orderkey", "o_totalprice", "o_orderdate", value.alias("next_value"))


def write_split_orders(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Two folders of CSV files: the second with columns in another order and one more."""
    orders, options = orders_for_files(spark, sf_dir), {"header": "true"}
    old = orders.filter("o_orderstatus = 'F'").drop("o_orderstatus")
    new = orders.filter("o_orderstatus <> 'F'").select(*reversed(orders.columns))
    write_files(old, folder, "csv", "append", options)
    write_files(new, folder, "csv", "append", options)


@query(
    "read_many",
    f"""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority,
      CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS o_orderstatus
      FROM orders""",
)
def read_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "read-many")
    write_split_orders(spark, sf_dir, folder)
    listed = sources.discover_files(spark, folder, "*.csv")
    text = sources.read_many(spark, {"type": "csv", "schema": ORDERS}, listed)
    return enforce_schema(text, ORDERS).select(*ORDER_NAMES, "o_orderstatus")


@query(
    "write_table_roundtrip",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem",
)
def write_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to a partitioned table, the second with its columns in another order."""
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"]
    lines = table(spark, sf_dir, "lineitem").select(*columns)
    place = target(
        scratch_dir(spark, "table"), "lines", partition_columns=["l_returnflag", "l_linestatus"]
    )
    write_table(lines.filter("l_quantity <= 25"), place)
    write_table(lines.filter("l_quantity > 25").select(*reversed(columns)), place)
    return spark.table(table_name(place)).select(*columns)


@query(
    "ensure_table",
    """SELECT s_suppkey, s_name, s_acctbal, cast(NULL AS varchar) AS s_phone FROM supplier""",
)
def ensured_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made from its specification, then filled; a second call finds it there."""
    place = target(
        scratch_dir(spark, "ensure"),
        "suppliers",
        columns=[
            {"name": "s_suppkey", "type": "long", "nullable": False, "comment": "supplier's key"},
            {"name": "s_name", "type": "string"},
            {"name": "s_acctbal", "type": "double"},
            {"name": "s_phone", "type": "string"},
        ],
        table_properties={"layer": "raw"},
    )
    ensure_table(spark, place)
    write_table(table(spark, sf_dir, "supplier").select("s_acctbal", "s_suppkey", "s_name"), place)
    return spark.table(ensure_table(spark, place))


@query(
    "write_files_roundtrip",
    """SELECT f.format, p_partkey, p_name, p_retailprice FROM part,
       (VALUES ('parquet'), ('csv'), ('json')) AS f(format)""",
)
def write_files_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    folder = scratch_dir(spark, "files")
    out = None
    for kind in ("parquet", "csv", "json"):
        write_files(part, f"{folder}/{kind}", kind, options={"header": "true"})
        reader = spark.read.schema(part.schema).option("header", "true").format(kind)
        rows = reader.load(f"{folder}/{kind}").select(F.lit(kind).alias("format"), *part.columns)
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "silver_sql_transform",
    """SELECT c_custkey AS customer_id, upper(trim(c_name)) AS customer_name,
      coalesce(CASE WHEN c_acctbal >= 0 THEN c_mktsegment END, 'unknown@email.com') AS email,
      timestamp '2024-01-15 12:00:00' AS processed_at FROM customer WHERE c_custkey IS NOT NULL""",
)
def silver_sql_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL text over a named input with a bound parameter, stored by replacing a table."""
    text = """SELECT c_custkey AS customer_id, UPPER(TRIM(c_name)) AS customer_name,
        COALESCE(CASE WHEN c_acctbal >= 0 THEN c_mktsegment END, :unknown) AS email,
        CAST(:at AS TIMESTAMP_NTZ) AS processed_at
        FROM {source_table} WHERE c_custkey IS NOT NULL"""
    args = {"unknown": "unknown@email.com", "at": "2024-01-15 12:00:00"}
    source = table(spark, sf_dir, "customer")
    rows = sql_transform(spark, text, args, source_table=source)
    place = target(scratch_dir(spark, "silver"), "customers")
    replace_table_as(rows, place)
    replace_table_as(rows, place)
    return spark.table(table_name(place))


@query(
    "processed_files_ledger",
    """WITH files AS (
      SELECT DISTINCT 'crawl/' || source || '/' || lang AS file_path FROM documents
      UNION SELECT DISTINCT 'crawl/' || source || '/none' FROM documents),
    counts AS (SELECT 'crawl/' || source || '/' || lang AS file_path, count(*) AS n
               FROM documents GROUP BY 1)
    SELECT file_path, 'crawl' AS source_name, coalesce(n, 0) AS record_count,
           'success' AS status, 'b7' AS batch_id, 'dev' AS environment,
           timestamp '2024-01-15 12:00:00' AS processed_timestamp
    FROM files LEFT JOIN counts USING (file_path)""",
)
def processed_files_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows counted from the data, written to the control table and read back."""
    path = F.concat_ws("/", F.lit("crawl"), "source", "lang")
    data = table(spark, sf_dir, "documents").withColumn("source_file", path)
    listed = data.select(F.col("source_file").alias("file_path")).unionAll(
        data.select(F.concat_ws("/", F.lit("crawl"), "source", F.lit("none")))
    ).distinct()
    counted = control.rows_per_file(data, listed)
    at = F.lit("2024-01-15 12:00:00").cast("timestamp")
    rows = control.processed_file_rows(counted, "crawl", "b7", at, environment="dev")
    place = target(scratch_dir(spark, "ledger"), "processed_files", **control.PROCESSED_FILES)
    ensure_table(spark, place)
    write_table(rows, place)
    return spark.table(table_name(place)).select(
        "file_path", "source_name", "record_count", "status", "batch_id", "environment",
        F.col("processed_timestamp").cast("timestamp_ntz").alias("processed_timestamp"),
    )


@query(
    "watermark_latest",
    """SELECT 'erp' AS source_name, 'orders_' || o_orderstatus AS table_name,
      'o_orderdate' AS watermark_column, cast(max(o_orderdate) AS varchar) AS watermark_value
    FROM orders GROUP BY o_orderstatus""",
)
def watermark_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored cursor value per table and year; the newest of each table is the watermark."""
    orders = table(spark, sf_dir, "orders")
    advanced = orders.groupBy("o_orderstatus", F.year("o_orderdate").alias("y")).agg(
        F.max("o_orderdate").cast("string").alias("watermark_value")
    )
    place = target(scratch_dir(spark, "watermarks"), "watermarks", **control.WATERMARKS)
    ensure_table(spark, place)
    at = F.make_timestamp("y", F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0))
    name = F.concat(F.lit("orders_"), "o_orderstatus")
    write_table(control.watermark_row(advanced, "erp", name, "o_orderdate", at), place)
    return latest_watermarks(spark.table(table_name(place))).drop("last_updated")


@query(
    "quality_results_table",
    """WITH c AS (SELECT count(*) AS n, count(*) FILTER (l_quantity < 5) AS low,
      count(*) FILTER (l_shipdate IS NULL) AS nodate FROM lineitem)
    SELECT sha256('b7|lineitem|' || check_name) AS check_id, 'lineitem' AS table_name, check_type,
      check_name, CASE WHEN failed = 0 THEN 'passed' ELSE 'failed' END AS status,
      n AS records_checked, failed AS records_failed, 'b7' AS batch_id FROM (
        SELECT 'range_check' AS check_type, 'range_check:l_quantity' AS check_name, low AS failed, n
        FROM c UNION ALL SELECT 'null_check', 'null_check:l_shipdate', nodate, n FROM c)""",
)
def quality_results_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        {"type": "range_check", "column": "l_quantity", "min": 5},
        {"type": "null_check", "columns": ["l_shipdate"]},
    ]
    results = quality_results(table(spark, sf_dir, "lineitem"), checks)
    place = target(scratch_dir(spark, "quality"), "quality", **control.QUALITY_RESULTS)
    ensure_table(spark, place)
    write_table(control.quality_rows(results, "lineitem", "b7", NOON, "dev"), place)
    return spark.table(table_name(place)).select(
        "check_id", "table_name", "check_type", "check_name", "status", "records_checked",
        "records_failed", "batch_id",
    )


@query(
    "load_summary",
    """SELECT 'success' AS status, 'parquet' AS source_type, 'orders' AS source_name,
       (SELECT count(*) FROM orders) AS records_processed, 'dev' AS environment""",
)
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of rows as the write itself counted them."""
    place = target(scratch_dir(spark, "summary"), "orders")
    written = write_table(table(spark, sf_dir, "orders"), place)
    row = load_summary(
        spark, "parquet", "orders", place, NOON, datetime(2024, 1, 15, 12, 1), written,
        environment="dev",
    )
    return row.select("status", "source_type", "source_name", "records_processed", "environment")


@query(
    "bronze_ingest",
    f"""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority,
      CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
      'orders_csv' AS source_system, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS run
      FROM orders""",
)
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive between runs load once, whatever their header; a third run adds nothing."""
    folder = scratch_dir(spark, "bronze")
    inbox, options = f"{folder}/inbox", {"header": "true"}
    orders = orders_for_files(spark, sf_dir)
    source = {
        "name": "orders_csv",
        "type": "csv",
        "connection": {"path": inbox, "file_pattern": "*.csv"},
        "schema": ORDERS,
        "ingestion": {"mode": "incremental"},
    }
    place = target(folder, "orders", partition_columns=["o_orderpriority"])
    ledger = target(folder, "processed_files")
    arrivals = [
        orders.filter("o_orderstatus = 'F'").drop("o_orderstatus"),
        orders.filter("o_orderstatus <> 'F'").select(*reversed(orders.columns)),
    ]
    batches = {}
    for run, rows in enumerate(arrivals, start=1):
        write_files(rows, inbox, "csv", "append", options)
        loaded = ingest_files(spark, source, place, NOON, ledger=ledger)
        batches[loaded.batch_id] = run
    ingest_files(spark, source, place, NOON, ledger=ledger)
    run = F.create_map(*[F.lit(x) for pair in batches.items() for x in pair])[F.col("batch_id")]
    return spark.table(table_name(place)).select(
        *ORDER_NAMES, "o_orderstatus", "source_system", run.alias("run")
    )


@query(
    "bronze_ingest_lenient",
    f"""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority,
      o_orderstatus, 'orders_csv' AS source_system, 2 AS refused FROM orders""",
)
def bronze_ingest_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file without header and one with a wrong value among the others: these load, twice tried."""
    folder = scratch_dir(spark, "bronze-lenient")
    inbox, options = f"{folder}/inbox", {"header": "true"}
    orders = orders_for_files(spark, sf_dir)
    source = {
        "name": "orders_csv",
        "type": "csv",
        "connection": {"path": inbox, "file_pattern": "part-*"},
        "schema": ORDERS,
        "ingestion": {"mode": "incremental"},
    }
    wrong = orders.limit(10).coalesce(1).withColumn("o_orderkey", F.lit("none"))
    blank = orders.limit(3).coalesce(1).select(F.lit("").alias("value"))
    write_files(orders, inbox, "csv", "append", options)
    write_files(wrong, inbox, "csv", "append", options)
    blank.write.mode("append").text(inbox)
    place = target(folder, "orders")
    ledger = target(folder, "processed_files")
    for _ in range(2):
        try:
            ingest_files(spark, source, place, NOON, ledger=ledger, fail_on_error=False)
        except IngestFailed:  # the second run is offered the refused files only
            pass
    failed = spark.table(table_name({**ledger})).filter("status = 'failed'")
    refused = failed.agg(F.countDistinct("file_path").cast("int").alias("refused")).scalar()
    return spark.table(table_name(place)).select(
        *ORDER_NAMES, "o_orderstatus", "source_system", refused.alias("refused")
    )


@query(
    "stream_ingest_files",
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, "
    "'orders_stream' AS source_system FROM orders",
)
def stream_ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files stream in as they arrive, each once, whatever their header: two arrivals, three runs."""
    folder = scratch_dir(spark, "stream-ingest")
    inbox = f"{folder}/inbox"
    source = {"name": "orders_stream", "type": "csv", "schema": ORDERS}
    orders = orders_for_files(spark, sf_dir)
    arrivals = [
        orders.filter("o_totalprice < 200000").select(*ORDER_NAMES),
        orders.filter("o_totalprice >= 200000").select(*reversed(orders.columns)),
        None,
    ]
    for rows in arrivals:
        if rows:
            write_files(rows, inbox, "csv", "append", {"header": "true"})
        stream = read_file_stream(spark, source, inbox)
        ingest_stream(
            stream, source, f"{folder}/orders", f"{folder}/checkpoint", NOON
        ).awaitTermination()
    stored = spark.read.parquet(f"{folder}/orders")
    return stored.select(*ORDER_NAMES, "source_system")


@query(
    "incremental_table_load",
    """SELECT o_orderkey, o_totalprice, o_orderdate, 'erp' AS source_system,
      CASE WHEN o_orderdate < timestamp '1998-01-01' THEN 1 ELSE 2 END AS run FROM orders""",
)
def incremental_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source table that grows between two runs, loaded by its stored cursor."""
    folder = scratch_dir(spark, "table-load")
    place, marks = target(folder, "orders"), target(folder, "watermarks")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    batches = {}
    for run, rows in enumerate([orders.filter("o_orderdate < '1998-01-01'"), orders, orders], 1):
        loaded = ingest_table(
            spark, rows, "erp", "orders", place, NOON, cursor="o_orderdate", watermarks=marks
        )
        batches.setdefault(loaded.batch_id, run)
    known = [F.lit(x) for pair in batches.items() if pair[0] for x in pair]
    return spark.table(table_name(place)).select(
        *orders.columns, "source_system", F.create_map(*known)[F.col("batch_id")].alias("run")
    )


@query(
    "incremental_table_load_late",
    """WITH monthly AS (
      SELECT o_orderkey, o_totalprice,
        CASE WHEN o_orderkey % 50 <> 0 THEN cast(date_trunc('month', o_orderdate) AS date) END AS month
      FROM orders),
    runs AS (
      SELECT *, CASE WHEN month < date '1997-12-01' OR month = date '1997-12-01' AND o_orderkey % 2 = 0
          OR month IS NULL AND o_orderkey % 100 <> 0 THEN 1 ELSE 2 END AS run,
        coalesce(month <= date '1997-12-01', true) AS early FROM monthly)
    SELECT o_orderkey, o_totalprice, month, run,
      count(*) FILTER (run = 2 AND early) OVER () AS late FROM runs""",
)
def incremental_table_load_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that come after a run with the cursor value it reached, or without one, are loaded once."""
    folder = scratch_dir(spark, "late-load")
    place, marks = target(folder, "orders"), target(folder, "watermarks")
    state = target(folder, "load_state")
    month = F.trunc("o_orderdate", "month").cast("date")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.when(F.col("o_orderkey") % 50 != 0, month).alias("month")
    )
    first = orders.filter(
        "month < '1997-12-01' OR month = '1997-12-01' AND o_orderkey % 2 = 0"
        " OR month IS NULL AND o_orderkey % 100 <> 0"
    )
    batches, late = {}, 0
    for run, rows in enumerate([first, orders, orders], 1):
        loaded = ingest_table_overlapping(
            spark, rows, "erp", "orders", place, NOON, "month", marks, state, keys=["o_orderkey"]
        )
        batches.setdefault(loaded.batch_id, run)
        late += loaded.late
    known = [F.lit(x) for pair in batches.items() if pair[0] for x in pair]
    return spark.table(table_name(place)).select(
        *orders.columns,
        F.create_map(*known)[F.col("batch_id")].alias("run"),
        F.lit(late).cast("bigint").alias("late"),
    )


@query(
    "file_checksums",
    """WITH files AS (
      SELECT o_orderkey // 5000 AS bucket, string_agg(lpad(cast(o_orderkey AS varchar), 10, '0')
        || '|' || o_orderpriority || chr(10), '' ORDER BY o_orderkey) AS content
      FROM orders GROUP BY 1),
    ranges AS (
      SELECT bucket, content, unnest(range(0, (length(content) - 1) // 4096 + 1)) AS slot FROM files),
    leaves AS (
      SELECT bucket, slot, sha256(substr(content, slot * 4096 + 1, 4096)) AS digest FROM ranges),
    first AS (
      SELECT bucket, slot // 4 AS slot, CASE WHEN count(*) = 1 THEN min(digest)
        ELSE sha256(string_agg(digest, '' ORDER BY slot)) END AS digest FROM leaves GROUP BY 1, 2),
    second AS (
      SELECT bucket, slot // 4 AS slot, CASE WHEN count(*) = 1 THEN min(digest)
        ELSE sha256(string_agg(digest, '' ORDER BY slot)) END AS digest FROM first GROUP BY 1, 2),
    roots AS (
      SELECT bucket, CASE WHEN count(*) = 1 THEN min(digest)
        ELSE sha256(string_agg(digest, '' ORDER BY slot)) END AS checksum FROM second GROUP BY 1)
    SELECT bucket, cast(length(content) AS bigint) AS n_bytes, checksum
    FROM files JOIN roots USING (bucket)""",
)
def checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of written files, each cut into ranges that different tasks read."""
    folder = scratch_dir(spark, "checksums")
    key = F.lpad(F.col("o_orderkey").cast("string"), 10, "0")
    lines = table(spark, sf_dir, "orders").select(
        F.floor(F.col("o_orderkey") / 5000).alias("bucket"),
        F.concat(key, F.lit("|"), "o_orderpriority").alias("line"),
    )
    lines.repartition("bucket").sortWithinPartitions("bucket", "line").write.partitionBy(
        "bucket"
    ).text(folder)
    files = sources.discover_files(spark, folder, "part-*", recursive=True)
    bucket = F.regexp_extract("file_path", r"bucket=(\d+)/", 1).cast("long")
    return file_checksums(spark, files, range_bytes=4096, fanout=4).join(files, "file_path").select(
        bucket.alias("bucket"), F.col("length").alias("n_bytes"), "checksum"
    )
