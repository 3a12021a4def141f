"""File sources: listing, dated paths, and scans of CSV, JSON, Parquet and workbooks.

Text sources with a declared schema are read as strings and cast afterwards, so reading costs
no inference pass and a value that does not fit can be counted rather than lost. Rows that the
parser rejects keep their text in ``_read_error``.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from datetime import date, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.shipping import by_value
from stratalake.operators.columns import union_by_name
from stratalake.session import FAILURES
from stratalake.sources.workbook import scan_excel
from stratalake.spec import columns_of, string_struct

READ_ERROR = "_read_error"
SOURCE_FILE = "source_file"
UNTYPED = ("csv", "json", "excel")

# The CSV dialect assumed where options do not say otherwise.
CSV_DIALECT = {"header": "true", "delimiter": ",", "quote": '"', "escape": '"'}


def declared_names(schema: dict[str, Any] | list[str]) -> list[str]:
    return list(schema) if isinstance(schema, list) else [c["name"] for c in columns_of(schema)]


def scan_csv(
    spark: SparkSession,
    paths: str | list[str],
    schema: dict[str, Any] | list[str] | None = None,
    options: dict[str, Any] | None = None,
) -> DataFrame:
    """Read CSV: with a schema (or the names in file order) as strings, else by inference.

    A header that differs from the given names fails the read instead of shifting columns;
    files whose headers differ from one another go through ``read_many``.
    """
    given = {**CSV_DIALECT, **(options or {})}
    if schema is None:
        return spark.read.options(**{"inferSchema": "true", **given}).csv(paths)
    strings = string_struct([*declared_names(schema), READ_ERROR])
    checked = {"enforceSchema": "false", "columnNameOfCorruptRecord": READ_ERROR, **given}
    return spark.read.schema(strings).options(**checked).csv(paths)


def scan_json(
    spark: SparkSession,
    paths: str | list[str],
    schema: dict[str, Any] | list[str] | None = None,
    options: dict[str, Any] | None = None,
) -> DataFrame:
    """Read JSON, one object per line; pass ``multiLine`` for files that are one value.

    Lines keep a large file splittable, which a multi-line file is not. Without a schema the
    columns, nested ones included, come from an inference pass. With one, such a pass finds the
    columns that are not declared; they follow the declared ones, as text.
    """
    if schema is None:
        return spark.read.options(**(options or {})).json(paths)
    names = declared_names(schema)
    given = {"columnNameOfCorruptRecord": READ_ERROR, **(options or {})}
    found = spark.read.options(**{"primitivesAsString": "true", **given}).json(paths).columns
    known = {n.lower() for n in [*names, READ_ERROR]}
    for name in found:
        if name.lower() not in known:
            known.add(name.lower())
            names.append(name)
    strings = string_struct([*names, READ_ERROR])
    return spark.read.schema(strings).options(**given).json(paths)


def scan_parquet(
    spark: SparkSession, paths: str | list[str], options: dict[str, Any] | None = None
) -> DataFrame:
    listed = [paths] if isinstance(paths, str) else paths
    return spark.read.options(**(options or {})).parquet(*listed)


def discover_files(
    spark: SparkSession, paths: str | list[str], glob: str | None = None, recursive: bool = False
) -> DataFrame:
    """``(file_path, path, modified_at, length)`` of the files whose name matches.

    ``file_path`` is written as the readers' ``_metadata.file_path`` writes it, the key under
    which rows and ledger name a file; ``path`` is what a reader opens. Contents are not read.
    A path that does not exist is an error; a folder without files gives no rows.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths).select(
        F.col("_metadata.file_path").alias("file_path"),
        "path",
        F.col("modificationTime").alias("modified_at"),
        "length",
    )


def dated_paths(pattern: str, first: date, last: date | None = None) -> list[str]:
    """One path per day of the range, ``{year} {month} {day} {date}`` filled in.

    The days are given, never taken from the clock, so a rerun reads what the first run read.
    """
    days = ((last or first) - first).days
    out = []
    for day in (first + timedelta(n) for n in range(days + 1)):
        out.append(
            pattern.format(
                year=day.year, month=f"{day:%m}", day=f"{day:%d}", date=f"{day:%Y%m%d}"
            )
        )
    return list(dict.fromkeys(out))


def csv_headers(files: DataFrame, options: dict[str, Any] | None = None) -> DataFrame:
    """``(file_path, path, header)``: each listed file's header, read in tasks.

    As for Spark, that is the first record that is neither blank nor a comment, without a
    byte-order mark. A file without a byte has null, one without such a record an empty list.
    """
    given = {**CSV_DIALECT, **(options or {})}
    dialect = {"delimiter": given.get("sep", given["delimiter"]), "quotechar": given["quote"]}
    encoding = given.get("charset", given.get("encoding", "utf-8"))
    if encoding.lower().replace("-", "").replace("_", "") == "utf8":
        encoding = "utf-8-sig"
    comment = given.get("comment") or None

    def header_lines(text: io.TextIOBase) -> Iterator[str]:
        begun = False
        for line in text:
            if not begun and (not line.strip() or (comment and line.startswith(comment))):
                continue
            begun = True
            yield line

    def first_records(batches: Iterator) -> Iterator:
        for listed in batches:
            headers = []
            for path in listed["path"]:
                with open_input(path) as stream:
                    buffered = io.BufferedReader(stream)
                    text = io.TextIOWrapper(buffered, encoding=encoding, newline="")
                    empty = not text.buffer.peek(1)
                    found = next(csv.reader(header_lines(text), **dialect), [])
                    headers.append(None if empty else found)
            yield listed.assign(header=headers)

    listed = files.select("file_path", "path")
    return listed.mapInPandas(
        by_value(first_records), "file_path string, path string, header array<string>"
    )


def open_input(path: str):
    """Open a listed file inside a task, through the file system its scheme names."""
    system, inner = file_system(path)
    return system.open_input_stream(inner)


def file_system(path: str):
    """The file system of a path as Spark writes paths, and the path within it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def read_many(
    spark: SparkSession, source: dict[str, Any], files: DataFrame, report_errors: bool = False
) -> DataFrame:
    """Read all listed files of one source as one DataFrame with their ``source_file``.

    ``source`` holds ``type``, ``schema`` and ``read_options``. Files come in as few scans as
    possible: one, except for CSV files of differing headers, which take one scan per distinct
    header. What the driver holds is the list of paths, as for any file scan. With
    ``report_errors`` an unreadable workbook becomes a row with ``_read_error`` set. Other
    unreadable files always fail the query: Spark's option to skip them would keep the rows
    before the damage and lose the rest without a word.
    """
    kind, schema = source["type"], source.get("schema")
    options = dict(source.get("read_options", {}))
    if kind == "csv":
        return _read_csv_files(spark, files, schema, options)
    paths = [r.path for r in files.select("path").collect()]
    if kind == "json":
        return _with_file(scan_json(spark, paths, schema, options))
    if kind == "parquet":
        return _with_file(scan_parquet(spark, paths, {"mergeSchema": "true", **options}))
    if kind == "excel":
        names = declared_names(schema) if schema else None
        return scan_excel(spark, paths, options, names, report_errors)
    raise ValueError(f"unsupported file format: {kind}")


def _with_file(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def _read_csv_files(spark, files, schema, options) -> DataFrame:
    """One scan per distinct header; a single scan where headers cannot be told apart.

    That is so without a header line, and where tasks cannot open the files' storage from
    Python: the scan then takes the declared names, and a file with another header fails it.
    """
    found = None
    if str(options.get("header", "true")).lower() == "true":
        try:
            found = csv_headers(files, options).collect()
        except FAILURES:
            if schema is None:
                raise
    if found is None:
        paths = [r.path for r in files.select("path").collect()]
        return _with_file(scan_csv(spark, paths, schema, options))
    bare = [r.path for r in found if r.header is not None and not r.header]
    if bare:
        raise ValueError(f"no header in {len(bare)} files, among them {sorted(bare)[:5]}")
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in found:
        groups.setdefault(tuple(r.header or ()), []).append(r.path)
    scans = [
        _with_file(scan_csv(spark, sorted(paths), list(header), options))
        for header, paths in sorted(groups.items())
        if header
    ]
    if not scans:
        names = declared_names(schema or [])
        return spark.createDataFrame([], string_struct([*names, READ_ERROR, SOURCE_FILE]))
    return union_by_name(scans)
