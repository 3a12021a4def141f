"""Excel workbooks as a Spark source: one workbook is parsed inside one task.

Workbooks are listed and opened by Spark's binary reader; a task streams the sheet's XML and
emits batches of string rows, so memory is bounded by the compressed file and its shared
strings. A workbook cannot be split, and the format ends at 1,048,576 rows: parallelism comes
from many files.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from typing import Any
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.shipping import by_value
from stratalake.spec import string_struct

ROWS_PER_BATCH = 10_000

# Fixed values of the workbook format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
RELATION = "{http://schemas.openxmlformats.org/package/2006/relationships}Relationship"
BUILT_IN_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
EPOCH_1900 = datetime(1899, 12, 30)
EPOCH_1904 = datetime(1904, 1, 1)


def scan_excel(
    spark: SparkSession,
    paths: str | list[str],
    options: dict[str, Any] | None = None,
    columns: list[str] | None = None,
    report_errors: bool = False,
) -> DataFrame:
    """Read one sheet of each workbook as strings, with ``_read_error`` and ``source_file``.

    Options: ``sheet_name`` (first sheet), ``header`` (true), ``treat_empty_values_as_nulls``
    (true), ``pathGlobFilter``. ``columns`` names what to read; a workbook that lacks one gives
    null. Without it a first pass collects the headers. Rows without a header are named
    ``_c0, _c1, ...``, or by ``columns`` in order. Dates come as ISO text. An unreadable
    workbook fails the query, or with ``report_errors`` becomes one row holding the reason.
    """
    given = dict(options or {})
    reader = spark.read.format("binaryFile")
    if "pathGlobFilter" in given:
        reader = reader.option("pathGlobFilter", given["pathGlobFilter"])
    files = reader.load(paths).select(F.col("_metadata.file_path").alias("file_path"), "content")
    return parse_workbooks(files, given, columns, report_errors)


def parse_workbooks(
    files: DataFrame,
    options: dict[str, Any],
    columns: list[str] | None = None,
    report_errors: bool = False,
) -> DataFrame:
    """The rows of ``(file_path, content)`` workbooks; see ``scan_excel``."""
    sheet = options.get("sheet_name", options.get("sheetName"))
    header = _flag(options, "header")
    empty_as_null = _flag(options, "treat_empty_values_as_nulls", "treatEmptyValuesAsNulls")
    names = columns or _header_union(files, sheet, header, report_errors)
    fields = [*names, "_read_error", "source_file"]

    def rows(batches: Iterator) -> Iterator:
        import pandas as pd

        for files in batches:
            for path, content in zip(files["file_path"], files["content"]):
                try:
                    for block in _blocks(content, sheet, header, names, columns, empty_as_null):
                        frame = pd.DataFrame(block, columns=names, dtype=object)
                        yield frame.assign(_read_error=None, source_file=path)[fields]
                except Exception as e:
                    if not report_errors:
                        raise ValueError(f"cannot read workbook {path}: {e}") from e
                    failed = dict.fromkeys(names) | {"_read_error": f"{type(e).__name__}: {e}"}
                    yield pd.DataFrame([failed | {"source_file": path}], dtype=object)[fields]

    return files.mapInPandas(by_value(rows), string_struct(fields))


def _flag(options: dict[str, Any], *names: str) -> bool:
    for name in names:
        if name in options:
            return str(options[name]).lower() == "true"
    return True


def _header_union(
    files: DataFrame, sheet: str | None, header: bool, report_errors: bool
) -> list[str]:
    """All column names over all workbooks, those of the first file first."""

    def headers(batches: Iterator) -> Iterator:
        import pandas as pd

        for files in batches:
            for path, content in zip(files["file_path"], files["content"]):
                try:
                    found = [_names(content, sheet, header)]
                    yield pd.DataFrame({"file_path": [path], "header": found})
                except Exception:
                    if not report_errors:
                        raise

    found = files.mapInPandas(by_value(headers), "file_path string, header array<string>")
    found = found.groupBy("header").agg(F.min("file_path").alias("first")).orderBy("first")
    lists = [list(r.header) for r in found.collect()]
    return list(dict.fromkeys(name for names in lists for name in names))


def _names(content: bytes, sheet: str | None, header: bool) -> list[str]:
    for cells in _sheet_rows(content, sheet):
        return _header_names(cells) if header else [f"_c{i}" for i in range(max(cells) + 1)]
    return []


def _header_names(cells: dict[int, str | None]) -> list[str]:
    """One name per column; a header that comes again takes the number of its column."""
    width = max(cells, default=-1) + 1
    names: list[str] = []
    for i in range(width):
        name = cells.get(i) or f"_c{i}"
        while name in names:
            name = f"{name}_{i}"
        names.append(name)
    return names


def _blocks(content, sheet, header, names, columns, empty_as_null) -> Iterator[list[list]]:
    """The sheet's rows in the order of ``names``, in blocks of bounded size."""
    places = None if header else {n: i for i, n in enumerate(names)}
    block: list[list] = []
    for cells in _sheet_rows(content, sheet):
        if places is None:
            places = {n: i for i, n in enumerate(_header_names(cells))}
            continue
        row = [cells.get(places[n]) if n in places else None for n in names]
        if empty_as_null:
            row = [None if value == "" else value for value in row]
        if any(value is not None for value in cells.values()):
            block.append(row)
        if len(block) == ROWS_PER_BATCH:
            yield block
            block = []
    if block:
        yield block


def _sheet_rows(content: bytes, sheet: str | None) -> Iterator[dict[int, str | None]]:
    """Each row of the sheet as ``{column index: text}``."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        part, epoch = _locate(book, sheet)
        shared, date_styles = _shared_strings(book), _date_styles(book)
        with book.open(part) as xml:
            for _, row in ElementTree.iterparse(xml):
                if row.tag != MAIN + "row":
                    continue
                cells, at = {}, -1
                for cell in row.iter(MAIN + "c"):
                    place = cell.get("r")
                    at = _column_index(place) if place else at + 1
                    cells[at] = _cell_text(cell, shared, date_styles, epoch)
                yield cells
                row.clear()


def _locate(book: zipfile.ZipFile, sheet: str | None) -> tuple[str, datetime]:
    """The file of the named sheet, or of the first, and the workbook's day zero."""
    root = ElementTree.fromstring(book.read("xl/workbook.xml"))
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in links.iter(RELATION)}
    settings = root.find(MAIN + "workbookPr")
    from_1904 = settings is not None and settings.get("date1904") in ("1", "true")
    for entry in root.iter(MAIN + "sheet"):
        if sheet is None or entry.get("name") == sheet:
            target = targets[entry.get(RELATION_ID)]
            part = target.lstrip("/") if target.startswith("/") else "xl/" + target
            return part, EPOCH_1904 if from_1904 else EPOCH_1900
    raise ValueError(f"no sheet named {sheet!r}")


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as xml:
        for _, item in ElementTree.iterparse(xml):
            if item.tag == MAIN + "si":
                out.append(_rich_text(item))
                item.clear()
    return out


def _rich_text(item: ElementTree.Element) -> str:
    """The text of a string item, its runs joined, pronunciation hints left out."""
    runs = [item, *item.findall(MAIN + "r")]
    return "".join(run.findtext(MAIN + "t") or "" for run in runs)


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indices of the cell styles that show a number as a date or time."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dated = set(BUILT_IN_DATE_FORMATS)
    for custom in root.iter(MAIN + "numFmt"):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", custom.get("formatCode", ""))
        if re.search(r"[ymdhs]", code, re.IGNORECASE) and "general" not in code.lower():
            dated.add(int(custom.get("numFmtId")))
    styles = root.find(MAIN + "cellXfs")
    listed = [] if styles is None else list(styles)
    return {i for i, style in enumerate(listed) if int(style.get("numFmtId", 0)) in dated}


def _column_index(place: str) -> int:
    index = 0
    for letter in place:
        if not letter.isalpha():
            break
        index = index * 26 + ord(letter.upper()) - 64
    return index - 1


def _cell_text(cell, shared: list[str], date_styles: set[int], epoch: datetime) -> str | None:
    kind, value = cell.get("t", "n"), cell.findtext(MAIN + "v")
    if kind == "inlineStr":
        inline = cell.find(MAIN + "is")
        return None if inline is None else _rich_text(inline)
    if value is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "true" if value.strip() == "1" else "false"
    if kind != "n":
        return value
    number = float(value)
    if int(cell.get("s", 0)) in date_styles:
        return _date_text(number, epoch)
    return str(int(number)) if number.is_integer() and abs(number) < 1e15 else repr(number)


def _date_text(serial: float, epoch: datetime) -> str:
    moment = epoch + timedelta(seconds=round(serial * 86400))
    return f"{moment:%Y-%m-%d}" if serial == int(serial) else f"{moment:%Y-%m-%d %H:%M:%S}"
