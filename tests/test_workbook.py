"""Workbooks, written here part by part with the standard library."""

import zipfile

import pytest

from stratalake.operators.enforce import enforce_schema
from stratalake.plans.ingest import ingest_files
from stratalake.sources.workbook import scan_excel
from tests.conftest import FAILURES, rows_of
from tests.test_files import AT

SPACE = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
LINK = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACK = "http://schemas.openxmlformats.org/package/2006/relationships"


def write_book(path, sheets, shared=(), formats=(), date1904=False):
    """``sheets``: name to the XML of its rows; ``formats``: number formats of styles 1, 2, ..."""
    with zipfile.ZipFile(path, "w") as book:
        entries = links = ""
        for i, (name, rows) in enumerate(sheets.items(), 1):
            entries += f'<sheet name="{name}" sheetId="{i}" r:id="r{i}"/>'
            links += f'<Relationship Id="r{i}" Type="x" Target="worksheets/sheet{i}.xml"/>'
            xml = f"<worksheet {SPACE}><sheetData>{rows}</sheetData></worksheet>"
            book.writestr(f"xl/worksheets/sheet{i}.xml", xml)
        flag = '<workbookPr date1904="1"/>' if date1904 else ""
        book.writestr(
            "xl/workbook.xml",
            f'<workbook {SPACE} xmlns:r="{LINK}">{flag}<sheets>{entries}</sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PACK}">{links}</Relationships>'
        )
        if shared:
            items = "".join(f"<si>{s}</si>" for s in shared)
            book.writestr("xl/sharedStrings.xml", f"<sst {SPACE}>{items}</sst>")
        if formats:
            custom = "".join(
                f'<numFmt numFmtId="{200 + i}" formatCode="{f}"/>'
                for i, f in enumerate(formats) if isinstance(f, str)
            )
            ids = [0] + [200 + i if isinstance(f, str) else f for i, f in enumerate(formats)]
            styles = "".join(f'<xf numFmtId="{n}"/>' for n in ids)
            book.writestr(
                "xl/styles.xml",
                f"<styleSheet {SPACE}><numFmts>{custom}</numFmts><cellXfs>{styles}</cellXfs>"
                "</styleSheet>",
            )
    return str(path)


def text(place, value):
    return f'<c r="{place}" t="inlineStr"><is><t>{value}</t></is></c>'


HEADER = f'<row>{text("A1", "id")}{text("B1", "name")}{text("C1", "day")}</row>'


def test_every_kind_of_cell(spark, tmp_path):
    rows = (
        '<row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c>'
        '<c r="D1" t="inlineStr"><is><t>flag</t></is></c><c r="AA1" t="str"><v>far</v></c></row>'
        '<row><c r="A2"><v>7</v></c><c r="B2" t="s"><v>3</v></c><c r="C2" s="1"><v>45306</v></c>'
        '<c r="D2" t="b"><v>1</v></c><c r="AA2" t="str"><f>1+1</f><v>2</v></c></row>'
        '<row><c r="A3"><v>0.10000000000000001</v></c><c r="C3" s="2"><v>45306.5</v></c>'
        '<c r="D3" t="b"><v>0</v></c><c r="AA3" t="e"><v>#N/A</v></c></row>'
        '<row><c r="A4"><v>1E3</v></c><c r="B4" t="inlineStr"><is><t></t></is></c>'
        '<c r="C4" s="3"><v>3</v></c></row>'
        '<row><c r="A5" t="inlineStr"><is><t></t></is></c><c r="B5"/></row><row/>'
    )
    shared = ["<t>id</t>", "<t>name</t>", "<t>day</t>", "<r><t>rich </t></r><r><t>text</t></r>"]
    path = write_book(
        tmp_path / "a.xlsx", {"S": rows}, shared, [14, "yyyy\\-mm\\-dd hh:mm", "0.00 &quot;d&quot;"]
    )
    df = scan_excel(spark, path)
    assert df.columns[:4] == ["id", "name", "day", "flag"] and "far" in df.columns
    assert [tuple(r) for r in df.select("id", "name", "day", "flag", "far").collect()] == [
        ("7", "rich text", "2024-01-15", "true", "2"),
        ("0.1", None, "2024-01-15 12:00:00", "false", None),
        ("1000", None, "3", None, None),
        (None, None, None, None, None),
    ]


def test_sheets_by_name_headers_and_columns_by_declaration(spark, tmp_path):
    other = f'<row>{text("A1", "x")}</row><row>{text("A2", "1")}</row>'
    data = HEADER + f'<row>{text("A2", "1")}{text("C2", "d")}</row>'
    path = write_book(tmp_path / "a.xlsx", {"First": other, "Sales Data": data})
    assert rows_of(scan_excel(spark, path), "x") == [("1",)]
    named = {"sheet_name": "Sales Data"}
    df = scan_excel(spark, path, named, ["day", "id", "none"])
    assert rows_of(df, "day", "id", "none") == [("d", "1", None)]
    bare = scan_excel(spark, path, {**named, "header": "false"})
    assert rows_of(bare, "_c0", "_c2") == [("1", "d"), ("id", "day")]
    given = scan_excel(spark, path, {**named, "header": False}, ["p", "q"])
    assert rows_of(given, "p", "q") == [("1", None), ("id", "name")]
    with pytest.raises(FAILURES):
        scan_excel(spark, path, {"sheet_name": "Absent"}, ["id"]).collect()


def test_the_other_calendar_and_empty_text(spark, tmp_path):
    rows = HEADER + f'<row>{text("A2", "")}<c r="C2" s="1"><v>0</v></c></row>'
    path = write_book(tmp_path / "a.xlsx", {"S": rows}, formats=[14], date1904=True)
    assert rows_of(scan_excel(spark, path), "id", "day") == [(None, "1904-01-01")]
    kept = scan_excel(spark, path, {"treat_empty_values_as_nulls": "false"})
    assert rows_of(kept, "id", "day") == [("", "1904-01-01")]


def test_many_workbooks_unite_their_headers(spark, tmp_path):
    write_book(tmp_path / "a.xlsx", {"S": HEADER + f'<row>{text("A2", "1")}</row>'})
    second = f'<row>{text("A1", "name")}{text("B1", "new")}</row><row>{text("B2", "n")}</row>'
    write_book(tmp_path / "b.xlsx", {"S": second})
    (tmp_path / "c.txt").write_text("no workbook")
    df = scan_excel(spark, str(tmp_path), {"pathGlobFilter": "*.xlsx"})
    assert rows_of(df, "id", "name", "new") == [(None, None, "n"), ("1", None, None)]


def test_a_large_sheet_comes_in_batches(spark, tmp_path):
    rows = "".join(f'<row><c r="A{i}"><v>{i}</v></c></row>' for i in range(2, 25_002))
    path = write_book(tmp_path / "a.xlsx", {"S": f'<row>{text("A1", "n")}</row>{rows}'})
    df = enforce_schema(scan_excel(spark, path), {"columns": [{"name": "n", "type": "long"}]})
    assert df.selectExpr("count(*)", "sum(n)").first()[:] == (25_000, sum(range(2, 25_002)))


def test_an_unreadable_workbook_fails_or_reports(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    write_book(inbox / "s_1.xlsx", {"S": HEADER + f'<row>{text("A2", "1")}</row>'})
    (inbox / "s_2.xlsx").write_text("garbage")
    with pytest.raises(FAILURES):
        scan_excel(spark, str(inbox), columns=["id"]).collect()
    df = scan_excel(spark, str(inbox), columns=["id"], report_errors=True)
    failed = df.filter("_read_error IS NOT NULL").first()
    assert df.count() == 2 and "BadZipFile" in failed._read_error
    assert failed.source_file.endswith("s_2.xlsx")

    source = {
        "name": "books", "type": "excel",
        "schema": {"columns": [{"name": "id", "type": "int", "nullable": False}]},
        "connection": {"path": str(inbox), "file_pattern": "s_*.xlsx"},
        "read_options": {"sheet_name": "S"},
    }
    target = {"table": f"books_{abs(hash(str(tmp_path))):x}", "path": str(tmp_path / "data")}
    loaded = ingest_files(spark, source, target, AT, fail_on_error=False)
    assert (loaded.files_processed, loaded.files_failed, loaded.records) == (1, 1, 1)


def test_equal_headers_and_the_order_of_files(spark, tmp_path):
    twice = f'<row>{text("A1", "z")}{text("B1", "a")}{text("C1", "a")}</row>'
    twice += f'<row>{text("A2", "1")}{text("B2", "2")}{text("C2", "3")}</row>'
    write_book(tmp_path / "1.xlsx", {"S": twice})
    write_book(tmp_path / "2.xlsx", {"S": f'<row>{text("A1", "b")}</row><row>{text("A2", "4")}</row>'})
    df = scan_excel(spark, f"file://{tmp_path}")
    assert df.columns[:4] == ["z", "a", "a_2", "b"]
    assert sorted(tuple(r)[:4] for r in df.fillna("").collect()) == [("", "", "", "4"), ("1", "2", "3", "")]
