"""Workbooks, read and written from the archive's XML alone."""

import datetime
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.sources.readers import excel_sheet
from quillspark.sources.workbook import MOST_ROWS, read_sheet, sheet_names, write_workbook

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def made(path, rows, strings="", styles="", prefix="", book="", dimension=""):
    """A workbook of two sheets, the second one with `rows`."""
    x = f"{prefix}:" if prefix else ""
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="r">{book}<sheets><sheet name="First" sheetId="1" r:id="rId1"/><sheet name="Data &amp; more" sheetId="2" r:id="rId2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="rId2" Type="t" Target="/xl/worksheets/two.xml"/><Relationship Id="rId1" Type="t" Target="worksheets/one.xml"/></Relationships>')
        z.writestr("xl/worksheets/one.xml", f'<worksheet xmlns="{MAIN}"><sheetData/></worksheet>')
        z.writestr("xl/worksheets/two.xml", f'<{x}worksheet xmlns{":" + prefix if prefix else ""}="{MAIN}">{dimension}<{x}sheetData>{rows}</{x}sheetData></{x}worksheet>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{strings}</sst>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN}">{styles}</styleSheet>')
    return str(path)


STYLES = '<numFmts count="2"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="0.00&quot;days&quot;"/></numFmts><cellStyleXfs><xf numFmtId="14"/></cellStyleXfs><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/><xf numFmtId="22"/></cellXfs>'


def test_cells_of_every_kind(spark, tmp_path):
    strings = "<si><t>plain &amp; &#228;</t></si><si><r><t>rich </t></r><r><t>text</t></r><rPh sb='0' eb='1'><t>reading</t></rPh></si><si><t/></si><si><t>name</t></si>"
    rows = (
        '<row r="1"><c r="A1" t="inlineStr"><is><t>a title</t></is></c></row>'
        '<row r="2" spans="1:5"><c r="A2" t="s"><v>3</v></c><c r="B2" t="inlineStr"><is><t>day</t></is></c><c r="D2" t="str"><v>name</v></c><c r="E2" t="inlineStr"><is><t> x </t></is></c></row>'
        '<row r="4"><c r="A4" t="s"><v>0</v></c><c r="B4" s="1"><v>45000</v></c><c r="D4" s="3"><v>2.5</v></c><c r="E4" t="e"><v>#N/A</v></c></row>'
        '<row r="5"/><row r="6"><c r="A6" s="2"/><c r="E6" t="s"><v>2</v></c></row>'
        '<row r="7"><c r="A7" t="s"><v>1</v></c><c r="B7" s="4"><v>45000.75</v></c><c r="C7" t="b"><v>1</v></c><c r="D7" s="2"><v>1</v></c><c r="AB7"><v>9</v></c></row>'
        "<row><c><v>1E3</v></c><c><f>A1</f><v>7</v></c><c t='str'><v>_x0041_&lt;</v></c></row>"
    ).replace("t='str'", 't="str"')
    path = made(tmp_path / "kinds.xlsx", rows, strings, STYLES)
    got = read_sheet(spark, path, "Data & more", 1)
    assert got.columns == ["name", "day", "Column3", "name.1", "x"]
    assert [tuple(r) for r in got.collect()] == [("plain & ä", "2023-03-15", None, "2.5", None), ("rich text", "2023-03-15 18:00:00", "true", "1899-12-31", None), ("1E3", "7", "A<", None, None)]
    assert read_sheet(spark, path).columns == [] or read_sheet(spark, path).count() == 0
    with pytest.raises(Exception, match="no sheet"):
        read_sheet(spark, path, "none")


def test_prefixed_tags_and_the_other_epoch(spark, tmp_path):
    rows = '<x:row r="1"><x:c r="A1" t="inlineStr"><x:is><x:t>d</x:t></x:is></x:c></x:row><x:row r="2"><x:c r="A2" s="1"><x:v>0</x:v></x:c></x:row>'
    path = made(tmp_path / "prefix.xlsx", rows, styles=STYLES, prefix="x", book='<workbookPr date1904="1"/>')
    assert [r.d for r in read_sheet(spark, path, "Data & more").collect()] == ["1904-01-01"]


def test_ranges_read_every_row_once(spark, tmp_path):
    """Rows that are missing, without a number, or beyond the stated dimension; partitions of seven rows."""
    cell = lambda k: f'<c t="inlineStr"><is><t>{"long " * 3000 if k % 50 == 0 else ""}{k}</t></is></c>'
    rows = '<row r="1"><c r="A1" t="inlineStr"><is><t>k</t></is></c></row>' + "".join(f'<row r="{k}">{cell(k)}</row>' if k % 3 else f"<row>{cell(k)}</row>" for k in range(2, 400))
    for dimension in ("", '<dimension ref="A1:A300"/>', '<dimension ref="A1:A399"/>'):
        path = made(tmp_path / f"ranges{len(dimension)}{dimension[-5:-3]}.xlsx", rows, dimension=dimension)
        got = read_sheet(spark, path, "Data & more", rows=7)
        assert sorted(int(r.k.split()[-1]) for r in got.collect()) == list(range(2, 400))
        assert (got.rdd.getNumPartitions() > 30) == bool(dimension)


def test_round_trip(spark, tmp_path):
    schema = "name string, n long, x double, d date, t timestamp, b boolean, m decimal(12,2)"
    rows = [("a <&> \"b\" 'c'", 1, 0.1, datetime.date(2024, 2, 29), datetime.datetime(2024, 2, 29, 13, 45, 10), True, None), ("line\nend\ttab\x07 _x0041_ é😀", -5, float("nan"), None, None, False, None), (None, None, None, None, None, None, None), ("  spaces  ", 2**40, 1e-9, datetime.date(1999, 12, 31), None, None, None)]
    df = spark.createDataFrame(rows, schema).coalesce(1)
    many = spark.range(30_000).select("id", F.md5(F.col("id").cast("string")).alias("h"))
    path = str(tmp_path / "out.xlsx")
    write_workbook({"a table with a name of more than 31 characters": df, "many/rows": many, "empty": many.limit(0)}, path)
    kept = T.StructType([f for f in df.schema if f.name != "m"])
    got = excel_sheet(spark, path, "a table with a name of more tha", 0, kept).collect()
    assert [tuple(r)[:6] for r in got] == [tuple(None if v != v else v for v in r[:6]) for r in rows if any(v is not None for v in r)]
    back = read_sheet(spark, path, "many_rows", rows=4000)
    assert back.count() == 30_000 and back.select(F.col("id").cast("long").alias("id"), "h").exceptAll(many).count() == 0
    assert read_sheet(spark, path, "empty").columns == ["id", "h"] and read_sheet(spark, path, "empty").count() == 0


def test_sheet_names_and_sizes(spark, tmp_path):
    assert sheet_names(["a" * 40, "b:c?"]) == ["a" * 31, "b_c_"]
    with pytest.raises(ValueError, match="names of their own"):
        sheet_names(["a" * 31 + "x", "A" * 31])
    with pytest.raises(ValueError, match="a sheet holds"):
        write_workbook({"t": spark.range(MOST_ROWS)}, str(tmp_path / "large.xlsx"))
