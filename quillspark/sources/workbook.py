"""Workbooks (xlsx) as a data source and a sink, from the zip archive and its XML alone.

A sheet is read by ranges of rows, a partition each: a task inflates the sheet as a stream, passes over rows before its
range by their tags and parses only its own. Cells come as strings: numbers as written, dates in ISO form where the
cell's style shows a date, errors and empty cells as null; rows without a value are left out.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator, Mapping
from datetime import datetime, timedelta
from typing import IO, Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quillspark.sources.files import created, opened

#: Fixed values of the format: rows of a sheet and characters of its name at most, and characters that no name has.
MOST_ROWS, NAME_CHARS, NOT_IN_NAMES = 1_048_576, 31, r"[\[\]:*?/\\]"
#: The built-in number formats that show dates.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
#: Rows of a partition, unless an option says otherwise.
RANGE_ROWS = 50_000

_ROW = re.compile(rb"<(?:\w+:)?row\b[^>]*?(/?)>")
_ROW_NUMBER = re.compile(rb'\sr="(\d+)"')
_ROW_END = re.compile(rb"</(?:\w+:)?row>")
_CELL = re.compile(r"<(?:\w+:)?c\b([^>]*?)(?:/>|>(.*?)</(?:\w+:)?c>)", re.DOTALL)
_ATTRIBUTE = re.compile(r'([\w:]+)="([^"]*)"')
_VALUE = re.compile(r"<(?:\w+:)?v\b[^>]*>(.*?)</(?:\w+:)?v>", re.DOTALL)
_TEXT = re.compile(r"<(?:\w+:)?t\b[^>]*?(?:/>|>(.*?)</(?:\w+:)?t>)", re.DOTALL)
_PHONETIC = re.compile(r"<(?:\w+:)?rPh\b.*?</(?:\w+:)?rPh>", re.DOTALL)
_STRING = re.compile(r"<(?:\w+:)?si\b[^>]*?(?:/>|>(.*?)</(?:\w+:)?si>)", re.DOTALL)
_ENTITY = re.compile(r"&(#x?[0-9A-Fa-f]+|amp|lt|gt|quot|apos);")
_ESCAPED = re.compile(r"_x([0-9A-Fa-f]{4})_")
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def _plain(s: str) -> str:
    """Text of the XML with its references and the format's own escapes resolved."""
    def entity(m: re.Match) -> str:
        name = m[1]
        return _NAMED.get(name) or chr(int(name[2:], 16) if name[1] in "xX" else int(name[1:]))

    return _ESCAPED.sub(lambda m: chr(int(m[1], 16)), _ENTITY.sub(entity, s))


def _runs(xml: str) -> str:
    """The text of a string item: its runs one after another, without readings of characters."""
    return "".join(_plain(m[1] or "") for m in _TEXT.finditer(_PHONETIC.sub("", xml)))


class Workbook:
    """An open workbook: its sheets, its shared strings and which styles show dates."""

    def __init__(self, file: IO[bytes]) -> None:
        self.archive = zipfile.ZipFile(file)
        self.names = set(self.archive.namelist())
        book = self._part("xl/workbook.xml")
        targets = {a["Id"]: a["Target"] for a in self._tags(self._part("xl/_rels/workbook.xml.rels"), "Relationship")}
        self.sheets = {}
        for a in self._tags(book, "sheet"):
            target = targets[next(v for k, v in a.items() if k.endswith(":id") or k == "id")]
            self.sheets[_plain(a["name"])] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        since_1904 = any(a.get("date1904") in ("1", "true") for a in self._tags(book, "workbookPr"))
        self.epoch = datetime(1904, 1, 1) if since_1904 else datetime(1899, 12, 30)
        self.dates = self._date_styles()
        self._strings: list[str] | None = None

    def _part(self, name: str) -> str:
        return self.archive.read(name).decode("utf-8") if name in self.names else ""

    @staticmethod
    def _tags(xml: str, name: str) -> list[dict[str, str]]:
        return [dict(_ATTRIBUTE.findall(m[1])) for m in re.finditer(rf"<(?:\w+:)?{name}\b([^>]*)>", xml)]

    def _date_styles(self) -> set[int]:
        xml = self._part("xl/styles.xml")
        shows = {int(a["numFmtId"]): a.get("formatCode", "") for a in self._tags(xml, "numFmt")}
        bare = lambda code: re.sub(r'"[^"]*"|\[[^\]]*\]|\\.|_.|\*.', "", _plain(code))
        dated = DATE_FORMATS | {k for k, code in shows.items() if re.search("[ymdhs]", bare(code), re.IGNORECASE)}
        styles = re.search(r"<(?:\w+:)?cellXfs\b.*?</(?:\w+:)?cellXfs>", xml, re.DOTALL)
        return {k for k, a in enumerate(self._tags(styles[0], "xf")) if int(a.get("numFmtId", 0)) in dated} if styles else set()

    @property
    def strings(self) -> list[str]:
        if self._strings is None:
            self._strings = [_runs(m[1] or "") for m in _STRING.finditer(self._part("xl/sharedStrings.xml"))]
        return self._strings

    def sheet(self, name: str | None) -> str:
        """The archive's part of a sheet, the first one if none is named."""
        if name is None:
            return next(iter(self.sheets.values()))
        if name not in self.sheets:
            raise KeyError(f"no sheet {name}; there are {', '.join(self.sheets)}")
        return self.sheets[name]

    def last_row(self, part: str) -> int | None:
        """The last row by the sheet's own statement, if it makes one."""
        with self.archive.open(part) as f:
            m = re.search(rb'<(?:\w+:)?dimension\b[^>]*ref="[A-Z]+\d+:[A-Z]+(\d+)"', f.read(4096))
        return int(m[1]) if m else None

    def rows(self, part: str, first: int, last: int | None) -> Iterator[tuple[int, list[str | None]]]:
        """(number from 1, cells) of the rows `first` to `last` that the sheet holds, read as a stream."""
        with self.archive.open(part) as f:
            held, number, at = b"", 0, 0
            while True:
                tag = _ROW.search(held, at)
                end = None
                if tag and not tag[1]:
                    end = _ROW_END.search(held, tag.end())
                if tag and (tag[1] or end):
                    own = _ROW_NUMBER.search(tag[0])
                    number = int(own[1]) if own else number + 1
                    if last is not None and number > last:
                        return
                    if number >= first:
                        yield number, self._cells(held[tag.end() : end.start()].decode("utf-8")) if end else []
                    at = end.end() if end else tag.end()
                    continue
                more = f.read(1 << 18)
                if not more:
                    return
                # What stands before an unfinished tag isn't needed again.
                held, at = held[tag.start() if tag else max(at, len(held) - 4096) :] + more, 0

    def _cells(self, xml: str) -> list[str | None]:
        out: list[str | None] = []
        for m in _CELL.finditer(xml):
            a = dict(_ATTRIBUTE.findall(m[1]))
            place = len(out)
            if "r" in a:
                place = 0
                for c in a["r"].rstrip("0123456789"):
                    place = place * 26 + ord(c) - 64
                place -= 1
            out += [None] * (place - len(out))
            out.append(self._value(a.get("t", "n"), int(a.get("s", 0)), m[2] or ""))
        return out

    def _value(self, kind: str, style: int, xml: str) -> str | None:
        if kind == "inlineStr":
            return _runs(xml) or None
        m = _VALUE.search(xml)
        if not m or kind == "e":
            return None
        if kind == "s":
            return self.strings[int(m[1])] or None
        if kind == "b":
            return "true" if m[1] == "1" else "false"
        if kind == "n" and style in self.dates:
            # Serial days are given to the second: their fractions aren't exact.
            day = self.epoch + timedelta(seconds=round(float(m[1]) * 86400))
            return day.strftime("%Y-%m-%d") if day.time() == datetime.min.time() else day.strftime("%Y-%m-%d %H:%M:%S")
        return _plain(m[1]) or None


def header_names(cells: list[str | None]) -> list[str]:
    """Column names of a header row: trimmed, Column<k> where there is none, a number after those that repeat."""
    out: list[str] = []
    taken: set[str] = set()
    for k, c in enumerate(cells, 1):
        base = (c or "").strip() or f"Column{k}"
        name, n = base, 0
        while name.lower() in taken:
            n += 1
            name = f"{base}.{n}"
        taken.add(name.lower())
        out.append(name)
    return out


class RowRange(InputPartition):
    def __init__(self, first: int, last: int | None) -> None:
        super().__init__((first, last))
        self.first, self.last = first, last


class WorkbookSource(DataSource):
    """Format "workbook". Options: path, sheet (its name; else the first), header (index of the header row, from 0), rows (of a partition)."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def _header(self) -> int:
        return int(self.options.get("header", 0)) + 1

    def schema(self) -> T.StructType:
        with opened(self.options["path"]) as f:
            book = Workbook(f)
            row = self._header()
            cells = next((cells for number, cells in book.rows(book.sheet(self.options.get("sheet")), row, row)), [])
        return T.StructType([T.StructField(n, T.StringType()) for n in header_names(cells)])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return WorkbookReader(dict(self.options), schema, self._header())


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType, header: int) -> None:
        self.path, self.sheet, self.size = options["path"], options.get("sheet"), int(options.get("rows", RANGE_ROWS))
        self.columns, self.header = [f.name for f in schema], header

    def partitions(self) -> list[InputPartition]:
        with opened(self.path) as f:
            book = Workbook(f)
            last = book.last_row(book.sheet(self.sheet))
        starts = range(self.header + 1, (last or self.header) + 1, self.size)
        # The last range is open, as a sheet may hold more rows than it states.
        return [RowRange(a, a + self.size - 1 if a + self.size in starts else None) for a in starts] or [RowRange(self.header + 1, None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        width = len(self.columns)
        schema = pa.schema([(c, pa.string()) for c in self.columns])
        held: list[list[str | None]] = []
        with opened(self.path) as f:
            book = Workbook(f)
            for _, cells in book.rows(book.sheet(self.sheet), partition.first, partition.last):
                row = (cells + [None] * width)[:width]
                if any(c is not None for c in row):
                    held.append(row)
                if len(held) >= 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], schema=schema)
                    held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*held, strict=True)], schema=schema)


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None, header: int = 0, rows: int = RANGE_ROWS) -> DataFrame:
    """A sheet with the names of its header row; all cells are strings (schema.coerce gives them types)."""
    spark.dataSource.register(WorkbookSource)
    options: dict[str, Any] = {"header": header, "rows": rows} | ({"sheet": sheet} if sheet else {})
    return spark.read.format("workbook").options(**options).load(path)


def sheet_names(names: list[str]) -> list[str]:
    """The names that sheets get: cut to 31 characters, without those that no name may have. Names that meet are an error."""
    out = [re.sub(NOT_IN_NAMES, "_", n)[:NAME_CHARS] for n in names]
    if len({n.lower() for n in out}) < len(out) or not all(out):
        raise ValueError(f"sheets need names of their own: {', '.join(out)}")
    return out


def _escaped(c: Column) -> Column:
    """Text as XML holds it; characters that XML can't hold are written in the format's own escape."""
    t = F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    t = F.regexp_replace(t, "_(?=x[0-9A-Fa-f]{4}_)", "_x005F_")
    for k in (*range(9), 11, 12, *range(13, 32), 0xFFFE, 0xFFFF):
        t = F.replace(t, F.lit(chr(k)), F.lit(f"_x{k:04X}_"))
    return t


def _cell(name: str, kind: T.DataType) -> Column:
    c = F.col(f"`{name}`")
    number = lambda x, style="": F.concat(F.lit(f"<c{style}><v>"), x.cast("string"), F.lit("</v></c>"))
    if isinstance(kind, T.BooleanType):
        shown = F.concat(F.lit('<c t="b"><v>'), c.cast("int").cast("string"), F.lit("</v></c>"))
    elif isinstance(kind, T.DateType):
        shown = number(F.date_diff(c, F.lit("1899-12-30").cast("date")), ' s="1"')
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        since = F.lit("1899-12-30").cast("date")
        seconds = F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
        shown = number(F.date_diff(c.cast("date"), since) + seconds / 86400.0, ' s="2"')
    elif isinstance(kind, T.NumericType):
        finite = c if isinstance(kind, (T.IntegralType, T.DecimalType)) else F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)
        shown = number(finite)
    else:
        shown = F.concat(F.lit('<c t="inlineStr"><is><t xml:space="preserve">'), _escaped(c.cast("string")), F.lit("</t></is></c>"))
    return F.coalesce(shown, F.lit("<c/>"))


_SHEET_HEAD = '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><dimension ref="A1:{corner}"/><sheetData>'
_STYLES = (
    '<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills>'
    '<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>'
)


def _corner(columns: int, rows: int) -> str:
    name = ""
    while columns:
        columns, k = divmod(columns - 1, 26)
        name = chr(65 + k) + name
    return f"{name or 'A'}{rows}"


def write_workbook(tables: Mapping[str, DataFrame], path: str) -> None:
    """One workbook with a sheet for each table, in the order of its rows; names are cut to 31 characters.

    Tasks render rows as XML; the driver only passes them on into the archive, one partition after another. More rows
    than a sheet may have are an error, found before anything is written.
    """
    names = sheet_names(list(tables))
    sizes = []
    for name, df in zip(names, tables.values(), strict=True):
        sizes.append(df.count() + 1)
        if sizes[-1] > MOST_ROWS:
            raise ValueError(f"sheet {name} has {sizes[-1]} rows; a sheet holds {MOST_ROWS}")
    attribute = lambda s: s.replace("&", "&amp;").replace("<", "&lt;").replace('"', "&quot;")
    main, office, package = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "http://schemas.openxmlformats.org/package/2006"
    with created(path) as file, zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as out:
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(names) + 1))
        out.writestr("[Content_Types].xml", f'<?xml version="1.0" encoding="UTF-8"?><Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{kinds}</Types>')
        out.writestr("_rels/.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{attribute(n)}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1))
        out.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{main}" xmlns:r="{office}"><sheets>{listed}</sheets></workbook>')
        linked = "".join(f'<Relationship Id="rId{k}" Type="{office}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))
        out.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{package}/relationships">{linked}<Relationship Id="rIdS" Type="{office}/styles" Target="styles.xml"/></Relationships>')
        out.writestr("xl/styles.xml", _STYLES)
        for k, (df, size) in enumerate(zip(tables.values(), sizes, strict=True), 1):
            row = F.concat(F.lit("<row>"), *[_cell(f.name, f.dataType) for f in df.schema], F.lit("</row>"))
            head = df.sparkSession.range(1).select(*[F.lit(c).alias(c) for c in df.columns])
            with out.open(f"xl/worksheets/sheet{k}.xml", "w", force_zip64=True) as sheet:
                sheet.write(_SHEET_HEAD.format(corner=_corner(len(df.columns), size)).encode())
                for part in (head.select(F.concat(F.lit("<row>"), *[_cell(c, T.StringType()) for c in df.columns], F.lit("</row>")).alias("xml")), df.select(row.alias("xml"))):
                    for r in part.toLocalIterator():
                        sheet.write(r.xml.encode())
                sheet.write(b"</sheetData></worksheet>")
