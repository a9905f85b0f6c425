"""Spreadsheet workbooks (.xlsx): sheets read as tables and tables written as sheets.

A sheet is streamed out of the zipped XML row by row, so a task holds the file, its shared
strings and one batch of rows.  Columns are found by the names in the first row; the wanted
schema gives their types.  Empty cells, and cells that do not fit their type, are null;
numbers read as text lose a trailing ``.0``; dates are serial numbers of the workbook's
calendar.  Text keeps line breaks and control characters by the format's ``_xHHHH_``
notation.  Spreadsheet programs cut cells beyond 32,767 characters; this reader and writer
do not.  An empty text and an empty cell are kept apart.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BATCH_ROWS = 4096
#: Rows of one sheet, with its header; more rows go to further sheets.
SHEET_ROWS = 1_048_576
EPOCH, EPOCH_1904 = dt.datetime(1899, 12, 30), dt.datetime(1904, 1, 1)
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_OFFICE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
_CODED = re.compile("_x([0-9A-Fa-f]{4})_")
_UNSAFE = re.compile("[\x00-\x08\x0b-\x1f￾￿]|_(?=x[0-9A-Fa-f]{4}_)")


# --- writing -------------------------------------------------------------------


def _safe(text: str) -> str:
    return escape(_UNSAFE.sub(lambda m: f"_x{ord(m[0]):04X}_", text))


def _column(at: int) -> str:
    name = ""
    while at >= 0:
        name = chr(65 + at % 26) + name
        at = at // 26 - 1
    return name


def _cell(place: str, value) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{place}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (dt.datetime, dt.date)):
        moment = value if isinstance(value, dt.datetime) else dt.datetime(value.year, value.month, value.day)
        gap = moment.replace(tzinfo=None) - EPOCH
        # Serial days as an exact fraction, so that microseconds survive.
        serial = gap.days + (gap.seconds * 10**6 + gap.microseconds) / 86_400_000_000
        return f'<c r="{place}" s="{1 if isinstance(value, dt.datetime) else 2}"><v>{serial!r}</v></c>'
    if isinstance(value, int) and abs(value) < 1 << 53 or isinstance(value, float) and value - value == 0:
        return f'<c r="{place}"><v>{value!r}</v></c>'
    return f'<c r="{place}" t="inlineStr"><is><t xml:space="preserve">{_safe(str(value))}</t></is></c>'


def write_workbook(target: io.IOBase, names: Sequence[str], rows: Iterable[Sequence]) -> int:
    """Write rows below a header; returns their number.  Further sheets follow when one is full."""
    total, sheets = 0, 0
    rows = iter(rows)
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as book:
        more = True
        while more:
            sheets += 1
            with book.open(f"xl/worksheets/sheet{sheets}.xml", "w", force_zip64=True) as sheet:
                sheet.write(f'{head}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
                line, more = 1, False
                cells = "".join(_cell(f"{_column(i)}1", n) for i, n in enumerate(names))
                sheet.write(f'<row r="1">{cells}</row>'.encode())
                for row in rows:
                    line, total = line + 1, total + 1
                    cells = "".join(_cell(f"{_column(i)}{line}", v) for i, v in enumerate(row))
                    sheet.write(f'<row r="{line}">{cells}</row>'.encode("utf-8", "surrogatepass"))
                    if line == SHEET_ROWS:
                        more = True
                        break
                sheet.write(b"</sheetData></worksheet>")
        numbers = range(1, sheets + 1)
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{_OFFICE}.worksheet+xml"/>' for i in numbers)
        book.writestr(
            "[Content_Types].xml",
            f'{head}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" '
            f'ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{_OFFICE}.sheet.main+xml"/>'
            f'<Override PartName="/xl/styles.xml" ContentType="{_OFFICE}.styles+xml"/>{parts}</Types>',
        )
        book.writestr(
            "_rels/.rels",
            f'{head}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_LINKS}/officeDocument" '
            f'Target="xl/workbook.xml"/></Relationships>',
        )
        listed = "".join(f'<sheet name={quoteattr(f"Sheet{i}")} sheetId="{i}" r:id="rId{i}"/>' for i in numbers)
        book.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{_MAIN}" xmlns:r="{_LINKS}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{_LINKS}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in numbers)
        links += f'<Relationship Id="rId0" Type="{_LINKS}/styles" Target="styles.xml"/>'
        book.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{_PACKAGE}/relationships">{links}</Relationships>')
        book.writestr(
            "xl/styles.xml",
            f'{head}<styleSheet xmlns="{_MAIN}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/>'
            f'</borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="22" '
            f'applyNumberFormat="1"/><xf numFmtId="14" applyNumberFormat="1"/></cellXfs></styleSheet>',
        )
    return total


# --- reading -------------------------------------------------------------------


def _text(element: ElementTree.Element) -> str:
    """Text of a string item without its phonetic guides."""
    parts = [t.text or "" for child in element for t in ([child] if child.tag.endswith("}t") else child if child.tag.endswith("}r") else []) if t.tag.endswith("}t")]
    return _CODED.sub(lambda m: chr(int(m[1], 16)), "".join(parts))


def _stream(book: zipfile.ZipFile, name: str, tag: str) -> Iterator[ElementTree.Element]:
    """Elements of one kind, each dropped after use."""
    with book.open(name) as file:
        above: list[ElementTree.Element] = []
        for event, element in ElementTree.iterparse(file, ("start", "end")):
            if event == "start":
                above.append(element)
            else:
                above.pop()
                if element.tag.endswith("}" + tag):
                    yield element
                    if above:
                        above[-1].remove(element)


def _sheet_files(book: zipfile.ZipFile, sheet: str | None) -> list[str]:
    """Files of the sheet of that name, or of all sheets."""
    with book.open("xl/_rels/workbook.xml.rels") as file:
        links = {e.get("Id"): e.get("Target") for e in ElementTree.parse(file).getroot()}
    wanted = [e for e in _stream(book, "xl/workbook.xml", "sheet") if sheet is None or e.get("name") == sheet]
    targets = [links[e.get(f"{{{_LINKS}}}id")] for e in wanted]
    return [t.lstrip("/") if t.startswith("/") else f"xl/{t}" for t in targets]


def _place(reference: str | None, default: int) -> int:
    at = 0
    for char in reference or "":
        if not char.isalpha():
            break
        at = at * 26 + ord(char.upper()) - 64
    return at - 1 if at else default


def _value(cell: ElementTree.Element, strings: Sequence[str]) -> str | float | bool | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return next((_text(e) for e in cell if e.tag.endswith("}is")), None)
    raw = next((e.text for e in cell if e.tag.endswith("}v")), None)
    if raw is None:
        return "" if kind in ("s", "str") and len(cell) else None
    if kind == "s":
        return strings[int(raw)]
    if kind == "b":
        return raw.strip() == "1"
    if kind in ("str", "d"):
        return _CODED.sub(lambda m: chr(int(m[1], 16)), raw)
    return None if kind == "e" else raw.strip()


def sheet_rows(content: bytes, sheet: str | None = None, parts: int = 1, part: int = 0) -> Iterator[dict[str, object]]:
    """Rows by header name; numbers stay text until their type is known.  Of ``parts`` shares of the rows only one is made."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings = [_text(e) for e in _stream(book, "xl/sharedStrings.xml", "si")] if "xl/sharedStrings.xml" in book.namelist() else []
        for file in _sheet_files(book, sheet):
            header: dict[int, str] | None = None
            for number, row in enumerate(_stream(book, file, "row")):
                if header is not None and number // BATCH_ROWS % parts != part:
                    continue
                values, at = {}, -1
                for cell in row:
                    at = _place(cell.get("r"), at + 1)
                    values[at] = _value(cell, strings)
                if header is None:
                    header = {i: str(v) for i, v in values.items() if v is not None}
                else:
                    yield {name: values.get(i) for i, name in header.items()}


def _converter(kind: pa.DataType, epoch: dt.datetime):
    def number(value):
        return float(value) if value not in (None, "") else None

    def moment(value):
        if isinstance(value, str) and re.match(r"\d{4}-", value):
            return dt.datetime.fromisoformat(value)
        return None if number(value) is None else epoch + dt.timedelta(microseconds=round(float(value) * 86_400_000_000))

    def text(value):
        if value is None or isinstance(value, str):
            return value
        return "true" if value is True else "false" if value is False else str(value)

    def whole(value):
        if value in (None, ""):
            return None
        try:
            return int(value)
        except ValueError:
            as_float = float(value)
            return int(as_float) if as_float == int(as_float) else None

    def truth(value):
        if isinstance(value, bool) or value is None:
            return value
        return {"true": True, "1": True, "false": False, "0": False}.get(value.strip().lower())

    def day(value):
        found = moment(value)
        return found.date() if found else None

    if pa.types.is_integer(kind):
        made = whole
    elif pa.types.is_floating(kind):
        made = number
    elif pa.types.is_boolean(kind):
        made = truth
    elif pa.types.is_date(kind):
        made = day
    elif pa.types.is_timestamp(kind):
        made = moment
    elif pa.types.is_string(kind) or pa.types.is_large_string(kind):
        made = text
    else:
        raise ValueError(f"a sheet has no cells of type {kind}")

    def convert(value):
        try:
            return made(value)
        except (ValueError, OverflowError):
            return None

    return convert


def uses_1904(content: bytes) -> bool:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        return any(e.get("date1904") in ("1", "true") for e in _stream(book, "xl/workbook.xml", "workbookPr"))


def read_workbooks(
    spark: SparkSession, path: str | Sequence[str], schema: StructType, sheet: str | None = None, parts: int = 1
) -> DataFrame:
    """Rows of all sheets (or of the named one) of all workbooks below ``path``, as ``schema`` says.

    Files are fetched by Spark's own reader, so they may be in any store.  Each file is
    one task's work; with ``parts`` so many tasks share it, each making its ranges of rows.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    if parts > 1:
        spread = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
        files = files.select("content", spread).repartition(parts * max(1, files.rdd.getNumPartitions()))
    else:
        files = files.select("content", F.lit(0).alias("part"))
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[dict], epoch: dt.datetime) -> pa.RecordBatch:
            columns = []
            for field in target:
                convert = _converter(field.type, epoch)
                columns.append(pa.array([convert(r.get(field.name)) for r in rows], field.type))
            return pa.RecordBatch.from_arrays(columns, schema=target)

        for batch in batches:
            for content, part in zip(batch.column("content"), batch.column("part")):
                content, rows = content.as_py(), []
                epoch = EPOCH_1904 if uses_1904(content) else EPOCH
                for row in sheet_rows(content, sheet, parts, part.as_py()):
                    rows.append(row)
                    if len(rows) == BATCH_ROWS:
                        yield batch_of(rows, epoch)
                        rows = []
                if rows:
                    yield batch_of(rows, epoch)

    return files.mapInArrow(run, schema)
