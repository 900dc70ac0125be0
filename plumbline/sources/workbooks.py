"""Reading and writing .xlsx workbooks with the standard library; other workbook formats are refused with a clear error."""

from __future__ import annotations

import datetime
import os
import re
import zipfile
from collections.abc import Iterable, Sequence
from xml.etree import ElementTree as X
from xml.sax.saxutils import escape

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from plumbline.functions import names as N
from plumbline.operators.failed_rows import is_header_like
from plumbline.sources.text import LoadedFile, find_header_row, fixed_decimals

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_EPOCH = datetime.datetime(1899, 12, 30)
#: Built-in number formats that show dates or fixed decimals.
BUILTIN_FORMATS = {1: "0", 2: "0.00", 3: "#,##0", 4: "#,##0.00", 9: "0%", 10: "0.00%", 14: "dd/mm/yyyy", 15: "d-mmm-yy", 16: "d-mmm", 17: "mmm-yy", 18: "h:mm AM/PM", 19: "h:mm:ss AM/PM", 20: "h:mm", 21: "h:mm:ss", 22: "m/d/yy h:mm", 45: "mm:ss", 46: "[h]:mm:ss", 47: "mmss.0"}
MAX_SHEET_ROWS = 1_048_575


class Workbook:
    """Sheets of an .xlsx file as rows of (value, number format) cells."""

    def __init__(self, path: str) -> None:
        if not path.lower().endswith((".xlsx", ".xlsm")):
            raise RuntimeError(f"Could not open '{os.path.basename(path)}': only .xlsx and .xlsm workbooks can be read")
        try:
            self.zip = zipfile.ZipFile(path)
        except zipfile.BadZipFile as e:
            raise RuntimeError(f"Could not open '{os.path.basename(path)}': {e}") from e
        book = X.fromstring(self.zip.read("xl/workbook.xml"))
        targets = {r.get("Id"): r.get("Target") for r in X.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))}
        self.sheets = {s.get("name"): "xl/" + targets[s.get(_REL)].lstrip("/").removeprefix("xl/") for s in book.iterfind("m:sheets/m:sheet", _NS)}
        self.shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in X.fromstring(self.zip.read("xl/sharedStrings.xml")).iterfind("m:si", _NS)] if "xl/sharedStrings.xml" in self.zip.namelist() else []
        self.formats = ["General"]
        if "xl/styles.xml" in self.zip.namelist():
            styles = X.fromstring(self.zip.read("xl/styles.xml"))
            own = {int(f.get("numFmtId")): f.get("formatCode") for f in styles.iterfind("m:numFmts/m:numFmt", _NS)}
            self.formats = [own.get(int(x.get("numFmtId", 0)), BUILTIN_FORMATS.get(int(x.get("numFmtId", 0)), "General")) for x in styles.iterfind("m:cellXfs/m:xf", _NS)] or ["General"]

    def rows(self, sheet: str) -> list[list[tuple[object, str]]]:
        out: list[list[tuple[object, str]]] = []
        for row in X.fromstring(self.zip.read(self.sheets[sheet])).iterfind("m:sheetData/m:row", _NS):
            at = int(row.get("r", len(out) + 1))
            out += [[] for _ in range(at - len(out))]
            cells = out[at - 1]
            for cell in row.iterfind("m:c", _NS):
                column = _column(cell.get("r")) if cell.get("r") else len(cells)
                cells += [(None, "General")] * (column + 1 - len(cells))
                style = int(cell.get("s", 0))
                cells[column] = (self._value(cell, style), self.formats[style] if style < len(self.formats) else "General")
        width = max(map(len, out), default=0)
        return [r + [(None, "General")] * (width - len(r)) for r in out]

    def _value(self, cell: X.Element, style: int) -> object:
        kind, v = cell.get("t", "n"), cell.find("m:v", _NS)
        if kind == "inlineStr":
            return "".join(t.text or "" for t in cell.iter(f"{{{_NS['m']}}}t"))
        if v is None or v.text is None:
            return None
        if kind == "s":
            return self.shared[int(v.text)]
        if kind == "b":
            return v.text == "1"
        if kind in ("str", "e", "d"):
            return v.text
        number = float(v.text)
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", self.formats[style] if style < len(self.formats) else "")
        return _EPOCH + datetime.timedelta(days=number) if re.search(r"[dmyhs]", code, re.I) and code != "General" else number


def _column(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def cell_text(value: object) -> str | None:
    """A cell as text: dates as dd/mm/yyyy, whole numbers without a point, booleans as TRUE and FALSE."""
    if value is None or value == "":
        return None
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, datetime.datetime):
        return value.strftime("%d/%m/%Y")
    if isinstance(value, float):
        return str(int(value)) if value == int(value) and abs(value) < 1e16 else repr(value)
    return str(value)


def _usability(rows: Sequence[Sequence[str | None]]) -> tuple[int, int]:
    if not rows:
        return 0, 0
    at = find_header_row(rows)
    return max(len(rows) - at - 1, 0), sum(is_header_like(c) for c in rows[at] if c is not None)


def load_workbook(spark: SparkSession, path: str) -> LoadedFile:
    """The first usable sheet of a workbook as text columns plus ``__row_id``; a note says if another sheet was taken."""
    if not os.path.getsize(path):
        raise RuntimeError(f"'{os.path.basename(path)}' is empty -- nothing to clean")
    book = Workbook(path)
    names = list(book.sheets)
    raw = {s: book.rows(s) for s in names}
    text = {s: [[cell_text(v) for v, _ in r] for r in rows] for s, rows in raw.items()}
    scores = {s: _usability(text[s]) for s in names}
    first = names[0]
    chosen = first if len(names) == 1 or (scores[first][0] >= 1 and scores[first][1] >= 2) else max(names, key=lambda s: scores[s])
    note = None if chosen == first else f"Sheet '{chosen}' was used: '{first}' holds no table"
    rows = text[chosen]
    header = find_header_row(rows)
    columns = N.mangle_header(rows[header]) if rows else []
    body = [(i, *r) for i, r in enumerate(rows) if i > header and any(c is not None for c in r)]
    schema = T.StructType([T.StructField("__row_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in columns]])
    display: dict[str, dict[float, int]] = {}
    for r in raw[chosen][header + 1 :]:
        for name, (value, code) in zip(columns, r):
            decimals = fixed_decimals(code) if isinstance(value, float) else None
            needed = len(repr(value).partition(".")[2]) if decimals is not None and value != int(value) else 0
            if decimals is not None and decimals > needed:
                seen = display.setdefault(N.standard_name(name), {})
                seen[value] = max(decimals, seen.get(value, 0))
    return LoadedFile(path, os.path.splitext(path)[1].lower(), spark.createDataFrame(body, schema), header, None, None, chosen, note, tuple(names), display)


def write_workbook(path: str, sheets: Sequence[tuple[str, Sequence[str], Iterable[Sequence[object]]]], colours: dict[str, str] | None = None) -> None:
    """Sheets as (name, header, rows). Text stays text, a leading = included; numbers and booleans keep their kind."""
    colours = colours or {}
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("[Content_Types].xml", head + '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>' + parts + "</Types>")
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("_rels/.rels", head + f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", head + f'<workbook {main} xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(n[:31])}" sheetId="{i}" r:id="rId{i}"/>' for i, (n, _, _) in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", head + '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        for i, (name, header, rows) in enumerate(sheets, 1):
            body, widths = [], [len(str(h)) for h in header]
            for r, row in enumerate([header, *rows][: MAX_SHEET_ROWS + 1], 1):
                cells = []
                for c, v in enumerate(row):
                    ref = f"{_letters(c)}{r}"
                    if c < len(widths) and v is not None:
                        widths[c] = max(widths[c], len(str(v)))
                    if v is None:
                        continue
                    if isinstance(v, bool):
                        cells.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
                    elif isinstance(v, (int, float)) and v == v and abs(v) != float("inf"):
                        cells.append(f'<c r="{ref}"><v>{v!r}</v></c>')
                    else:
                        cells.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(v)))}</t></is></c>')
                body.append(f'<row r="{r}">{"".join(cells)}</row>')
            tab = f'<sheetPr><tabColor rgb="FF{colours[name]}"/></sheetPr>' if name in colours else ""
            cols = "<cols>" + "".join(f'<col min="{k}" max="{k}" width="{min(w + 2, 40)}" customWidth="1"/>' for k, w in enumerate(widths, 1)) + "</cols>" if widths else ""
            z.writestr(f"xl/worksheets/sheet{i}.xml", head + f"<worksheet {main}>{tab}{cols}<sheetData>{''.join(body)}</sheetData></worksheet>")


def _letters(column: int) -> str:
    out = ""
    column += 1
    while column:
        column, rest = divmod(column - 1, 26)
        out = chr(65 + rest) + out
    return out
