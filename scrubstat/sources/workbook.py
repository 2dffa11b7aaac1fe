"""XLSX workbooks (S5): sheets by name or position, typed cells, streamed in bounded memory.

A workbook is a ZIP of XML parts: `workbook.xml` names the sheets in order, a relationship table leads to their parts,
a style table tells which number formats are dates, and texts may lie in a table of shared strings. Sheets are read row
by row; shared strings go to a temporary file, of which only the offsets stay in memory.

Cells become text: dates `yyyy-MM-dd HH:mm:ss` (times alone `HH:mm:ss`), booleans `True` and `False`, numbers as stored,
errors (`#N/A`, `#DIV/0!`, ...) and empty cells NULL.
"""

from __future__ import annotations

import io
import re
import tempfile
import zipfile
from array import array
from collections.abc import Iterator
from datetime import datetime, timedelta
from functools import lru_cache
from xml.etree import ElementTree as ET

_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_P = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_REF = re.compile(r"([A-Z]+)(\d+)")
# Number formats that every workbook knows as dates or times.
DATE_FORMATS = {14, 15, 16, 17, 22, 27, 28, 29, 30, 31, 36, 50, 51, 52, 53, 54, 55, 56, 57, 58}
TIME_FORMATS = {18, 19, 20, 21, 32, 33, 34, 35, 45, 46, 47}


def column_index(ref: str) -> int:
    n = 0
    for ch in _REF.match(ref).group(1):
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def column_name(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def format_kind(code: str) -> str:
    """`date`, `time` or `` for a number format; quoted text, escapes, colours and conditions do not count."""
    code = re.sub(r'"[^"]*"|\\.|_.|\*.|\[(?![hms]+\])[^\]]*\]', "", code.split(";")[0].lower()).replace("general", "")
    if re.search("[yd]", code) or "mmm" in code:
        return "date"
    if re.search("[hs]", code):
        return "time"
    return "date" if "m" in code else ""


class SharedStrings:
    """The table of shared strings, in a temporary file that goes with the object."""

    def __init__(self, part):
        self.file, self.at = tempfile.TemporaryFile(), array("Q", [0])
        top = None
        for event, el in ET.iterparse(part, ("start", "end")):
            if top is None:
                top = el
            elif event == "end" and el.tag == f"{_M}si":
                # Runs of a rich text count, phonetic guides do not.
                text = "".join(t.text or "" for x in el if x.tag in (f"{_M}t", f"{_M}r")
                               for t in ([x] if x.tag == f"{_M}t" else x.findall(f"{_M}t")))
                self.at.append(self.at[-1] + self.file.write(text.encode()))
                top.clear()
        self.get = lru_cache(1 << 14)(self._read)

    def _read(self, i: int) -> str:
        self.file.seek(self.at[i])
        return self.file.read(self.at[i + 1] - self.at[i]).decode()


class Workbook:
    """The sheets of a workbook in a seekable file."""

    def __init__(self, file):
        self.zip = zipfile.ZipFile(file)
        self.names = set(self.zip.namelist())
        book = self._xml("xl/workbook.xml")
        rels = {r.get("Id"): r.get("Target") for r in self._xml("xl/_rels/workbook.xml.rels", f"{_P}Relationships")}
        pr = book.find(f"{_M}workbookPr")
        self.epoch = datetime(1904, 1, 1) if pr is not None and pr.get("date1904") in ("1", "true") else datetime(1899, 12, 30)
        self.sheets: dict[str, str] = {}  # name -> part, in the order of the workbook
        for k, s in enumerate(book.iter(f"{_M}sheet"), 1):
            target = rels.get(s.get(f"{_R}id"), f"worksheets/sheet{k}.xml")
            self.sheets[s.get("name")] = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        styles = self._xml("xl/styles.xml")
        own = {int(f.get("numFmtId")): format_kind(f.get("formatCode", "")) for f in styles.iter(f"{_M}numFmt")}
        known = {**dict.fromkeys(DATE_FORMATS, "date"), **dict.fromkeys(TIME_FORMATS, "time"), **own}
        self.kinds = [known.get(int(x.get("numFmtId", 0)), "") for xfs in styles.iter(f"{_M}cellXfs") for x in xfs]
        self._shared: SharedStrings | None = None

    def _xml(self, part: str, empty: str = "none"):
        return ET.fromstring(self.zip.read(part)) if part in self.names else ET.Element(empty)

    def shared(self, i: int) -> str:
        if self._shared is None:
            with self.zip.open("xl/sharedStrings.xml") as f:
                self._shared = SharedStrings(f)
        return self._shared.get(i)

    def part(self, sheet: int | str) -> str:
        """The part of a sheet by name, or by position from 1."""
        if isinstance(sheet, str):
            if sheet not in self.sheets:
                raise KeyError(f"no sheet named {sheet}; there are {', '.join(self.sheets)}")
            return self.sheets[sheet]
        if not 1 <= sheet <= len(self.sheets):
            raise KeyError(f"no sheet {sheet}; there are {len(self.sheets)}")
        return list(self.sheets.values())[sheet - 1]

    def _date(self, serial: str, kind: str) -> str:
        days = float(serial)
        if self.epoch.year == 1899 and days < 60:  # that calendar has a 29 February 1900
            days += 1 if days >= 1 else 0
        t = self.epoch + timedelta(milliseconds=round(days * 86_400_000))
        text = t.strftime("%H:%M:%S") if kind == "time" and days < 1 else f"{t:%Y-%m-%d %H:%M:%S}"
        return text + (f".{t.microsecond // 1000:03d}" if t.microsecond else "")

    def _value(self, c) -> str | None:
        kind, v = c.get("t"), c.find(f"{_M}v")
        if kind == "inlineStr":
            return "".join(t.text or "" for t in c.iter(f"{_M}t"))
        if v is None or v.text is None or kind == "e":
            return None
        if kind == "s":
            return self.shared(int(v.text))
        if kind == "b":
            return "True" if v.text.strip() in ("1", "true") else "False"
        if kind == "d":
            return v.text.replace("T", " ").removesuffix("Z")
        style = int(c.get("s", 0))
        form = self.kinds[style] if kind in (None, "n") and style < len(self.kinds) else ""
        if form:
            try:
                return self._date(v.text, form)
            except (ValueError, OverflowError):
                return v.text
        return v.text

    def rows(self, sheet: int | str = 1) -> Iterator[tuple[int, list[str | None]]]:
        """(row number from 0, cells) of the rows that the sheet holds."""
        with self.zip.open(self.part(sheet)) as f:
            data, n = None, -1
            for event, el in ET.iterparse(f, ("start", "end")):
                if event == "start":
                    data = el if el.tag == f"{_M}sheetData" else data
                elif el.tag == f"{_M}row":
                    n = int(el.get("r")) - 1 if el.get("r") else n + 1
                    cells: dict[int, str | None] = {}
                    for c in el.findall(f"{_M}c"):
                        cells[column_index(c.get("r")) if c.get("r") else len(cells)] = self._value(c)
                    yield n, [cells.get(i) for i in range(max(cells) + 1 if cells else 0)]
                    data.clear()  # rows are read one by one, not kept


# --- writer --------------------------------------------------------------------------------

def _escape(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def _cell(ref: str, v) -> str:
    if v is None:
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)):
        return f'<c r="{ref}"><v>{v!r}</v></c>'
    if isinstance(v, datetime):
        serial = (v - datetime(1899, 12, 30)) / timedelta(days=1)
        if serial >= 61:
            return f'<c r="{ref}" s="1"><v>{serial!r}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{_escape(str(v))}</t></is></c>'


# The parts that every workbook of one sheet has.
_XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOC = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PKG = "http://schemas.openxmlformats.org/package/2006"
_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml."
PARTS = {
    "[Content_Types].xml": f'<Types xmlns="{_PKG}/content-types"><Default Extension="xml" ContentType="application/xml"/>'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{_TYPE}sheet.main+xml"/>'
        f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{_TYPE}worksheet+xml"/>'
        f'<Override PartName="/xl/styles.xml" ContentType="{_TYPE}styles+xml"/></Types>',
    "_rels/.rels": f'<Relationships xmlns="{_PKG}/relationships"><Relationship Id="rId1" Type="{_DOC}/officeDocument" '
        'Target="xl/workbook.xml"/></Relationships>',
    "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_DOC}"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/>'
        "</sheets></workbook>",
    "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PKG}/relationships"><Relationship Id="rId1" Type="{_DOC}/worksheet" '
        f'Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{_DOC}/styles" Target="styles.xml"/></Relationships>',
    "xl/styles.xml": f'<styleSheet xmlns="{_MAIN}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills>'
        '<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
        '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>',
}


def write_xlsx(stream, rows: Iterator[list]) -> None:
    """A workbook of one sheet with inline strings, numbers, booleans and date-times, row by row."""
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, xml in PARTS.items():
            zf.writestr(name, _XML + xml)
        with zf.open("xl/worksheets/sheet1.xml", "w") as sheet:
            sheet.write(f'{_XML}<worksheet xmlns="{_MAIN}"><sheetData>'.encode())
            for r, vals in enumerate(rows, 1):
                sheet.write((f'<row r="{r}">' + "".join(_cell(f"{column_name(i)}{r}", v) for i, v in enumerate(vals))
                             + "</row>").encode())
            sheet.write(b"</sheetData></worksheet>")


def spooled(stream) -> io.IOBase:
    """A copy of a stream that can be read at any place, on disk beyond 16 MB."""
    out = tempfile.SpooledTemporaryFile(max_size=1 << 24)
    while chunk := stream.read(1 << 20):
        out.write(chunk)
    out.seek(0)
    return out
