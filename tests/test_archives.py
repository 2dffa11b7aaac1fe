"""Members of archives read by place and streamed; workbooks with several sheets, styles and shared strings."""

import io
import re
import zipfile
from datetime import datetime

import pytest

from scrubstat.sources import archives as ar
from scrubstat.sources.workbook import Workbook, format_kind, write_xlsx

M = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def book(date1904=""):
    """Sheets Notes and Data, whose parts are numbered the other way round."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as zf:
        zf.writestr("xl/workbook.xml", f'<workbook {M}><workbookPr {date1904}/><sheets><sheet name="Notes" sheetId="7" r:id="rId9"/>'
                    '<sheet name="Data" sheetId="2" r:id="rId4"/></sheets></workbook>')
        zf.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                    '<Relationship Id="rId9" Target="worksheets/sheet2.xml"/><Relationship Id="rId4" Target="/xl/worksheets/sheet1.xml"/></Relationships>')
        zf.writestr("xl/styles.xml", f'<styleSheet {M}><numFmts><numFmt numFmtId="164" formatCode="[$-C0A]d\\ mmm\\ yyyy;@"/>'
                    '<numFmt numFmtId="165" formatCode="0.0&quot; days&quot;"/><numFmt numFmtId="166" formatCode="[h]:mm"/></numFmts>'
                    '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/><xf numFmtId="20"/><xf numFmtId="166"/></cellXfs></styleSheet>')
        zf.writestr("xl/sharedStrings.xml", f'<sst {M}><si><t>name</t></si><si><r><t>An</t></r><r><t>na é</t></r><rPh><t>x</t></rPh></si>'
                    '<si><t>day</t></si><si><t/></si></sst>')
        zf.writestr("xl/worksheets/sheet2.xml", f'<worksheet {M}><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>note</t></is></c></row>'
                    '<row r="2"><c r="A2" t="inlineStr"><is><t>first</t></is></c></row></sheetData></worksheet>')
        zf.writestr("xl/worksheets/sheet1.xml", f'<worksheet {M}><sheetData>'
                    '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>2</v></c><c r="C1" t="str"><v>ok</v></c><c r="D1" t="str"><v>n</v></c></row>'
                    '<row r="2"><c r="A2" t="s"><v>1</v></c><c r="B2" s="1"><v>45444</v></c><c r="C2" t="b"><v>1</v></c><c r="D2" s="3"><v>2.5</v></c></row>'
                    '<row r="3"><c r="B3" s="2"><v>45444.75</v></c><c r="C3" t="b"><v>0</v></c><c r="D3" t="e"><v>#DIV/0!</v></c></row>'
                    '<row r="5"><c r="A5" t="s"><v>3</v></c><c r="B5" s="4"><v>0.5</v></c><c r="D5"><v>7</v></c></row></sheetData></worksheet>')
    return out.getvalue()


def test_sheets_by_name_and_place_with_typed_cells(spark, tmp_path):
    (tmp_path / "b.xlsx").write_bytes(book())
    data = [("Anna é", "2024-06-01 00:00:00", "True", "2.5"), (None, "2024-06-01 18:00:00", "False", None), ("", "12:00:00", None, "7")]
    for sheet in ("Data", 2):
        df = ar.read_xlsx(spark, str(tmp_path), sheet)
        assert df.columns == ["name", "day", "ok", "n"] and [tuple(r) for r in df.collect()] == data
    assert [tuple(r) for r in ar.read_xlsx(spark, str(tmp_path)).collect()] == [("first",)]
    assert [tuple(r) for r in ar.read_xlsx(spark, str(tmp_path), "Data", ["n", "day"]).collect()] == [(x[3], x[1]) for x in data]
    assert [tuple(r)[1:] for r in ar.xlsx_sheets(spark, str(tmp_path)).orderBy("position").collect()] == [(1, "Notes"), (2, "Data")]
    for sheet in ("Other", 3):
        with pytest.raises(Exception, match="no sheet"):
            ar.read_xlsx(spark, str(tmp_path), sheet)
    with pytest.raises(KeyError):
        ar.read_xlsx(spark, str(tmp_path), "Data", ["nothing"])


def test_calendars_and_formats():
    early = Workbook(io.BytesIO(book()))
    assert [early._date(d, "date") for d in ("1", "59", "61", "45444.5")] == [
        "1900-01-01 00:00:00", "1900-02-28 00:00:00", "1900-03-01 00:00:00", "2024-06-01 12:00:00"]
    assert Workbook(io.BytesIO(book('date1904="1"')))._date("0", "date") == "1904-01-01 00:00:00"
    kinds = {"yyyy-mm-dd": "date", "[h]:mm": "time", "General": "", "0.00": "", '0 "days"': "", "[Red]0": "", "mmm": "date", "m/d/yy h:mm": "date",
             "ss.0": "time", "[$-409]#,##0": "", "\\d0": ""}
    assert {k: format_kind(k) for k in kinds} == kinds


def test_written_workbooks_come_back(spark, tmp_path):
    with open(tmp_path / "w.xlsx", "wb") as f:
        write_xlsx(f, iter([["t", "d", "b", "x"], ["a<b", datetime(2024, 2, 29, 13, 30), True, 1.5], [None, datetime(1850, 1, 1), False, None]]))
    assert [tuple(r) for r in ar.read_xlsx(spark, str(tmp_path)).collect()] == [
        ("a<b", "2024-02-29 13:30:00", "True", "1.5"), (None, "1850-01-01 00:00:00", "False", None)]


def test_members_are_tasks_of_their_own(spark, tmp_path):
    for a in range(2):
        with zipfile.ZipFile(tmp_path / f"a{a}.zip", "w") as zf:
            for m in range(3):
                how = zipfile.ZIP_STORED if m == 1 else zipfile.ZIP_DEFLATED
                zf.writestr(zipfile.ZipInfo(f"d/m{m}.CSV"), "id,text\n" + "".join(f'{i},"é {a}\n{m}"\n' for i in range(3000)), how)
            zf.writestr("empty.csv", "")
            zf.writestr("other.txt", "x")
    rows = ar.read_zip_rows(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() == 8
    got = ar.read_zip_csv(spark, str(tmp_path))
    assert got.columns == ["id", "text"] and got.count() == 18000
    assert sorted({r["text"] for r in got.collect()}) == [f"é {a}\n{m}" for a in range(2) for m in range(3)]
    assert ar.read_zip_csv(spark, str(tmp_path), columns=["text"]).columns == ["text"]


@pytest.mark.parametrize("how", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_damage_is_noticed(spark, tmp_path, how):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", how) as zf:
        zf.writestr("m.csv", "a\n" + "value\n" * 500)
    raw = bytearray((tmp_path / "a.zip").read_bytes())
    at = raw.index(b"m.csv") + (200 if how == zipfile.ZIP_STORED else 15)
    raw[at] ^= 1
    (tmp_path / "a.zip").write_bytes(bytes(raw))
    with pytest.raises(Exception, match="checksum differs|Error -3|incorrect|invalid"):
        ar.read_zip_csv(spark, str(tmp_path)).collect()
