import datetime as dt
import re
import zipfile
from xml.etree import ElementTree as ET

import pytest

from plumbline.sources import sinks, workbook

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def read_back(path):
    """sheet name -> (rows of (value, style), root)"""
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None
        for name in z.namelist():
            ET.fromstring(z.read(name))  # all parts are well-formed
        names = [s.get("name") for s in ET.fromstring(z.read("xl/workbook.xml")).iter(f"{{{NS['m']}}}sheet")]
        out = {}
        for k, name in enumerate(names, 1):
            root = ET.fromstring(z.read(f"xl/worksheets/sheet{k}.xml"))
            cell = lambda c: ("".join(c.itertext()) if c.get("t") == "inlineStr" else c.findtext("m:v", None, NS), int(c.get("s", 0)))
            out[name] = ([[cell(c) for c in r] for r in root.find("m:sheetData", NS)], root)
        return out, ET.fromstring(z.read("xl/styles.xml"))


def test_a_workbook_of_nine_sheets(spark, tmp_path):
    path = str(tmp_path / "book.xlsx")
    screening = spark.createDataFrame([("A <&> \x07é", 0.125, -2.5, 12.0, "negative EPS", dt.date(2026, 3, 31), True), ("B", None, float("nan"), 9.0, None, None, False)], "ticker string, roe double, eps double, market_cap double, flags string, period_end date, proxy boolean")
    raw = spark.createDataFrame([("A", 3.5, "LKR per share"), ("A", 9.0, "LKR '000"), ("A", 1.0, None)], "ticker string, value double, unit string")
    ratios = spark.createDataFrame([("A", "roe", 0.1), ("A", "pe", 9.5), ("A", "net_debt", 1e9)], "ticker string, metric string, value double")
    tables = {n: spark.range(3).selectExpr("id", "concat('t', id) as text") for n in sinks.SHEETS} | {"01_Screening": screening, "02_Raw_Data": raw, "03_Ratios": ratios, "05_Dividends": spark.range(0).selectExpr("id as x"), "ignored": raw}
    workbook.write_workbook(tables, path)
    got, styles = read_back(path)
    assert tuple(got) == sinks.SHEETS
    rows, root = got["01_Screening"]
    assert [c[0] for c in rows[0]] == screening.columns and {c[1] for c in rows[0]} == {1}
    kind = workbook.STYLES
    assert rows[1] == [("A <&> é", 0), ("0.125", kind["percent"]), ("-2.5", kind["two digits"]), ("12.0", kind["integer"]), ("negative EPS", 0), ("46112", kind["date"]), ("1", 0)]
    assert rows[2] == [("B", 0), (None, 0), ("NaN", 0), ("9.0", kind["integer"]), (None, 0), (None, 0), ("0", 0)]
    assert root.find("m:sheetViews/m:sheetView/m:pane", NS).get("state") == "frozen" and root.find("m:autoFilter", NS).get("ref") == "A1:G3"
    rules = {r.get("sqref"): r[0].get("type") for r in root.findall("m:conditionalFormatting", NS)}
    assert rules == {"B2:B3": "colorScale", "C2:C3": "cellIs", "E2:E3": "cellIs"}
    assert [r[1][1] for r in got["02_Raw_Data"][0][1:]] == [kind["two digits"], kind["integer"], kind["general"]]
    assert [r[2][1] for r in got["03_Ratios"][0][1:]] == [kind["percent"], kind["two digits"], kind["integer"]]
    assert len(got["05_Dividends"][0]) == 1 and [r[1][0] for r in got["00_Universe"][0]] == ["text", "t0", "t1", "t2"]
    formats = [f.get("formatCode") for f in styles.iter(f"{{{NS['m']}}}numFmt")]
    shown = [int(x.get("numFmtId", 0)) for x in styles.find("m:cellXfs", NS)]
    assert formats[shown[kind["percent"]] - 164].startswith("0.00%") and formats[shown[kind["date"]] - 164] == "yyyy-mm-dd"


def test_what_a_sheet_cannot_hold(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workbook, "MOST_ROWS", 2)
    with pytest.raises(ValueError, match="00_Universe has 3 rows"):
        workbook.write_workbook({"00_Universe": spark.range(3)}, str(tmp_path / "a.xlsx"))
    with pytest.raises(ValueError, match="none"):
        workbook.write_workbook({"x": spark.range(3)}, str(tmp_path / "b.xlsx"))
    long = spark.createDataFrame([("y" * 40_000,)], "t string")
    workbook.write_workbook({"06_Sources": long}, str(tmp_path / "c.xlsx"))
    assert len(read_back(tmp_path / "c.xlsx")[0]["06_Sources"][0][1][0][0]) == 32_767
    assert [workbook.letter(n) for n in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"] and re.fullmatch("[A-Z]+", workbook.letter(16_383))
