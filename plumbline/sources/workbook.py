"""A workbook of several sheets without a library for it.

Rows become XML in tasks, by built-in expressions; the file itself is one zip archive, into which the rows of a sheet are streamed a
partition at a time. A sheet can't have more than a million rows, which is checked first."""

from __future__ import annotations

import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sinks import SHEETS, number_format, with_formats

C = F.col
MOST_ROWS, MOST_CHARS = 1_048_575, 32_767  # of a sheet below its header, and of a cell
_MAIN, _RELS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
#: Formats of cells in the order of their styles; style 1 is the header's.
STYLES = {"general": 0, "percent": 2, "two digits": 3, "integer": 4, "date": 5}
_CODES = {"percent": "0.00%;[Red]-0.00%", "two digits": "#,##0.00;[Red]-#,##0.00", "integer": "#,##0;[Red]-#,##0", "date": "yyyy-mm-dd"}
#: Rules of the screening sheet by column: a scale of three colours, a fill below zero, a fill where there's any text.
SCALED, BELOW_ZERO, ANY_TEXT = ("pe", "pb", "roe", "debt_to_equity", "dividend_yield"), ("eps", "operating_cash_flow", "free_cash_flow"), ("flags",)


def letter(n: int) -> str:
    """The name of column n, from 0."""
    name = ""
    n += 1
    while n:
        n, k = divmod(n - 1, 26)
        name = chr(65 + k) + name
    return name


def _text(value: Column) -> Column:
    plain = F.left(F.regexp_replace(value, r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", ""), F.lit(MOST_CHARS))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        plain = F.replace(plain, F.lit(a), F.lit(b))
    return F.concat(F.lit('<c t="inlineStr"><is><t xml:space="preserve">'), plain, F.lit("</t></is></c>"))


def _cell(name: str, kind: str, style: Column) -> Column:
    c = C(f"`{name}`")
    valued = lambda v: F.concat(F.lit('<c s="'), style.cast("string"), F.lit('"><v>'), v, F.lit("</v></c>"))
    if kind == "boolean":
        xml = F.concat(F.lit('<c t="b"><v>'), c.cast("int").cast("string"), F.lit("</v></c>"))
    elif kind == "date":
        xml = valued(F.datediff(c, F.lit("1899-12-30").cast("date")).cast("string"))
    elif kind in ("double", "float"):
        xml = F.when(F.isnan(c) | (F.abs(c) == float("inf")), _text(c.cast("string"))).otherwise(valued(c.cast("string")))
    elif kind in ("tinyint", "smallint", "int", "bigint") or kind.startswith("decimal"):
        xml = valued(c.cast("string"))
    else:
        xml = _text(c.cast("string"))
    return F.coalesce(xml, F.lit("<c/>"))


def row_xml(df: DataFrame) -> DataFrame:
    """(xml): each row as an element of a sheet. A column named value beside one named unit is shown as the unit wants it, one beside metric as the metric does."""
    formats = {f.name: f.metadata.get("format", "general") for f in with_formats(df).schema}
    style = {n: F.lit(STYLES.get("date" if t == "date" else formats[n], 0)) for n, t in df.dtypes}
    if {"value", "unit"} <= set(df.columns):
        labels = F.coalesce(number_format(C("unit")), F.lit("general"))
        style["value"] = F.coalesce(*[F.when(labels == k, F.lit(v)) for k, v in STYLES.items()])
    elif {"value", "metric"} <= set(df.columns):
        by_metric = with_formats(df.sparkSession.createDataFrame([], ", ".join(f"{m} double" for m in ("roe", "roa", "dividend_yield", "payout", "revenue_growth", "net_profit_growth", "eps_growth", "revenue_cagr_3y", "eps_cagr_3y", "pe", "pb", "debt_to_equity", "bvps_used")))).schema
        style["value"] = F.coalesce(*[F.when(C("metric") == f.name, F.lit(STYLES.get(f.metadata["format"], 4))) for f in by_metric], F.lit(STYLES["integer"]))
    return df.select(F.concat(F.lit("<row>"), *[_cell(n, t, style[n]) for n, t in df.dtypes], F.lit("</row>")).alias("xml"))


def _styles() -> str:
    codes = "".join(f'<numFmt numFmtId="{164 + i}" formatCode="{escape(c)}"/>' for i, c in enumerate(_CODES.values()))
    fill = lambda colour: f'<fill><patternFill patternType="solid"><fgColor rgb="FF{colour}"/><bgColor rgb="FF{colour}"/></patternFill></fill>'
    shown = "".join(f'<xf numFmtId="{164 + i}" fontId="0" fillId="0" borderId="0" xfId="0" applyNumberFormat="1"/>' for i in range(len(_CODES)))
    return (
        f'<styleSheet xmlns="{_MAIN}"><numFmts count="{len(_CODES)}">{codes}</numFmts><fonts count="2"><font/><font><b/><color rgb="FFFFFFFF"/></font></fonts>'
        f'<fills count="3"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>{fill("1F4E78")}</fills><borders count="1"><border/></borders>'
        f'<cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="{2 + len(_CODES)}"><xf xfId="0"/><xf fontId="1" fillId="2" borderId="0" xfId="0" applyFont="1" applyFill="1"/>{shown}</cellXfs>'
        f'<dxfs count="2"><dxf>{fill("FFC7CE")}</dxf><dxf>{fill("FFF2CC")}</dxf></dxfs></styleSheet>'
    )


def _rules(columns: list[str], rows: int) -> str:
    out = []
    for i, name in enumerate(columns):
        place = f"{letter(i)}2:{letter(i)}{rows + 1}"
        if name in SCALED:
            rule = '<cfRule type="colorScale" priority="1"><colorScale><cfvo type="min"/><cfvo type="percentile" val="50"/><cfvo type="max"/><color rgb="FFF8696B"/><color rgb="FFFFEB84"/><color rgb="FF63BE7B"/></colorScale></cfRule>'
        elif name in BELOW_ZERO:
            rule = '<cfRule type="cellIs" dxfId="0" priority="2" operator="lessThan"><formula>0</formula></cfRule>'
        elif name in ANY_TEXT:
            rule = '<cfRule type="cellIs" dxfId="1" priority="3" operator="notEqual"><formula>""</formula></cfRule>'
        else:
            continue
        out.append(f'<conditionalFormatting sqref="{place}">{rule}</conditionalFormatting>')
    return "".join(out)


def write_workbook(tables: dict[str, DataFrame], path: str) -> None:
    """The sheets of SHEETS that tables has, in that order, as one file: a frozen header with a filter, columns as wide as their texts within limits,
    cells in the format of their column. Longer texts are cut to what a cell can hold; a table that a sheet can't hold raises ValueError."""
    names = [n for n in SHEETS if n in tables]
    if not names:
        raise ValueError(f"none of the tables is a sheet: {', '.join(tables)}")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        for k, name in enumerate(names, 1):
            df = tables[name]
            lengths = [F.max(F.length(C(f"`{c}`").cast("string"))).alias(f"_{i}") for i, c in enumerate(df.columns)]
            sizes = df.agg(F.count("*").alias("rows"), *lengths).first()  # one row
            rows = sizes["rows"]
            if rows > MOST_ROWS:
                raise ValueError(f"{name} has {rows} rows, more than a sheet can hold")
            last = f"{letter(len(df.columns) - 1)}{rows + 1}"
            widths = "".join(f'<col min="{i + 1}" max="{i + 1}" width="{min(45, max(10, len(c) + 2, (sizes[f"_{i}"] or 0) + 2))}" customWidth="1"/>' for i, c in enumerate(df.columns))
            head = "".join(f'<c s="1" t="inlineStr"><is><t>{escape(c)}</t></is></c>' for c in df.columns)
            with book.open(f"xl/worksheets/sheet{k}.xml", "w") as out:
                out.write(
                    f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><worksheet xmlns="{_MAIN}"><dimension ref="A1:{last}"/><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews>'
                    f"<cols>{widths}</cols><sheetData><row>{head}</row>".encode()
                )
                for r in row_xml(df).toLocalIterator():  # a partition at a time
                    out.write(r.xml.encode())
                rules = _rules(df.columns, rows) if name == "01_Screening" and rows else ""
                out.write(f'</sheetData><autoFilter ref="A1:{last}"/>{rules}</worksheet>'.encode())
        sheets = "".join(f'<sheet name="{n}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(names, 1))
        links = "".join(f'<Relationship Id="rId{k}" Type="{_RELS}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(names) + 1))
        package = "http://schemas.openxmlformats.org/package/2006"
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_RELS}"><sheets>{sheets}</sheets></workbook>')
        book.writestr("xl/styles.xml", _styles())
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}/relationships">{links}<Relationship Id="rId{len(names) + 1}" Type="{_RELS}/styles" Target="styles.xml"/></Relationships>')
        book.writestr("_rels/.rels", f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{_RELS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("[Content_Types].xml", f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>{kinds}</Types>')
