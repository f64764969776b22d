"""Outputs: one folder per table, CSV and JSON lines for review, formats of columns; workbook.py writes spreadsheets."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHEETS = ("00_Universe", "01_Screening", "02_Raw_Data", "03_Ratios", "04_History", "05_Dividends", "06_Sources", "07_Flags", "08_Summary")


def file_label(group: str, period: str) -> str:
    """Capital Goods, 2026Q3 -> Capital_Goods_Screening_2026_Q3"""
    year, _, quarter = period.upper().partition("Q")
    return f"{re.sub(r'[^A-Za-z0-9]+', '_', group).strip('_')}_Screening_{year}" + (f"_Q{quarter}" if quarter else "")


def number_format(unit):
    """The format label of a unit."""
    return F.when(unit.contains("%"), "percent").when(unit.rlike("(?i)per share|ratio|times"), "two digits").when(unit.rlike("(?i)LKR|shares"), "integer").otherwise("general")


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def write_all(tables: dict[str, DataFrame], folder: str, formats: tuple[str, ...] = ("parquet", "csv")) -> None:
    """Each table as folder/format/name; in parallel part files, so no table passes through the driver."""
    for name, df in tables.items():
        for f in formats:
            w = df.write.mode("overwrite")
            (w.option("header", True).csv if f == "csv" else getattr(w, f))(f"{folder}/{f}/{name}")


def write_review(review: DataFrame, folder: str) -> None:
    text = as_text(review)
    text.write.mode("overwrite").option("header", True).csv(f"{folder}/manual_review_csv")
    text.write.mode("overwrite").json(f"{folder}/extraction_warnings_jsonl")


def write_summary(lines: DataFrame, folder: str) -> None:
    """summary_lines as text, in order over the part files."""
    lines.orderBy("section", "key").select("line").write.mode("overwrite").text(folder)


#: How a column's cells are shown, by the words in its name.
FORMATS = (("percent", ("yield", "roe", "roa", "growth", "cagr", "payout")), ("two digits", ("eps", "dps", "bvps", "pe", "pb", "debt_to_equity", "price")), ("date", ("period_end", "_date")))


def with_formats(df: DataFrame) -> DataFrame:
    """df with a `format` in the metadata of each column, and `frozen` on the first: what a spreadsheet writer needs to show it."""
    out = df
    for i, f in enumerate(df.schema):
        kind = next((k for k, words in FORMATS if any(w in f.name.split("_") or w in f.name and "_" in w for w in words)), "integer" if f.dataType.simpleString().startswith(("decimal", "double", "bigint", "int")) else "general")
        out = out.withMetadata(f.name, {"format": kind, "filter": True} | ({"frozen": True} if not i else {}))
    return out
