"""Fiscal periods as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import filing_kind

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _safe_date(y: Column, m: Column, d: Column) -> Column:
    return F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d), "yyyy-MM-dd")


def period_end(title: Column) -> Column:
    """The date a title names: figures (day first unless the second is beyond 12), day and month's name, or a year range of an
    annual report, which ends on 31 March; null for none or an impossible one."""
    t = F.regexp_replace(title, r"(?i)(?<=\d)(st|nd|rd|th)\b", "")
    figures, named, years = r"\b(\d{1,2})[ ./-](\d{1,2})[ ./-](20\d{2})\b", r"\b(\d{1,2})\s+([A-Za-z]{3,9})\s+(20\d{2})\b", r"\b(20\d{2})\s*/\s*(\d{2,4})\b"
    part = lambda pattern, k: F.regexp_extract(t, pattern, k).try_cast("int")
    a, b = part(figures, 1), part(figures, 2)
    by_figures = _safe_date(part(figures, 3), F.when(b > 12, a).otherwise(b), F.when(b > 12, b).otherwise(a))
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(F.regexp_extract(t, named, 2), 1, 3))).cast("int")
    by_name = F.when(month > 0, _safe_date(part(named, 3), month, part(named, 1)))
    end = part(years, 2)
    by_range = F.when(filing_kind(title) == "annual_report", _safe_date(F.when(end < 100, end + 2000).otherwise(end), F.lit(3), F.lit(31)))
    return F.when(t.rlike(figures), by_figures).when(t.rlike(named), by_name).when(t.rlike(years), by_range)


def uploaded_date(text: Column) -> Column:
    return F.try_to_date(text, "dd MMM yyyy hh:mm:ss a")


def months_since(annual_end: Column, interim_end: Column) -> Column:
    """1 to 11 whole months; null unless the interim date ends a month."""
    n = (F.year(interim_end) - F.year(annual_end)) * 12 + F.month(interim_end) - F.month(annual_end)
    return F.when((F.last_day(interim_end) == interim_end) & n.between(1, 11), n)


def prior_year_end(d: Column, years: int = 1) -> Column:
    """29 February goes to 28 February."""
    return F.add_months(d, -12 * years)


def window_start(as_of: Column, years: int = 3) -> Column:
    return F.add_months(as_of, -12 * years)


def quarter_label(d: Column) -> Column:
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def period_label(months: Column, end: Column) -> Column:
    """FY to D, or N months to D for another length than twelve."""
    return F.concat(F.when(F.coalesce(months, F.lit(12)) == 12, "FY").otherwise(F.concat(months.cast("string"), F.lit(" months"))), F.lit(" to "), F.date_format(end, "yyyy-MM-dd"))


def comparable(kind_a: Column, months_a: Column, kind_b: Column, months_b: Column) -> Column:
    return (kind_a == kind_b) & ((kind_a == "annual") | F.coalesce(months_a == months_b, F.lit(False)))


def epoch_date(value: Column, zone: str = "UTC") -> Column:
    """The date of an epoch in milliseconds, or in seconds if it is below 1e10, in a time zone."""
    millis = F.when(value < 10**10, value * 1000).otherwise(value)
    return F.to_date(F.from_utc_timestamp(F.timestamp_millis(millis), zone))


def range_months(header: Column) -> Column:
    """The months of a range of dates like 1 January 2025 to 31 March 2026 in a header, null where there is none."""
    pattern = r"(?i)(\d{1,2})(?:st|nd|rd|th)?\s+([a-z]{3})[a-z]*\s+(20\d{2})\s*(?:to|-|–)\s*(\d{1,2})(?:st|nd|rd|th)?\s+([a-z]{3})[a-z]*\s+(20\d{2})"
    part = lambda k: F.regexp_extract(header, pattern, k)
    month = lambda k: F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(part(k))).cast("int")
    n = (part(6).try_cast("int") - part(3).try_cast("int")) * 12 + month(5) - month(2) + F.when(part(1).try_cast("int") <= 15, 1).otherwise(0)
    return F.when(header.rlike(pattern) & (n > 0), n)
