import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from plumbline.functions import periods as P
from plumbline.functions import ratios as R
from plumbline.functions import text as X
from plumbline.sources import sinks


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize("text,value", [("(1,234.50)", "-1234.50"), ("19,11", "19.11"), ("1,234", "1234"), ("-", None), ("—", None), ("N/A", None), ("Rs 12.5*", "12.5"), ("(-)", None), ("1,234,567", "1234567"), ("", None)])
def test_parse_number(spark, text, value):
    assert one(spark, X.parse_number(F.col("t")), t=text) == (None if value is None else D(value))


@pytest.mark.parametrize("text,unit,multiplier", [("Rs. '000", "LKR '000", 1000), ("(In Thousands of Rupees)", "LKR '000", 1000), ("Rs. mn", "LKR million", 10**6), ("LKR in billion", "LKR billion", 10**9), ("Owners of the parent 14,051,822", None, None), ("Rs. 14,556,000", "LKR", 1)])
def test_detect_unit(spark, text, unit, multiplier):
    u = one(spark, X.detect_unit(F.col("t")), t=text)
    assert (u and (u.unit, u.multiplier)) == (unit and (unit, multiplier))


def test_unknown_unit_raises(spark):
    assert one(spark, X.normalize_monetary(F.lit(D("2.5")), F.lit("Rs. mn"))) == 2500000
    with pytest.raises(Exception, match="Unrecognized"):
        one(spark, X.normalize_monetary(F.lit(D("2.5")), F.lit("metres")))


@pytest.mark.parametrize("title,kind,end", [
    ("Annual Report 2024/25", "annual_report", "2025-03-31"), ("Errata to the Annual Report 2024/25", None, None), ("Interim Financial Statements 31st March 2026", "interim_statement", "2026-03-31"),
    ("Interim report 03/31/2025", "interim_statement", "2025-03-31"), ("Quarterly report 30.06.2025", "interim_statement", "2025-06-30"), ("Interim 31.02.2025", "interim_statement", None), ("Circular", None, None),
])
def test_titles(spark, title, kind, end):
    assert one(spark, X.filing_kind(F.col("t")), t=title) == kind
    assert one(spark, P.period_end(F.col("t")), t=title) == (end and dt.date.fromisoformat(end))


def test_dates(spark):
    day = lambda s: F.lit(s).cast("date")
    assert one(spark, P.prior_year_end(day("2024-02-29"))) == dt.date(2023, 2, 28)
    assert one(spark, P.uploaded_date(F.lit("05 Mar 2025 03:15:00 PM"))) == dt.date(2025, 3, 5)
    assert one(spark, P.uploaded_date(F.lit("soon"))) is None
    assert one(spark, P.months_since(day("2025-03-31"), day("2025-09-30"))) == 6
    assert one(spark, P.months_since(day("2025-03-31"), day("2025-09-29"))) is None
    assert one(spark, P.quarter_label(day("2026-10-04"))) == "2026Q4"
    assert one(spark, P.epoch_date(F.lit(1_700_000_000).cast("long"))) == one(spark, P.epoch_date(F.lit(1_700_000_000_000).cast("long")))
    assert one(spark, P.epoch_date(F.lit(1_700_000_000_000).cast("long"), "Asia/Colombo")) == dt.date(2023, 11, 15)
    assert one(spark, P.period_label(F.lit(15), day("2026-03-31"))) == "15 months to 2026-03-31"
    assert one(spark, P.window_start(day("2024-02-29"))) == dt.date(2021, 2, 28)


def test_null_algebra(spark):
    n, z = F.lit(None).cast("double"), F.lit(0.0)
    v = lambda x: F.lit(float(x))
    assert one(spark, R.divide(v(1), z)) is None and one(spark, R.divide(n, v(1))) is None
    assert one(spark, R.growth(v(-50), v(-100))) == 0.5 and one(spark, R.growth(v(1), z)) is None
    assert one(spark, R.cagr(v(1000), v(640), 2)) == pytest.approx(0.25)
    assert one(spark, R.cagr(v(-1), v(640), 2)) is None and one(spark, R.cagr(v(1), v(0), 2)) is None and one(spark, R.cagr(v(1), v(1), 0)) is None
    assert one(spark, R.return_on_average(v(90), v(1000), v(900))) == pytest.approx(90 / 950) and one(spark, R.return_on_average(v(90), v(1000), n)) is None
    assert one(spark, R.free_cash_flow(v(90), v(-60))) == 30 and one(spark, R.net_debt(n, v(1))) is None
    assert one(spark, R.implied_shares(v(5), v(2))) == 2 and one(spark, R.near(v(104), v(100), 0.05)) and not one(spark, R.near(v(1), z, 0.05))
    assert one(spark, R.plausible_ytd(v(125), v(1000), F.lit(6))) and not one(spark, R.plausible_ytd(v(124), v(1000), F.lit(6)))


def test_trailing_guards(spark):
    day = lambda s: F.lit(s).cast("date")
    run = lambda months=3, annual="2026-03-31", cur="2026-06-30", prior="2025-06-30": one(spark, R.trailing(F.lit(100.0), F.lit(30.0), F.lit(20.0), day(annual), day(cur), day(prior), F.lit(months)))
    assert run() == 110
    assert run(months=12) is None and run(cur="2026-03-31") is None and run(prior="2025-06-29") is None and run(prior="2024-06-30") is None and run(annual="2025-03-31") is None


def test_names_and_labels(spark):
    assert one(spark, X.normalize_group(F.lit(" S&P/CSE  Food ,Beverage&Tobacco"))) == "food, beverage & tobacco"
    assert one(spark, X.company_key(F.lit("A.B. & Co. (PLC)"))) == "abcoplc"
    assert one(spark, X.clean_lines(F.lit(" a  b \r\n\n c\t"))) == ["a b", "c"]
    assert one(spark, X.joined(F.lit("a"), F.lit(None).cast("string"), F.lit(""), F.lit("b"))) == "a; b"
    assert one(spark, X.render_metric(F.lit(0.1234), "percent")) == "12.34%" and one(spark, X.render_metric(F.lit(None).cast("double"), "ratio")) == "NA"
    assert one(spark, X.dividend_type({"finalDividend": F.lit(True), "typeOther": F.lit(True)})) == "final"
    assert one(spark, X.market_share_note(F.lit("cse_market_data_cap"))) and one(spark, X.market_share_note(F.lit("primary"))) is None
    assert one(spark, X.fold_quotes(F.lit("‘ﬁn’"))) == "'fin'"
    assert sinks.file_label("Capital Goods", "2026Q3") == "Capital_Goods_Screening_2026_Q3"
    assert one(spark, P.comparable(F.lit("interim"), F.lit(3), F.lit("interim"), F.lit(6))) is False and one(spark, P.comparable(F.lit("annual"), F.lit(12), F.lit("annual"), F.lit(15)))
