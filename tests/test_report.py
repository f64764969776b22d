import datetime as dt

from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.functions import periods as P
from plumbline.operators import screening as S
from plumbline.operators import summary as SM
from plumbline.plans import report
from plumbline.sources import settings

D = dt.date
ANNUAL = {"revenue": (1000, 800), "net_profit": (100, 80), "net_profit_attributable": (90, 72), "eps": (9, 7.2), "dps": (3, 2), "total_assets": (2000, 1800), "total_equity": (1100, 1000), "ordinary_equity": (1000, 900), "total_debt": (400, 350), "cash": (150, 100), "operating_cash_flow": (120, 90), "capital_expenditure": (-50, -40), "ordinary_shares_outstanding": (10, None)}
NEGATIVE = ANNUAL | {"eps": (-4, 1), "net_profit": (-40, 10), "net_profit_attributable": (-40, 10), "total_equity": (-500, -400), "ordinary_equity": (-500, -400)}
INTERIM = {"revenue": (300, 250), "net_profit": (30, 20), "net_profit_attributable": (27, 18), "eps": (2.7, 1.8), "operating_cash_flow": (10, 40), "capital_expenditure": (-20, -10)}


def run(spark, annual=ANNUAL, months=3, columns="as the document", year=12, as_of="2026-10-31", **how):
    return run_all(spark, {"A": {"annual": annual, "months": months, "columns": columns, "year": year}}, as_of=as_of, **how)


def run_all(spark, issuers, as_of="2026-10-31", **how):
    """One run over issuers, each with its own annual report and interim statement, and B without any document."""
    rows, docs, companies, snaps = [], [], [("B", "b", "g", 1.0, 1.0)], []
    for n, (t, x) in enumerate(issuers.items()):
        x = {"annual": ANNUAL, "months": 3, "columns": "as the document", "year": 12} | x
        for doc, part, doc_months in (("a", x["annual"], x["year"]), ("i", INTERIM, x["months"] if x["columns"] == "as the document" else x["columns"])):
            rows += [(t, doc + t[1:], m, float(v), None if p is None else float(p), doc_months, i) for i, (m, (v, p)) in enumerate(part.items())]
        docs += [("a" + t[1:], t, "annual_report", "Annual", D(2026, 3, 31), D(2026, 5, 1), f"u{n}", None, 12, None, 2 * n), ("i" + t[1:], t, "interim_statement", "Interim", D(2026, 6, 30), D(2026, 8, 1), f"v{n}", None, x["months"], D(2025, 6, 30), 2 * n + 1)]
        companies.append((t, t.lower(), "g", 90.0, 900.0))
        snaps += [(D(2026, 10, d), t, 20000.0, d) for d in range(1, 8)]
    f = spark.createDataFrame(rows, "ticker string, doc_id string, metric string, value double, previous_value double, period_months int, ord long")
    f = f.select("*", F.lit(0.9).alias("confidence"), F.lit(None).cast("array<double>").alias("comparatives"), F.lit(1.0).alias("multiplier"), F.lit(None).cast("string").alias("correction_id"), F.concat_ws(":", "doc_id", "metric").alias("fact_id"))
    listed = spark.createDataFrame(companies, "ticker string, name string, industry_group string, price double, market_cap double")
    return report.screen(listed, spark.createDataFrame(docs, schemas.DOCUMENT), f, spark.createDataFrame(snaps, "trading_date date, ticker string, share_volume double, ord long"), as_of=as_of, **how)


def test_a_run(spark):
    out = run(spark)
    r = {x.ticker: x for x in out["screening"].collect()}
    a = r["A"]
    want = {"flow_revenue": 1050, "eps": 9.9, "pe": 90 / 9.9, "payout": 3 / 9, "operating_cash_flow": 90, "free_cash_flow": 30, "ocf_to_net_profit": 90 / 110, "dividend_yield": 3 / 90, "roe": 90 / 950, "bvps_used": 100, "pb": 0.9, "revenue_growth": 0.25}
    assert {k: round(a[k], 6) for k in want} == {k: round(v, 6) for k, v in want.items()}
    assert a.income_period == "TTM to 2026-06-30" and a.flags == "" and a.data_confidence == "high"
    assert (a.ebit_used, a.ebit_is_proxy, r["B"].data_confidence) == (None, False, "low")
    assert r["B"].flags.startswith("multi-day liquidity unavailable (0/5")
    assert {x.metric for x in out["review"].where("ticker = 'A'").collect()} == {"operating_profit", "ebit", "bvps", "retained_earnings"}
    assert {(x.metric, x.rule) for x in out["review"].where("ticker = 'B' and metric = 'document'").collect()} == {("document", "document_error")}
    assert {x.used_in_screening for x in out["raw"].collect()} == {"yes", "yes (TTM input)"}
    assert out["history"].count() == 12 and out["ratios"].where("metric = 'pe'").first().formula == "price / eps"
    ratios = {x.metric: x for x in out["ratios"].where("ticker = 'A'").collect()}
    assert ratios["roe"].fact_ids == "a:net_profit_attributable; a:ordinary_equity" and ratios["revenue_cagr_3y"].value is None and ratios["revenue_cagr_3y"].notes == "chain of years is incomplete"
    text = [x.line for x in out["summary"].orderBy("section", "key").collect()]
    assert "Companies processed: 2; high data confidence: 1; review: 0; low: 1." in text and "- Revenue: highest A (1,050.00); lowest A (1,050.00)" in text and "- Sector median P/E: 9.09 (1 companies)" in text
    assert any(x.startswith("- B: Revenue, ") for x in text) and any(x.startswith("- `missing_metric`: ") for x in text) and text[-1].startswith("Values above are descriptive")


def test_periods(spark):
    out = run_all(spark, {"A12": {"months": 12}, "A3": {"months": 6, "columns": 3}, "An": {"months": 6, "columns": None}, "A6": {"months": 6, "columns": 6}, "A0": {"months": 6, "columns": 0}, "A15": {"year": 15}, "An1": {"months": 12, "annual": NEGATIVE}})
    r = {x.ticker: x for x in out["screening"].collect()}
    # without a proven interim
    a = r["A12"]
    assert a.income_period == "FY to 2026-03-31" and a.eps == 9 and a.flow_revenue == 1000
    # columns of another length confirm no trailing figures, and go to review
    assert [r[t].flow_revenue for t in ("A3", "An", "A6", "A0")] == [1000, 1000, 1050, 1050]
    assert {x.metric for x in out["review"].where("rule = 'unconfirmed_interim_period' and ticker = 'A3'").collect()} == set(INTERIM)
    # a year of fifteen months
    a = r["A15"]
    assert (a.flow_revenue, a.income_period, a.roe, a.revenue_growth, a.data_confidence) == (1000, "15 months to 2026-03-31", None, None, "review")
    assert a.pe == 10
    # negative bases
    a = r["An1"]
    assert (a.pe, a.roe, a.debt_to_equity, a.payout) == (None,) * 4 and round(a.earnings_yield, 6) == round(-4 / 90, 6)
    assert a.flags.startswith("negative EPS") and "negative equity" in a.flags


def test_an_old_report_and_a_proxy(spark):
    a = run(spark, annual=ANNUAL | {"operating_profit": (140, 120)}, months=12, as_of="2028-01-01")["screening"].where("ticker = 'A'").first()
    assert (a.data_confidence, a.ebit_used, a.ebit_is_proxy) == ("review", 140, True)


def test_confidence_of_the_data(spark):
    rows = [("A", m, 1.0, 0.9, None) for m in report._CORE] + [("A", "revenue", 2.0, 1.0, None)]
    rows += [("B", m, 1.0, 0.9, "review" if m == "eps" else None) for m in report._CORE] + [("C", m, 1.0, 0.9, None) for m in report._CORE[:2]] + [("C", "revenue", 1.0, 1.0, None)]
    d = S.data_confidence(spark.createDataFrame(rows, "ticker string, metric string, value double, confidence double, validation_status string"), list(report._CORE))
    assert {r.ticker: (r.covered, r.data_confidence) for r in d.collect()} == {"A": (6, "high"), "B": (6, "review"), "C": (2, "low")}
    t = spark.createDataFrame([("high", 549), ("review", 549), ("low", 549), ("high", 548), ("review", 548)], "c string, days int")
    got = [r.x for r in t.select(S.stale(F.date_add(F.lit("2026-01-01").cast("date"), F.col("days")), F.lit("2026-01-01").cast("date"), F.col("c")).alias("x")).collect()]
    assert got == ["review", "low", "low", "high", "review"]


def test_settings_and_small_operators(spark, tmp_path):
    (tmp_path / "s.yml").write_text("flags:\n  high_debt_to_equity: 3\nextra: 1\n")
    s = settings.load(str(tmp_path / "s.yml"))
    assert s["flags"]["high_debt_to_equity"] == 3 and s["flags"]["liquidity_minimum_observations"] == 5 and s["extra"] == 1 and settings.DEFAULTS["flags"]["high_debt_to_equity"] == 2.0
    rows = spark.createDataFrame([("d", "deposits", 1.0, 1), ("d", "bank", 2.0, 2), ("d", "bank", 9.0, 3), ("e", "bank", 2.0, 1)], "doc string, label string, v double, ord long")
    assert [tuple(r) for r in SM.all_components(rows, ["doc"], "label", "v", ("deposits", "bank"), "ord").collect()] == [("d", 3.0)]
    t = spark.createDataFrame([("for the period 1 January 2025 to 31 March 2026",), ("as at 31 March 2026",)], "t string")
    assert [r.m for r in t.select(P.range_months(F.col("t")).alias("m")).collect()] == [15, None]


def test_validation_runs_before_the_screening(spark):
    gone = {m: v for m, v in ANNUAL.items() if m != "ordinary_shares_outstanding"}
    out = run_all(spark, {"A": {"annual": ANNUAL | {"total_liabilities": (100, 90), "eps": (900, 7.2), "ordinary_shares_outstanding": (0.01, None)}}, "A2": {"annual": gone}})
    found = {(x.metric, x.rule) for x in out["review"].where("ticker = 'A'").collect()}
    assert {("total_assets", "accounting_equation"), ("eps", "eps_identity")} <= found and ("ordinary_shares_outstanding", "share_count_identity") not in found
    raw = {(x.doc_id, x.metric): x for x in out["raw"].collect()}
    assert round(raw["a", "total_assets"].confidence, 2) == 0.75 and raw["a", "eps"].confidence == 0.6 and raw["a", "ordinary_shares_outstanding"].value == 10
    a = raw["a2", "ordinary_shares_outstanding"]
    assert (a.value, a.confidence, a.extraction_method) == (10, 0.85, "cse_market_data")
    assert "share count implied by market data" in out["ratios"].where("metric = 'bvps_used' and ticker = 'A2'").first().notes
