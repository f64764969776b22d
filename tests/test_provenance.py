import pytest
from pyspark.sql import functions as F

from plumbline.operators import provenance as PV
from plumbline.operators import summary as SM
from plumbline.operators import validation as V

EDGE = "parent string, child string, role string"
FACTS = "doc_id string, metric string, value double, confidence double, ord long, extraction_method string, multiplier double, original_unit string"


def ways(df, node):
    return sorted((r.source, r.path, r.depth) for r in df.where(F.col("node") == node).collect())


def test_closure_follows_every_way(spark):
    e = spark.createDataFrame([("flag:A:x", "ratio:A:r", "ratio"), ("ratio:A:r", "t", "above"), ("ratio:A:r", "f1", "below"), ("t", "f1", "year"), ("t", "f2", "to date"), ("t", "f2", "before"), ("t", "f2", "before"), (None, "f3", "x")], EDGE)
    got = PV.closure(e)
    assert ways(got, "ratio:A:r") == [("f1", "above / year", 2), ("f1", "below", 1), ("f2", "above / before", 2), ("f2", "above / to date", 2)]
    assert ways(got, "flag:A:x") == [("f1", "ratio / above / year", 3), ("f1", "ratio / below", 2), ("f2", "ratio / above / before", 3), ("f2", "ratio / above / to date", 3)]
    assert [tuple(r) for r in PV.sources_of(got).collect()] == [("A", "r", ["f1", "f2"])]
    assert PV.closure(e.where("false")).count() == 0
    with pytest.raises(ValueError, match="cycle"):
        PV.closure(spark.createDataFrame([("a", "b", "x"), ("b", "a", "y")], EDGE))


def test_inputs_of_ratios_with_fallbacks(spark):
    facts = spark.createDataFrame([("A", m, f"a:{m}") for m in ("net_profit", "total_equity", "eps", "dps", "operating_cash_flow", "net_profit")[:5]] + [("B", m, f"b:{m}") for m in ("net_profit", "net_profit_attributable", "ordinary_equity", "total_equity", "bvps", "ordinary_shares_outstanding")], "ticker string, metric string, fact_id string")
    screened = spark.createDataFrame([("A", "ttm", "fy", 0.1, 9.0, 0.3, None, 0.5), ("B", "fy", "fy", 0.2, None, None, 1.0, None)], "ticker string, income_basis string, cash_basis string, roe double, pe double, payout double, pb double, ocf_to_net_profit double")
    edges = {(r.parent, r.child, r.role) for r in PV.ratio_edges(screened, facts).collect()}
    assert edges == {
        # without an attributable profit or an own equity, what stands in for them
        ("ratio:A:roe", "a:net_profit", "profit"), ("ratio:A:roe", "a:total_equity", "closing equity"), ("ratio:A:roe", "a:total_equity", "opening equity"),
        ("ratio:A:pe", "market:A:price", "price"), ("ratio:A:pe", "trailing:A:eps", "eps"), ("ratio:A:payout", "a:dps", "dps"), ("ratio:A:payout", "a:eps", "eps"),
        ("ratio:A:ocf_to_net_profit", "a:operating_cash_flow", "operating cash flow"), ("ratio:A:ocf_to_net_profit", "a:net_profit", "profit"),
        ("ratio:B:roe", "b:net_profit_attributable", "profit"), ("ratio:B:roe", "b:ordinary_equity", "closing equity"), ("ratio:B:roe", "b:ordinary_equity", "opening equity"),
        # a printed book value per share is the only input of its kind
        ("ratio:B:pb", "market:B:price", "price"), ("ratio:B:pb", "b:bvps", "book value"),
    }
    trailing = PV.trailing_edges(screened.selectExpr("ticker", "'eps' as metric").where("ticker = 'A'"), facts, facts.withColumn("fact_id", F.concat(F.lit("i/"), "fact_id")))
    assert ways(PV.closure(PV.ratio_edges(screened, facts).unionByName(trailing)), "ratio:A:pe") == [("a:eps", "eps / year", 2), ("i/a:eps", "eps / year to date", 2), ("i/a:eps", "eps / year to date before", 2), ("market:A:price", "price", 1)]
    flags = spark.createDataFrame([("A", "dividend payout above 100%"), ("A", "negative EPS"), ("B", "negative equity"), ("B", "low trading liquidity (average daily volume)")], "ticker string, flag string")
    assert {(r.parent, r.child) for r in PV.flag_edges(flags, screened, facts).collect()} == {("flag:A:dividend payout above 100%", "ratio:A:payout"), ("flag:A:negative EPS", "trailing:A:eps"), ("flag:B:negative equity", "b:total_equity")}


def test_derived_facts_lead_to_what_they_follow_from(spark):
    f = spark.createDataFrame([("d", "total_assets", "d:a", "x"), ("d", "total_equity", "d:e", "x"), ("d", "total_liabilities", "d:l", "derived"), ("d", "ordinary_equity", "d:o", "derived")], "doc_id string, metric string, fact_id string, extraction_method string")
    assert {tuple(r) for r in PV.derived_edges(f, f).collect()} == {("d:l", "d:a", "total_assets"), ("d:l", "d:e", "total_equity"), ("d:o", "d:e", "total_equity")}


def test_compound_growth_is_made_of_two_reports(spark):
    import datetime as dt

    y = [dt.date(2026, 3, 31), dt.date(2025, 3, 31), dt.date(2024, 3, 31)]
    facts = spark.createDataFrame([("A", "revenue", d, f"r{d.year}") for d in y[:2]], "ticker string, metric string, period_end date, fact_id string")
    grown = spark.createDataFrame([("A", "revenue", y[0], y[1])], "ticker string, metric string, end date, start_end date")
    assert {tuple(r) for r in PV.growth_edges(grown, facts).collect()} == {("ratio:A:revenue_cagr_3y", "r2026", "end"), ("ratio:A:revenue_cagr_3y", "r2025", "start")}


def test_events_are_folded_in_order(spark):
    rows = [("d", "total_assets", 100.0, 0.9, 1), ("d", "total_liabilities", 20.0, 0.9, 2), ("d", "total_equity", 30.0, 0.9, 3), ("d", "revenue", 10.0, 0.9, 4), ("d", "net_profit", 50.0, 0.62, 5), ("e", "eps", 4.45, 0.9, 1), ("e", "net_profit", 1.18e9, 0.9, 2), ("e", "ordinary_shares_outstanding", 265252.0, 0.9, 3), ("f", "eps", -1.0, 0.9, 1), ("f", "net_profit", 1000.0, 0.9, 2), ("f", "dps", -2.0, 0.9, 3), ("g", "ordinary_shares_outstanding", 7.0, 0.9, 1)]
    facts = spark.createDataFrame([(*r, "x", None, "u") for r in rows], FACTS)
    context = spark.createDataFrame([(d, 100.0 if d == "g" else None, True) for d in "defg"], "doc_id string, market_shares double, reconciled boolean")
    done, issues = V.validate_facts(facts, context)
    got = {(r.doc_id, r.metric): r for r in done.collect()}
    a = got["d", "net_profit"]
    assert (a.validation_status, a.validation_notes, round(a.confidence, 2)) == ("review", "read with a confidence of 0.62, below 0.80; net profit is more than twice revenue in size", 0.5)
    assert got["d", "total_assets"].validation_notes == "total assets differ from liabilities and equity by 50.00, more than 5%" and round(got["d", "total_assets"].confidence, 2) == 0.75
    s = got["e", "ordinary_shares_outstanding"]
    assert (s.value, s.multiplier, s.original_unit, s.validation_status, s.confidence) == (265252000.0, 1000.0, "shares x 1,000 (inferred)", "passed", 0.9) and s.validation_notes == "count was in units of 1,000: scaled it is within 5% of profit / EPS"
    assert got["f", "eps"].validation_notes == "EPS -1.00 and profit 1,000.00 differ in sign" and got["f", "eps"].confidence == 0.6 and got["f", "dps"].validation_notes == "dividend per share is negative"
    assert got["g", "ordinary_shares_outstanding"].validation_notes == "count 7 agrees with none of market value / price = 100"
    assert (got["e", "eps"].validation_status, got["e", "eps"].validation_notes, got["e", "eps"].multiplier, got["e", "eps"].original_unit) == ("passed", "", 1.0, "u")
    reasons = {(r.doc_id, r.metric, r.rule): r.reason for r in issues.collect()}
    assert set(reasons) == {("d", m, "accounting_equation") for m in ("total_assets", "total_liabilities", "total_equity")} | {("d", m, "profit_revenue_scale") for m in ("revenue", "net_profit")} | {("d", "net_profit", "low_confidence"), ("f", "eps", "eps_profit_sign"), ("f", "dps", "dps_range"), ("g", "ordinary_shares_outstanding", "share_count_identity")}
    assert reasons["g", "ordinary_shares_outstanding", "share_count_identity"] == got["g", "ordinary_shares_outstanding"].validation_notes
    # what a fact already carries stays ahead of what is added
    again = V.validate_facts(done, context)[0].where("doc_id = 'f' and metric = 'dps'").first()
    assert again.validation_notes == "dividend per share is negative; read with a confidence of 0.60, below 0.80; dividend per share is negative"


def test_the_first_of_equal_extremes_is_shown(spark):
    rows = spark.createDataFrame([("A", 2.0, None, "high", "FY to 2000", ""), ("B", 2.0, None, "high", "FY to 2000", ""), ("C", 1.0, None, "low", "FY to 2000", ""), ("D", 1.0, None, "low", "FY to 2000", "")], "ticker string, roe double, eps double, data_confidence string, income_period string, flags string")
    review = spark.createDataFrame([], "ticker string, rule string, reason string, ord long")
    lines = [r.line for r in SM.summary_lines("t", rows, review).where("section = 4").collect()]
    assert "- ROE: highest A (200.00%); lowest C (100.00%)" in lines and "- EPS: NA" in lines
