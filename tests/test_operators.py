import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from plumbline.operators import flags as FL
from plumbline.operators import history as H
from plumbline.operators import liquidity as L
from plumbline.operators import overlays as O
from plumbline.operators import ranking as RK
from plumbline.operators import screening as S
from plumbline.operators import summary as SM
from plumbline.operators import validation as V
from plumbline.sources import pages as SP
from plumbline.sources import sinks
from plumbline.streaming import daily

D = dt.date


def test_best_fact_first_wins(spark):
    rows = [("A", "eps", 1.0, 0.9, None, 1), ("A", "eps", 2.0, 0.9, None, 2), ("A", "rev", 3.0, 0.62, None, 3), ("A", "dps", 4.0, 0.9, None, 4), ("A", "dps", 5.0, 0.8, "c1", 5), ("A", "cash", None, 0.9, None, 6)]
    f = spark.createDataFrame(rows, "ticker string, metric string, value double, confidence double, correction_id string, ord long")
    assert {r.metric: r.value for r in RK.best_facts(f).collect()} == {"eps": 1.0, "dps": 5.0}


def test_documents_merge(spark):
    schema = "doc_id string, ticker string, kind string, title string, period_end date, publication_date date, url string, discovery_url string, ord long"
    old = spark.createDataFrame([("c1", "A", "annual_report", "r", D(2025, 3, 31), D(2025, 6, 1), "u1", None, 1), ("c2", "A", "annual_report", "r", D(2024, 3, 31), None, "u2", None, 2)], schema)
    new = spark.createDataFrame([("d1", "A", "annual_report", "r", D(2025, 3, 31), D(2025, 7, 1), "u3", "x", 3), ("d2", "A", "annual_report", "r", D(2024, 3, 31), None, "u2", "x", 4)] + [(f"i{m}", "A", "interim_statement", "r", D(2025, m, 28), D(2025, m, 28), f"v{m}", "x", 10 + m) for m in (6, 9)], schema)
    assert {r.doc_id for r in RK.merge_documents(old, new).collect()} == {"d1", "d2", "i9"}
    assert {r.doc_id for r in RK.latest_documents(old.unionByName(new)).collect()} == {"d1", "c2", "i9"}


def test_history_prefers_current(spark):
    f = spark.createDataFrame([("A", "eps", D(2025, 3, 31), 90.0, 80.0, 0.9, 12, 1), ("A", "eps", D(2026, 3, 31), 100.0, 95.0, 0.9, 12, 2), ("A", "eps", D(2024, 3, 31), 70.0, 0.1, 0.9, 15, 3), ("A", "revenue", D(2026, 3, 31), 5.0, 0.01, 0.9, None, 4)], "ticker string, metric string, period_end date, value double, previous_value double, confidence double, period_months int, ord long")
    h = H.history_rows(f)
    got = {(r.metric, r.financial_year_end): (r.value, r.value_basis) for r in H.deduplicate(h).collect()}
    assert got == {("eps", D(2026, 3, 31)): (100.0, "current"), ("eps", D(2025, 3, 31)): (90.0, "current"), ("eps", D(2024, 3, 31)): (80.0, "comparative"), ("revenue", D(2026, 3, 31)): (5.0, "current")}


def _history(spark, rows):
    return spark.createDataFrame([("A", m, s, y, v, i) for i, (m, s, y, v) in enumerate(rows)], "ticker string, metric string, source_period_end date, financial_year_end date, value double, ord long")


def _chain(spark, metric, v0, v1, p2, previous, months=12, found=True):
    y = [D(2026, 3, 31), D(2025, 3, 31), D(2024, 3, 31)]
    h = _history(spark, [(metric, y[0], y[0], v0), (metric, y[1], y[1], v1), (metric, y[1], y[2], p2)]).where("value is not null")
    ends = spark.createDataFrame([("A", metric, y[0], found, previous, months)], "ticker string, metric string, end date, found boolean, previous double, months int")
    r = H.chained_cagr(h, ends).first()
    return r.cagr, r.note


def test_chained_cagr_and_restatement(spark):
    assert _chain(spark, "revenue", 1000.0, 800.0, 640.0, 800.0) == (pytest.approx(0.25), None)
    # the comparative is that of the selected fact, whether or not the history keeps it
    assert _chain(spark, "eps", 9.0, 21.6, 20.0, 7.2) == (None, "restated from 21.60 to 7.20")
    assert _chain(spark, "eps", 9.0, 7.3, 5.0, 7.2)[1] is None and _chain(spark, "eps", 9.0, 7.4, 5.0, 7.2)[1] is not None
    # a year of zero gives no basis, though growth over it could be calculated
    assert _chain(spark, "revenue", 100.0, 0.0, 81.0, 0.0) == (None, "no comparative to check the basis by") == _chain(spark, "revenue", 100.0, 90.0, 81.0, None)
    assert _chain(spark, "revenue", 100.0, 90.0, -81.0, 90.0) == (None, "undefined: the start isn't positive or the end is negative") == _chain(spark, "revenue", -1.0, 90.0, 81.0, 90.0)
    assert _chain(spark, "revenue", 100.0, 90.0, None, 90.0) == (None, "chain of years is incomplete")
    assert _chain(spark, "revenue", 100.0, 90.0, 81.0, 90.0, months=15) == (None, "the latest period isn't of twelve months")
    assert _chain(spark, "revenue", 100.0, 90.0, 81.0, None, found=None) == (None, "no value in the latest annual report")


def test_declines(spark):
    y = [D(2026, 3, 31), D(2025, 3, 31), D(2024, 3, 31)]
    split = _history(spark, [("eps", y[0], y[0], 1.0), ("eps", y[0], y[1], 0.9), ("eps", y[1], y[1], 9.0), ("eps", y[1], y[2], 10.0)])
    falls = _history(spark, [("eps", y[0], y[0], 1.0), ("eps", y[0], y[1], 2.0), ("eps", y[1], y[1], 2.0), ("eps", y[1], y[2], 3.0)])
    assert [r.declined for r in H.consecutive_decline(split).collect()] == [False]
    assert [r.declined for r in H.consecutive_decline(falls).collect()] == [True]
    years = lambda v: spark.createDataFrame([("A", "eps", D(2024 + i, 3, 31), float(x)) for i, x in enumerate(v)], "ticker string, metric string, financial_year_end date, value double")
    assert H.three_year_decline(years([3, 2, 1])).first().declined and not H.three_year_decline(years([2, 1, 3])).first().declined and not H.three_year_decline(years([2, 1])).first().declined


def test_trailing_and_basis(spark):
    a = spark.createDataFrame([("A", "revenue", 1000.0, 0.9, D(2026, 3, 31)), ("A", "eps", 9.0, 0.9, D(2026, 3, 31)), ("B", "revenue", 1000.0, 0.9, D(2026, 3, 31)), ("B", "eps", 9.0, 0.9, D(2026, 3, 31))], "ticker string, metric string, value double, confidence double, annual_end date")
    i = spark.createDataFrame([("A", "revenue", 300.0, 250.0), ("A", "eps", 2.7, 1.8), ("B", "revenue", 0.3, 0.2), ("B", "eps", 2.7, 1.8)], "ticker string, metric string, value double, previous_value double")
    i = i.select("*", F.lit(0.85).alias("confidence"), F.lit(3).alias("months"), F.lit("2026-06-30").cast("date").alias("period_end"), F.lit("2025-06-30").cast("date").alias("prior_end"))
    t = S.trailing_rows(a, i)
    assert {(r.ticker, r.metric): round(r.ttm, 6) for r in t.collect()} == {("A", "revenue"): 1050.0, ("A", "eps"): 9.9}
    assert {r.ticker: r.income_basis for r in S.basis(a, t).collect()} == {"A": "ttm", "B": "fy"}


def test_flags(spark):
    df = spark.createDataFrame([(-1.0, 5.0, -1.0, 0.1, 3.0, -2.0, 1.5, 10.0, 6, True, 15), (1.0, 5.0, 9.0, 1.0, None, 2.0, None, None, 2, False, 12)], "eps double, net_profit double, operating_cash_flow double, ocf_to_net_profit double, debt_to_equity double, total_equity double, payout double, average_volume double, liquidity_days int, one_off boolean, months int")
    a, b = [r.f for r in df.select(FL.company_flags(df).alias("f")).collect()]
    assert a.split("; ") == ["negative EPS", "negative operating cash flow", "high debt-to-equity", "operating cash flow materially below net profit", "negative equity", "dividend payout above 100%", "low trading liquidity (average daily volume)", "possible one-off profit or loss", "financial period of 15 months (year-end changed)"]
    assert b == "multi-day liquidity unavailable (2/5 observations)"
    rows = df.withColumn("ticker", F.lit("A")).withColumn("flags", FL.company_flags(df))
    assert FL.flag_records(rows).where("flag = 'negative EPS'").first().evidence == "eps = -1.0" and FL.flag_counts(rows).count() == 10


def test_relative_flags(spark):
    df = spark.createDataFrame([("a", 10.0, 1.0), ("b", 12.0, 1.2), ("HIGH", 50.0, 4.0), ("LOW", 8.0, 0.2), ("NEG", -20.0, -1.0)], "ticker string, pe double, pb double")
    got = {r.ticker: r.relative_flags for r in FL.relative_flags(df, []).collect()}
    assert got["HIGH"].count("high") == 2 and "P/B unusually low" in got["LOW"] and got["NEG"] == ""


def _doc(spark, **changed):
    base = {"revenue": 1000.0, "net_profit": 100.0, "eps": 1.0, "dps": 0.5, "total_assets": 100.0, "total_liabilities": 60.0, "total_equity": 40.0, "ordinary_equity": 40.0, "bvps": 0.4, "ordinary_shares_outstanding": 100.0, "market_shares": None} | changed
    confs = {f"{m}_conf": 0.9 for m in base if m != "market_shares"} | {k: v for k, v in changed.items() if k.endswith("_conf")}
    return spark.range(1).select(*[F.lit(v).cast("double").alias(k) for k, v in (base | confs).items()])


@pytest.mark.parametrize("changed,rule", [({"total_liabilities": 20.0, "total_equity": 30.0}, "accounting_equation"), ({"revenue_conf": 0.62}, "low_confidence"), ({"net_profit": 9000.0, "eps": 90.0}, "profit_revenue_scale"), ({"eps": -1.0}, "eps_profit_sign"), ({"bvps": 16.0}, "bvps_identity"), ({"dps": 36.3}, "dps_range"), ({"eps": 2025.0, "market_shares": 100.0}, "eps_identity"), ({"ordinary_equity_conf": 0.5}, "low_confidence"), ({"ordinary_shares_outstanding": 60471501.0, "market_shares": 265e6, "eps": 0.0000003}, "share_count_identity")])
def test_validation_rules(spark, changed, rule):
    r = V.validate(_doc(spark, **changed)).first()
    assert rule in r.rules
    if rule == "accounting_equation":
        assert r.total_assets_conf == pytest.approx(0.75) and r.total_assets == 100.0


def test_validation_rescales_shares(spark):
    r = V.validate(_doc(spark, ordinary_shares_outstanding=265252.0, net_profit=1.18e9, revenue=1e10, eps=4.45, bvps=None)).first()
    assert r.shares_factor == 1000 and r.ordinary_shares_outstanding == 265252000 and r.ordinary_shares_outstanding_conf == 0.9 and list(r.rules) == []
    assert "share_count_identity" in V.validate(_doc(spark, ordinary_shares_outstanding=60471501.0, net_profit=1.18e9, revenue=1e10, eps=4.45, bvps=None)).first().rules
    assert list(V.validate(_doc(spark)).first().rules) == []


def test_validation_references(spark):
    check = lambda **changed: V.validate(_doc(spark, **changed)).first()
    # a count near any reference stands, even where another one is far off
    r = check(market_shares=100.0, eps=0.75)
    assert list(r.rules) == [] and r.ordinary_shares_outstanding_conf == 0.9
    assert "share_count_identity" in check(market_shares=200.0, eps=0.5).rules
    # EPS is judged by the market's count alone
    assert list(check(eps=50.0, ordinary_shares_outstanding=2.0, bvps=20.0).rules) == []
    # what is printed on the statement is noted and stands
    printed = V.validate(_doc(spark, bvps=75.0).withColumn("bvps_printed", F.lit(True))).first()
    assert list(printed.rules) == ["bvps_identity"] and printed.bvps_conf == 0.9 and check(bvps=16.0).bvps_conf == 0.6
    # the market's count stands in for one that isn't reliable; no book value is expected of negative equity
    assert list(check(ordinary_shares_outstanding_conf=0.7, ordinary_shares_outstanding=7.0, market_shares=100.0, eps=None).rules) == ["low_confidence", "share_count_identity"]
    assert "bvps_identity" not in check(ordinary_equity=-40.0).rules
    loose = V.validate(_doc(spark, ordinary_shares_outstanding=7.0, bvps=16.0).withColumn("reconciled", F.lit(False))).first()
    assert list(loose.rules) == []


def test_validation_of_long_facts(spark):
    s = "doc_id string, metric string, value double, confidence double, ord long, extraction_method string"
    rows = [("d", "total_assets", 100.0, 0.9, 1, "x"), ("d", "total_assets", 999.0, 0.9, 2, "x"), ("d", "total_liabilities", 20.0, 0.9, 3, "x"), ("d", "total_equity", 30.0, 0.9, 4, "x"), ("d", "cash", 1.0, 0.62, 5, "x"), ("e", "eps", 4.45, 0.9, 1, "x"), ("e", "net_profit", 1.18e9, 0.9, 2, "x"), ("e", "ordinary_shares_outstanding", 265252.0, 0.9, 3, "x")]
    context = spark.createDataFrame([("e", None, True)], "doc_id string, market_shares double, reconciled boolean")
    facts, issues = V.validate_facts(spark.createDataFrame(rows, s), context)
    got = {(r.doc_id, r.metric, r.ord): (r.value, round(r.confidence, 2)) for r in facts.collect()}
    assert len(got) == 8 and got["d", "total_assets", 1] == (100.0, 0.75) and got["d", "total_assets", 2] == (999.0, 0.9) and got["e", "ordinary_shares_outstanding", 3] == (265252000.0, 0.9)
    assert sorted((r.metric, r.rule) for r in issues.collect()) == [("cash", "low_confidence"), ("total_assets", "accounting_equation"), ("total_equity", "accounting_equation"), ("total_liabilities", "accounting_equation")]
    filled = V.with_identities(spark.createDataFrame([("d", "total_assets", 100.0, 0.9, 1, "x"), ("d", "total_equity", 40.0, 0.8, 2, "x")], s))
    assert {(r.metric, r.value, r.confidence, r.extraction_method) for r in filled.collect()} >= {("total_liabilities", 60.0, 0.8, "derived"), ("ordinary_equity", 40.0, 0.8, "derived")}


def test_liquidity(spark):
    s = "trading_date date, ticker string, share_volume double, ord long"
    a = spark.createDataFrame([(D(2026, 10, 1), "A", 100.0, 1), (D(2026, 10, 2), "A", 300.0, 2), (D(2026, 10, 3), "A", 400.0, 3)], s)
    b = spark.createDataFrame([(D(2026, 10, 3), "A", 500.0, 4)], s)
    merged = L.upsert(a, b)
    r = L.summaries(merged, 2).first()
    assert merged.count() == 3 and (r.average_volume, r.median_volume, r.liquidity_days, r.first_date) == (400.0, 400.0, 2, D(2026, 10, 2))


def test_universe_and_corrections(spark):
    s = "ticker string, name string, industry_group string"
    official = spark.createDataFrame([("KEEP", "k", "g"), ("DROP", "d", "g")], s)
    inc, exc, ovr = spark.createDataFrame([("ADD", "a", "g"), ("KEEP", None, "other")], s), spark.createDataFrame([("DROP",), ("NONE",)], "ticker string"), spark.createDataFrame([("KEEP", "renamed", None)], s)
    got = {r.ticker: (r.name, r.membership, r.included) for r in O.apply_universe(official, inc, exc, ovr).collect()}
    assert got == {"KEEP": ("renamed", "official", True), "ADD": ("a", "configured_include", True), "DROP": ("d", "official", False), "NONE": (None, "configured_exclusion_not_present", False)}
    with pytest.raises(O.OverlayError, match="XX"):
        O.apply_universe(official, inc, exc, spark.createDataFrame([("XX", "n", None)], s))
    c = "id string, status string, ticker string, metric string, financial_period date, source_document string, value double, source_page int, reason string, author string"
    row = ("1", "active", "A", "eps", D(2025, 3, 31), "doc", 1.0, 1, "r", "me")
    O.check_corrections(spark.createDataFrame([row, ("2", "superseded", *row[2:])], c))
    for bad in ([row, ("2", *row[1:])], [("1", "maybe", *row[2:])], [row, row], [(*row[:7], 0, *row[8:])]):
        with pytest.raises(O.OverlayError):
            O.check_corrections(spark.createDataFrame(bad, c))


def test_summary(spark):
    rows = spark.createDataFrame([("r1", "A", "x", 3), ("r1", "B", "y", 1), ("r1", "A", "z", 2), ("r1", "A", "w", 4), ("r2", "C", "x", 5)], "rule string, ticker string, reason string, ord long")
    got = {r.rule: (r.n, r.tickers, r.reasons, r.more) for r in SM.warning_groups(rows).collect()}
    assert got == {"r1": (4, "A, B", "y | z | x", 1), "r2": (1, "C", "x", 0)}
    assert "- n: 2" in SM.markdown("t", {"s": [{"n": 2}], "e": []})
    many = spark.range(200_000).selectExpr("'r' as rule", "cast(id % 3 as string) as ticker", "concat('reason ', id) as reason", "200000 - id as ord")
    assert [tuple(r) for r in SM.warning_groups(many).collect()] == [("r", 200_000, "0, 1, 2", "reason 199999 | reason 199998 | reason 199997", 199_997)]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"gicsSectors": [{"name": "S", "groups": [{"name": "Real Estate"}, {"name": "Banks"}]}]}))
    g = SP.industry_groups(spark, str(tmp_path / "s.json"))
    assert SP.resolve_group(g, "Real Estate Management & Development") == "Real Estate"
    with pytest.raises(ValueError, match="Banks"):
        SP.resolve_group(g, "nothing")
    (tmp_path / "c.json").write_text(json.dumps({"companies": [{"symbol": "A.N", "name": "a", "market": {"lastTradedPrice": 0, "closingPrice": 5.0}}]}))
    assert SP.companies(spark, str(tmp_path / "c.json")).first().current_price == 5.0
    (tmp_path / "f.json").write_text("\n".join(json.dumps({"id": i, "path": p, "uploadedDate": "05 Mar 2025 03:15:00 PM", "fileText": t, "symbol": "A"}) for i, (p, t) in enumerate([("x", "Annual Report"), (None, "Annual Report"), ("y", "Circular")])))
    assert SP.filings(spark, str(tmp_path / "f.json"), "2025-01-01", "2025-12-31").count() == 1
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1")
    (tmp_path / "b.pdf").write_bytes(b"<html>")
    assert SP.pdf_files(spark, f"{tmp_path}/*.pdf").count() == 1
    assert spark.range(1).select(SP.table_rows(F.array(F.array(F.lit("a"), F.lit(None).cast("string")), F.array(F.lit(" "), F.lit("")))).alias("x")).first().x == ["a | "]
    sinks.write_all({"t": spark.range(3)}, str(tmp_path / "out"))
    sinks.write_review(spark.range(3), str(tmp_path / "rev"))
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/csv/t").count() == 3 and spark.read.json(f"{tmp_path}/rev/extraction_warnings_jsonl").count() == 3


def test_ocr_routing(spark):
    p = spark.createDataFrame([("d", 1, True, True, False), ("d", 2, False, False, False), ("d", 3, False, False, True)] + [("e", i, True, True, False) for i in range(4)], "doc string, page int, thin boolean, image boolean, statement boolean")
    assert {(r.doc, r.page) for r in SP.ocr_candidates(p, "doc", "page").where("ocr").collect()} == {("e", i) for i in range(4)}


def test_stream_equals_batch(spark):
    path = "/root/testdata/sf0.001/events.parquet"
    got = {(r.ticker, r.trading_date): r.trade_count for r in daily.daily_counts_available_now(spark, path).collect()}
    want = spark.read.parquet(path).groupBy(F.col("user_id"), F.col("ts").cast("date").alias("d")).count().collect()
    assert got == {(r.user_id, r.d): r["count"] for r in want}


def test_stream_upsert(spark, tmp_path):
    s = "trading_date date, ticker string, share_volume double, ord long"
    target = str(tmp_path / "table")
    spark.sparkContext.setCheckpointDir(str(tmp_path / "ck"))
    for rows in ([(D(2026, 1, 1), "A", 1.0, 1)], [(D(2026, 1, 1), "A", 2.0, 2), (D(2026, 1, 2), "A", 3.0, 3)]):
        spark.createDataFrame(rows, s).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = daily.upsert_stream(spark.readStream.schema(s).parquet(str(tmp_path / "in")), target, str(tmp_path / "state")).trigger(availableNow=True).start()
        q.awaitTermination()
    from plumbline.streaming import versions

    assert {(r.trading_date, r.share_volume) for r in versions.read(spark, target, s).collect()} == {(D(2026, 1, 1), 2.0), (D(2026, 1, 2), 3.0)}


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 10 and set(e.oracle_sql()) <= set(e.queries())
