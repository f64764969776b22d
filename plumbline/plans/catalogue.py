"""Queries over the driver's tables, each with an equivalent in DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import periods as P
from ..functions import ratios as R
from ..functions import text as X
from ..operators import flags as FL
from ..operators import history as H
from ..operators import layout as LY
from ..operators import liquidity as L
from ..operators import overlays as O
from ..operators import page_rows as PR
from ..operators import phrases as PH
from ..operators import provenance as PV
from ..operators import ranking as RK
from ..operators import screening as S
from ..operators import selection as SL
from ..operators import summary as SM
from ..operators import validation as V
from ..streaming import daily
from . import facts as A

C = F.col
QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql.strip()
        return f

    return add


def r6(df):
    """Doubles to six digits, so that both engines show the same."""
    return df.select(*[F.round(c.name, 6).alias(c.name) if isinstance(c.dataType, T.DoubleType) else C(c.name) for c in df.schema])


def R6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def big(*names):
    return [C(n).cast("bigint").alias(n) for n in names]


# ---------------------------------------------------------------- facts and ratios
@query(f"WITH {A.BASE} SELECT ticker, fy, metric, round(value, 6) AS value FROM (UNPIVOT (SELECT ticker, CAST(fy AS INT) AS fy, {', '.join(A.FACTS)} FROM w) ON {', '.join(A.FACTS)} INTO NAME metric VALUE value)")
def annual_facts_long(spark, sf):
    return r6(A.long_facts(A.annual(spark, sf)).select("ticker", "fy", "metric", "value"))


_G = lambda m: f"(({m} - {m}_prev) / nullif(abs({m}_prev), 0))"


@query(f"WITH {A.BASE_PREV} SELECT ticker, CAST(fy AS INT) AS fy, round({_G('revenue')}, 6) AS revenue_growth, round({_G('net_profit')}, 6) AS net_profit_growth, round({_G('eps')}, 6) AS eps_growth FROM p")
def growth_yoy(spark, sf):
    w = A.with_previous(A.annual(spark, sf))
    return r6(w.select("ticker", "fy", *[R.growth(C(m), C(f"{m}_prev")).alias(f"{m}_growth") for m in ("revenue", "net_profit", "eps")]))


@query(f"WITH {A.BASE_PREV} SELECT ticker, CAST(fy AS INT) AS fy, round({_G('net_profit')}, 6) AS net_profit_growth FROM p WHERE net_profit_prev < 0")
def negative_growth(spark, sf):
    w = A.with_previous(A.annual(spark, sf)).where("net_profit_prev < 0")
    return r6(w.select("ticker", "fy", R.growth(C("net_profit"), C("net_profit_prev")).alias("net_profit_growth")))


def _history(spark, sf, metrics=("revenue", "eps"), sums=None):
    """Observations of current and comparative year of each report."""
    w = A.with_previous(A.annual(spark, sf, sums))
    parts = [w.select("ticker", F.lit(m).alias("metric"), "period_end", C(m).alias("value"), C(f"{m}_prev").alias("previous_value"), C("confidence").cast("decimal(3,2)").alias("confidence"), F.lit(12).alias("period_months"), C("fy").cast("long").alias("ord")) for m in metrics]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return H.history_rows(out, metrics)


_HIST = f"""{A.BASE_PREV},
f AS (SELECT ticker, 'revenue' AS metric, fy, period_end, revenue AS value, revenue_prev AS prev, confidence FROM p UNION ALL SELECT ticker, 'eps', fy, period_end, eps, eps_prev, confidence FROM p),
h AS (SELECT ticker, metric, period_end AS source_period_end, period_end AS financial_year_end, value, 'current' AS value_basis, confidence, fy AS ord FROM f WHERE confidence >= 0.8
 UNION ALL SELECT ticker, metric, period_end, make_date(CAST(fy AS INT) - 1, 12, 31), prev, 'comparative', confidence, fy FROM f WHERE confidence >= 0.8 AND abs(prev) >= abs(value) * 0.01)"""


@query(f"WITH {_HIST} SELECT ticker, metric, source_period_end, financial_year_end, value_basis, round(value, 6) AS value FROM h")
def history_rows_eligibility(spark, sf):
    return r6(_history(spark, sf).select("ticker", "metric", "source_period_end", "financial_year_end", "value_basis", "value"))


@query(f"WITH {_HIST} SELECT ticker, metric, financial_year_end, value_basis, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY ticker, metric, financial_year_end ORDER BY (value_basis = 'current') DESC, source_period_end DESC, confidence DESC, ord) AS r FROM h) WHERE r = 1")
def history_dedup_desc(spark, sf):
    return r6(H.deduplicate(_history(spark, sf)).select("ticker", "metric", "financial_year_end", "value_basis", "value"))


@query(f"""WITH {_HIST},
c AS (SELECT ticker, metric, max(value) FILTER (source_period_end = DATE '2000-12-31' AND value_basis = 'current') AS v0, max(value) FILTER (source_period_end = DATE '1999-12-31' AND value_basis = 'current') AS v1, max(value) FILTER (source_period_end = DATE '1999-12-31' AND value_basis = 'comparative') AS p2 FROM h GROUP BY ALL),
e AS (SELECT DISTINCT ticker, m.metric FROM w, (VALUES ('revenue'), ('eps')) m(metric)), l AS (SELECT ticker, metric, prev FROM f WHERE fy = 2000 AND confidence >= 0.8),
j AS (SELECT e.ticker, e.metric, v0, p2, CASE WHEN l.ticker IS NULL THEN 'no value in the latest annual report' WHEN v0 IS NULL OR v1 IS NULL OR p2 IS NULL THEN 'chain of years is incomplete' WHEN prev IS NULL OR v1 = 0 THEN 'no comparative to check the basis by'
  WHEN abs(prev - v1) > abs(v1) * CASE WHEN e.metric = 'eps' THEN 0.02 ELSE 0.1 END THEN 'restated from ' || format('{{:,.2f}}', v1) || ' to ' || format('{{:,.2f}}', prev) END AS why
 FROM e LEFT JOIN c ON c.ticker = e.ticker AND c.metric = e.metric LEFT JOIN l ON l.ticker = e.ticker AND l.metric = e.metric)
SELECT ticker, metric, CASE WHEN why IS NULL AND v0 >= 0 AND p2 > 0 THEN round(pow(v0 / p2, 0.5) - 1, 6) END AS cagr, coalesce(why, CASE WHEN NOT (v0 >= 0 AND p2 > 0) THEN 'undefined: the start isn''t positive or the end is negative' END) AS note FROM j""")
def cagr_3y_chain(spark, sf):
    sums = A.period_sums(spark, sf)
    w = A.with_previous(A.annual(spark, sf, sums))
    latest = w.where((C("fy") == A.LAST_FY) & (C("confidence") >= 0.8))
    both = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), C(f"{m}_prev").alias("previous")) for m in ("revenue", "eps")])).alias("x")
    facts = latest.select("ticker", both).select("ticker", "x.metric", F.lit(True).alias("found"), "x.previous")
    ends = w.select("ticker").distinct().select("ticker", F.explode(F.array(F.lit("revenue"), F.lit("eps"))).alias("metric"), F.lit("2000-12-31").cast("date").alias("end"), F.lit(12).alias("months"))
    return r6(H.chained_cagr(_history(spark, sf, sums=sums), ends.join(facts, ["ticker", "metric"], "left")))


@query(f"""WITH {_HIST},
r AS (SELECT ticker, metric, source_period_end AS s, max(value) FILTER (value_basis = 'current') AS now, max(value) FILTER (value_basis = 'comparative') AS before FROM h GROUP BY ALL),
t AS (SELECT *, row_number() OVER (PARTITION BY ticker, metric ORDER BY s DESC) AS k FROM r)
SELECT ticker, metric, count(*) = 2 AND max(year(s)) - min(year(s)) = 1 AND bool_and(coalesce(now < before, false)) AS declined FROM t WHERE k <= 2 GROUP BY ALL""")
def consecutive_decline(spark, sf):
    return H.consecutive_decline(_history(spark, sf))


@query(f"""WITH {A.BASE}, t AS (SELECT ticker, fy, revenue, row_number() OVER (PARTITION BY ticker ORDER BY fy DESC) AS k FROM w),
v AS (SELECT ticker, count(*) AS n, max(fy) - min(fy) AS span, max(revenue) FILTER (k = 1) AS a, max(revenue) FILTER (k = 2) AS b, max(revenue) FILTER (k = 3) AS c FROM t WHERE k <= 3 GROUP BY ticker)
SELECT ticker, 'revenue' AS metric, coalesce(n = 3 AND span = 2 AND a < b AND b < c, false) AS declined FROM v""")
def three_year_decline(spark, sf):
    return H.three_year_decline(A.annual(spark, sf).select("ticker", F.lit("revenue").alias("metric"), C("period_end").alias("financial_year_end"), C("revenue").alias("value")))


def _trailing(spark, sf, sums=None):
    # the sums are the one expensive step and small once made: both tables come from the same aggregation
    sums = A.period_sums(spark, sf) if sums is None else sums
    a = A.annual(spark, sf, sums).where(C("fy") == A.LAST_FY)
    long = S.unpivot(a, ["ticker", "confidence", "period_end"], ["revenue", "net_profit", "operating_cash_flow", "capital_expenditure", "eps"]).withColumnRenamed("period_end", "annual_end")
    return a, long, S.trailing_rows(long, A.interim(spark, sf, sums))


@query(f"WITH {A.BASE}, {A.INTERIM} SELECT ticker, metric, {R6('ttm', 'annual', 'ytd', 'prior')}, round(confidence, 6) AS confidence FROM tr")
def ttm_bridge_h1(spark, sf):
    return r6(_trailing(spark, sf)[2].select("ticker", "metric", "ttm", "annual", "ytd", "prior", "confidence"))


QUERIES["ttm_metric_join"] = lambda spark, sf: r6(_trailing(spark, sf)[2].select("ticker", "metric", "annual", "ytd", "prior"))
ORACLES["ttm_metric_join"] = f"WITH {A.BASE}, {A.INTERIM} SELECT ticker, metric, {R6('annual', 'ytd', 'prior')} FROM tr"
QUERIES["min_confidence"] = lambda spark, sf: r6(_trailing(spark, sf)[2].groupBy("ticker").agg(F.min("confidence").alias("confidence")))
ORACLES["min_confidence"] = f"WITH {A.BASE}, {A.INTERIM} SELECT ticker, round(min(confidence), 6) AS confidence FROM tr GROUP BY ticker"


@query(f"""WITH {A.BASE}, {A.INTERIM} SELECT al.ticker,
 CASE WHEN coalesce(bool_and(tr.ticker IS NOT NULL) FILTER (al.metric IN ('revenue', 'net_profit', 'eps')), false) THEN 'ttm' ELSE 'fy' END AS income_basis,
 CASE WHEN coalesce(bool_or(tr.ticker IS NOT NULL) FILTER (al.metric = 'operating_cash_flow'), false) AND coalesce(bool_and(tr.ticker IS NOT NULL) FILTER (al.metric = 'capital_expenditure'), true) THEN 'ttm' ELSE 'fy' END AS cash_basis
 FROM al LEFT JOIN tr ON al.ticker = tr.ticker AND al.metric = tr.metric GROUP BY al.ticker""")
def basis_completeness(spark, sf):
    _, long, t = _trailing(spark, sf)
    return S.basis(long, t)


@query("""WITH q AS (SELECT o_custkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY ALL),
n AS (SELECT *, lag(y * 4 + q, 3) OVER z AS p3, count(*) OVER (z ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS n, sum(v) OVER (z ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS s FROM q WINDOW z AS (PARTITION BY o_custkey ORDER BY y, q))
SELECT o_custkey AS customer, CAST(y AS INT) AS y, CAST(q AS INT) AS q, CASE WHEN n = 4 AND y * 4 + q - p3 = 3 THEN round(CAST(s AS DOUBLE), 6) END AS ttm FROM n""")
def ttm_four_quarters(spark, sf):
    o = A.table(spark, sf, "orders")
    q = o.groupBy(C("o_custkey").alias("customer"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")).agg(F.sum(C("o_totalprice").cast("decimal(18,2)")).alias("v"))
    q = q.withColumns({"end": F.last_day(F.make_date("y", C("q") * 3, F.lit(1))), "months": F.lit(3)})
    return r6(S.four_quarters(q, ["customer"], "end", "v", "months").select("customer", "y", "q", C("ttm").cast("double").alias("ttm")))


def _screened(spark, sf, sums=None):
    """Wide rows of the last fiscal year, with trailing flows and all ratios."""
    sums = A.period_sums(spark, sf) if sums is None else sums
    full = A.annual(spark, sf, sums)
    wide = A.with_previous(full).where(C("fy") == A.LAST_FY)
    a = full.where(C("fy") == A.LAST_FY)
    long = S.unpivot(a, ["ticker", "confidence", "period_end"], ["revenue", "net_profit", "operating_cash_flow", "capital_expenditure", "eps"]).withColumnRenamed("period_end", "annual_end")
    t = S.trailing_rows(long, A.interim(spark, sf, sums))
    pivot = t.groupBy(C("ticker").alias("t2")).agg(*[F.max(F.when(C("metric") == m, C("ttm"))).alias(f"ttm_{m}") for m in ("revenue", "net_profit", "operating_cash_flow", "capital_expenditure", "eps")])
    b = S.basis(long, t).withColumnRenamed("ticker", "t3")
    wide = wide.join(pivot, C("ticker") == C("t2"), "left").join(b, C("ticker") == C("t3"), "left").drop("t2", "t3")
    return S.screening_metrics(S.with_flows(wide))


_EQ = "coalesce(ordinary_equity, total_equity)"
_OPEN = "CASE WHEN ordinary_equity IS NOT NULL THEN ordinary_equity_prev ELSE coalesce(ordinary_equity_prev, total_equity_prev) END"
_BV = "(ordinary_equity / nullif(ordinary_shares_outstanding, 0))"
_POS = lambda e: f"CASE WHEN {e} > 0 THEN {e} END"
_SCREEN = f"""{A.BASE_PREV}, {A.INTERIM},
tp AS (SELECT ticker AS t2, {', '.join(f"max(ttm) FILTER (metric = '{m}') AS ttm_{m}" for m in ('revenue', 'net_profit', 'operating_cash_flow', 'capital_expenditure', 'eps'))} FROM tr GROUP BY ticker),
bs AS (SELECT *, CASE WHEN ttm_revenue IS NOT NULL AND ttm_net_profit IS NOT NULL AND ttm_eps IS NOT NULL THEN 'ttm' ELSE 'fy' END AS income_basis, CASE WHEN ttm_operating_cash_flow IS NOT NULL AND ttm_capital_expenditure IS NOT NULL THEN 'ttm' ELSE 'fy' END AS cash_basis FROM p LEFT JOIN tp ON p.ticker = t2 WHERE fy = 2000),
fw AS (SELECT *, {', '.join(f"CASE WHEN income_basis = 'ttm' THEN ttm_{m} ELSE {m} END AS flow_{m}" for m in ('revenue', 'net_profit', 'eps'))}, {', '.join(f"CASE WHEN cash_basis = 'ttm' THEN ttm_{m} ELSE {m} END AS flow_{m}" for m in ('operating_cash_flow', 'capital_expenditure'))}, CASE WHEN cash_basis = 'ttm' THEN ttm_net_profit ELSE net_profit END AS cash_net_profit FROM bs),
sc AS (SELECT *, {_G('revenue')} AS revenue_growth, {_G('net_profit')} AS net_profit_growth, {_G('eps')} AS eps_growth,
 coalesce(net_profit_attributable, net_profit) / ({_POS(f'(({_EQ} + {_OPEN}) / 2)')}) AS roe, net_profit / nullif((total_assets + total_assets_prev) / 2, 0) AS roa,
 total_debt / ({_POS(_EQ)}) AS debt_to_equity, total_debt - cash AS net_debt, flow_operating_cash_flow - abs(flow_capital_expenditure) AS free_cash_flow,
 flow_operating_cash_flow / nullif(cash_net_profit, 0) AS ocf_to_net_profit, {_BV} AS bvps_used, price / ({_POS('flow_eps')}) AS pe, flow_eps / nullif(price, 0) AS earnings_yield,
 price / ({_POS(_BV)}) AS pb, dps / nullif(price, 0) AS dividend_yield, dps / ({_POS('eps')}) AS payout FROM fw)"""


@query(f"WITH {_SCREEN} SELECT ticker, income_basis, cash_basis, {R6('flow_revenue', 'flow_net_profit', 'flow_eps', *S.RATIOS)} FROM sc")
def company_screening(spark, sf):
    return r6(_screened(spark, sf).select("ticker", "income_basis", "cash_basis", "flow_revenue", "flow_net_profit", "flow_eps", *S.RATIOS))


@query(f"WITH {_SCREEN} SELECT ticker, {R6('roe', 'roa')} FROM sc")
def roe_roa_avg_base(spark, sf):
    return r6(_screened(spark, sf).select("ticker", "roe", "roa"))


@query(f"WITH {_SCREEN} SELECT ticker, {R6('pe', 'earnings_yield', 'pb', 'dividend_yield', 'payout', 'debt_to_equity', 'net_debt')}, CASE WHEN flow_eps <= 0 THEN 'not meaningful: EPS is not positive' END AS pe_note FROM sc")
def valuation_ratios(spark, sf):
    return r6(_screened(spark, sf).select("ticker", "pe", "earnings_yield", "pb", "dividend_yield", "payout", "debt_to_equity", "net_debt", R.not_meaningful(C("flow_eps"), "EPS").alias("pe_note")))


@query(f"WITH {_SCREEN}, l AS (UNPIVOT (SELECT ticker, {', '.join(S.RATIOS)} FROM sc) ON {', '.join(S.RATIOS)} INTO NAME metric VALUE value) SELECT ticker, metric, round(value, 6) AS value, 'FY to 2000-12-31' AS period_basis FROM l")
def ratio_lineage_rows(spark, sf):
    rows = S.lineage(_screened(spark, sf), P.period_label(C("months"), C("period_end")))
    return r6(rows.select("ticker", "metric", "value", "period_basis"))


_FLAG = """concat_ws('; ', CASE WHEN eps < 0 THEN 'negative EPS' END, CASE WHEN eps_declined THEN 'declining EPS for 2+ consecutive years' END, CASE WHEN revenue_declined THEN 'declining revenue for 2+ consecutive years' END, CASE WHEN operating_cash_flow < 0 THEN 'negative operating cash flow' END, CASE WHEN debt_to_equity > 2 THEN 'high debt-to-equity' END,
 CASE WHEN net_profit > 0 AND ocf_to_net_profit < 0.7 THEN 'operating cash flow materially below net profit' END, CASE WHEN total_equity < 0 THEN 'negative equity' END, CASE WHEN payout > 1 THEN 'dividend payout above 100%' END,
 CASE WHEN average_volume IS NULL OR liquidity_days < 25 THEN 'multi-day liquidity unavailable (' || coalesce(liquidity_days, 0) || '/25 observations)' WHEN average_volume <= 100 THEN 'low trading liquidity (average daily volume)' END, CASE WHEN one_off THEN 'possible one-off profit or loss' END)"""
_LIQ = """dv AS (SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS trading_date, sum(CAST(value AS DECIMAL(18,6))) AS v FROM events GROUP BY ALL),
lt AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trading_date DESC) AS k FROM dv),
lq AS (SELECT ticker AS lt_ticker, avg(CAST(v AS DOUBLE)) AS average_volume, median(CAST(v AS DOUBLE)) AS median_volume, count(*) AS liquidity_days, min(trading_date) AS first_date, max(trading_date) AS last_date FROM lt WHERE k <= 28 GROUP BY ticker)"""


def _daily(spark, sf):
    e = A.table(spark, sf, "events")
    return e.groupBy(C("user_id").cast("string").alias("ticker"), C("ts").cast("date").alias("trading_date")).agg(F.sum(C("value").cast("decimal(18,6)")).cast("double").alias("share_volume"))


def _flagged(spark, sf, sums=None):
    sums = A.period_sums(spark, sf) if sums is None else sums
    s = _screened(spark, sf, sums)
    lq = L.summaries(_daily(spark, sf), 28).select(C("ticker").alias("t4"), "average_volume", "liquidity_days")
    fell = H.consecutive_decline(_history(spark, sf, sums=sums))
    fell = fell.groupBy(C("ticker").alias("t5")).agg(*[F.bool_or((C("metric") == m) & C("declined")).alias(f"{m}_declined") for m in ("eps", "revenue")])
    s = s.join(lq, C("ticker") == C("t4"), "left").join(fell, C("ticker") == C("t5"), "left").withColumn("one_off", C("issuer") % 17 == 0)
    return s.withColumn("flags", FL.company_flags(s.select("eps", "eps_declined", "revenue_declined", "operating_cash_flow", "debt_to_equity", "net_profit", "ocf_to_net_profit", "total_equity", "payout", "average_volume", "liquidity_days", "one_off"), liquidity_minimum_observations=25, low_liquidity_average_daily_volume=100.0))


_FELL = """, dr AS (SELECT ticker AS dt, metric AS m, source_period_end AS s, max(value) FILTER (value_basis = 'current') AS now, max(value) FILTER (value_basis = 'comparative') AS before FROM h GROUP BY ALL),
dq AS (SELECT *, row_number() OVER (PARTITION BY dt, m ORDER BY s DESC) AS k FROM dr), dd AS (SELECT dt, m, count(*) = 2 AND max(year(s)) - min(year(s)) = 1 AND bool_and(coalesce(now < before, false)) AS declined FROM dq WHERE k <= 2 GROUP BY ALL),
de AS (SELECT dt, bool_or(m = 'eps' AND declined) AS eps_declined, bool_or(m = 'revenue' AND declined) AS revenue_declined FROM dd GROUP BY dt)"""
_FLAGGED = f"{_SCREEN}, {_LIQ}, {_HIST.removeprefix(A.BASE_PREV + ',').strip()}{_FELL}, fg AS (SELECT *, {_FLAG} AS flags FROM (SELECT sc.*, lq.*, de.*, issuer % 17 = 0 AS one_off FROM sc LEFT JOIN lq ON ticker = lt_ticker LEFT JOIN de ON ticker = dt))"


@query(f"WITH {_FLAGGED} SELECT ticker, flags FROM fg")
def company_flags_all(spark, sf):
    return _flagged(spark, sf).select("ticker", "flags")


@query(f"WITH {_FLAGGED} SELECT flag, count(*) AS n FROM (SELECT unnest(string_split(flags, '; ')) AS flag FROM fg) WHERE flag <> '' GROUP BY flag")
def flag_counts_explode(spark, sf):
    return FL.flag_counts(_flagged(spark, sf))


@query(f"""WITH {_SCREEN}, m AS (SELECT nation AS n2, median(CASE WHEN pe > 0 THEN pe END) AS mpe, median(CASE WHEN pb > 0 THEN pb END) AS mpb FROM sc GROUP BY nation)
SELECT ticker, concat_ws('; ', CASE WHEN pe > 0 AND pe > 2 * mpe THEN 'P/E unusually high relative to sector median' END, CASE WHEN pb > 0 AND pb > 2 * mpb THEN 'P/B unusually high relative to sector median' END, CASE WHEN pb > 0 AND pb < 0.5 * mpb THEN 'P/B unusually low relative to sector median' END) AS relative_flags
FROM sc JOIN m ON nation = n2""")
def sector_positive_median_flags(spark, sf):
    return FL.relative_flags(_screened(spark, sf), ["nation"]).select("ticker", "relative_flags")


@query(f"WITH {_SCREEN}, l AS (UNPIVOT (SELECT roe, dividend_yield, pe, debt_to_equity, revenue_growth FROM sc) ON roe, dividend_yield, pe, debt_to_equity, revenue_growth INTO NAME metric VALUE value) SELECT metric, round(median(value), 6) AS median, count(value) AS observations FROM l GROUP BY metric")
def summary_medians(spark, sf):
    return r6(SM.medians(_screened(spark, sf), ["roe", "dividend_yield", "pe", "debt_to_equity", "revenue_growth"]))


@query(f"""WITH {_SCREEN}, l AS (UNPIVOT (SELECT issuer, ticker, revenue, eps, roe, pe FROM sc) ON revenue, eps, roe, pe INTO NAME metric VALUE value)
SELECT metric, arg_max(ticker, (value, -issuer)) AS highest, arg_min(ticker, (value, issuer)) AS lowest FROM l GROUP BY metric""")
def argmax_argmin_by_metric(spark, sf):
    rows = S.unpivot(_screened(spark, sf), ["issuer", "ticker"], ["revenue", "eps", "roe", "pe"])
    return RK.arg_extremes(rows, "ticker", "value", "issuer", ["metric"])


@query(f"WITH {_SCREEN} SELECT ticker, concat_ws(', ', CASE WHEN net_profit_attributable IS NULL THEN 'net_profit_attributable' END, CASE WHEN ordinary_equity IS NULL THEN 'ordinary_equity' END, CASE WHEN cash IS NULL THEN 'cash' END, CASE WHEN pe IS NULL THEN 'pe' END) AS missing FROM sc")
def missing_fields_per_issuer(spark, sf):
    return SM.missing_fields(_screened(spark, sf), ["net_profit_attributable", "ordinary_equity", "cash", "pe"])


def _ways_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    inputs = ", ".join(f"({quoted(r)}, {k}, {quoted(role)}, {quoted(kind)}, [{', '.join(map(quoted, ms))}]::VARCHAR[])" for r, ins in PV.RATIO_INPUTS.items() for k, (role, kind, ms) in enumerate(ins))
    raised = ", ".join(f"({quoted(f)}, {quoted(role)}, {quoted(kind)}, {quoted(m)})" for f, ins in PV.FLAG_INPUTS.items() for role, kind, m in ins)
    return f"""fa AS MATERIALIZED (SELECT ticker, metric, ticker || '/2000/' || metric AS id FROM (UNPIVOT (SELECT ticker, {', '.join(A.FACTS)} FROM w WHERE fy = 2000) ON {', '.join(A.FACTS)} INTO NAME metric VALUE value)),
bs2 AS MATERIALIZED (SELECT ticker AS bt, income_basis AS ib, cash_basis AS cb FROM fg), rt AS MATERIALIZED (UNPIVOT (SELECT ticker, {', '.join(S.RATIOS)} FROM fg) ON {', '.join(S.RATIOS)} INTO NAME ratio VALUE value),
inp(r, k, role, kind, ms) AS (VALUES {inputs}), fin(f, role, kind, m) AS (VALUES {raised}),
ch AS (SELECT rt.ticker, ratio, k, role, kind, ms, ib, cb, arg_min(fa.id, list_position(ms, fa.metric)) AS id FROM rt JOIN inp ON r = ratio JOIN bs2 ON bt = rt.ticker LEFT JOIN fa ON fa.ticker = rt.ticker AND list_contains(ms, fa.metric) GROUP BY ALL),
ed AS MATERIALIZED (SELECT DISTINCT * FROM (
 SELECT 'ratio:' || ticker || ':' || ratio AS parent, CASE WHEN kind = 'market' THEN 'market:' || ticker || ':price' WHEN (kind = 'income' AND ib = 'ttm') OR (kind = 'cash' AND cb = 'ttm') THEN 'trailing:' || ticker || ':' || ms[1] ELSE id END AS child, role FROM ch
 UNION ALL SELECT 'trailing:' || ticker || ':' || metric, ticker || '/2000/' || metric, 'year' FROM tr UNION ALL SELECT 'trailing:' || ticker || ':' || metric, ticker || '/2001H1/' || metric, x.role FROM tr, (VALUES ('year to date'), ('year to date before')) x(role)
 UNION ALL SELECT 'flag:' || ticker || ':' || f, CASE WHEN kind = 'ratio' THEN 'ratio:' || ticker || ':' || m WHEN (kind = 'income' AND ib = 'ttm') OR (kind = 'cash' AND cb = 'ttm') THEN 'trailing:' || ticker || ':' || m ELSE ticker || '/2000/' || m END, role
  FROM (SELECT ticker, unnest(string_split(flags, '; ')) AS flag FROM fg) JOIN fin ON f = flag JOIN bs2 ON bt = ticker) WHERE child IS NOT NULL),
reach AS (SELECT parent AS node, child AS source, role AS path, 1 AS depth FROM ed UNION ALL SELECT node, child, path || ' / ' || role, depth + 1 FROM reach JOIN ed ON parent = source),
ends AS (SELECT node, source, path, CAST(depth AS INT) AS depth FROM reach WHERE source NOT IN (SELECT parent FROM ed))"""


def _ways(spark, sf):
    """All ways from flags and ratios to facts."""
    sums = A.period_sums(spark, sf)
    s = _flagged(spark, sf, sums)
    a = A.annual(spark, sf, sums).where(C("fy") == A.LAST_FY)
    held = A.long_facts(a).select("ticker", "metric", F.concat_ws("/", "ticker", F.lit("2000"), "metric").alias("fact_id"))
    trailing = A.interim(spark, sf, sums).select("ticker", "metric", F.concat_ws("/", "ticker", F.lit("2001H1"), "metric").alias("fact_id"))
    edges = PV.ratio_edges(s, held).unionByName(PV.flag_edges(FL.flag_records(s), s, held)).unionByName(PV.trailing_edges(_trailing(spark, sf, sums)[2], held, trailing))
    return PV.closure(edges)


@query(f"WITH RECURSIVE {_FLAGGED}, {_ways_sql()} SELECT node, source, path, depth FROM ends")
def provenance_ways(spark, sf):
    return _ways(spark, sf)


@query(f"WITH RECURSIVE {_FLAGGED}, {_ways_sql()} SELECT split_part(node, ':', 2) AS ticker, split_part(node, ':', 3) AS name, string_agg(DISTINCT source, '; ' ORDER BY source) AS fact_ids FROM ends WHERE node LIKE 'ratio:%' AND source NOT LIKE 'market:%' GROUP BY ALL")
def ratio_source_facts(spark, sf):
    return PV.sources_of(_ways(spark, sf)).select("ticker", "name", F.concat_ws("; ", "fact_ids").alias("fact_ids"))


_CORE = ("revenue", "net_profit", "eps", "total_equity", "operating_cash_flow", "cash")


@query(f"""WITH {A.BASE}, l AS (UNPIVOT (SELECT ticker, confidence, {', '.join(_CORE)} FROM w WHERE fy = 2000) ON {', '.join(_CORE)} INTO NAME metric VALUE value),
c AS (SELECT ticker, count(*) FILTER (confidence >= 0.8) AS covered, bool_or(confidence < 0.8) AS flagged FROM l GROUP BY ticker)
SELECT ticker, covered, CASE WHEN covered < 3 THEN 'low' WHEN covered = 6 AND NOT flagged THEN CASE WHEN CAST(ticker AS INT) % 2 = 0 THEN 'review' ELSE 'high' END WHEN CAST(ticker AS INT) % 2 = 0 THEN 'low' ELSE 'review' END AS data_confidence FROM c""")
def data_confidence_class(spark, sf):
    long = A.long_facts(A.annual(spark, sf).where(C("fy") == A.LAST_FY), _CORE)
    d = S.data_confidence(long, list(_CORE))
    # as of two dates, so that every other issuer's report is older than the limit
    as_of = F.when(C("ticker").cast("int") % 2 == 0, F.lit("2002-12-31")).otherwise(F.lit("2001-12-31")).cast("date")
    return d.withColumn("data_confidence", S.stale(as_of, F.lit("2000-12-31").cast("date"), C("data_confidence")))


@query(f"WITH {ORACLES['data_confidence_class'].removeprefix('WITH ').rsplit('SELECT ticker, covered', 1)[0].rstrip()}, x AS (SELECT ticker, covered{ORACLES['data_confidence_class'].rsplit('SELECT ticker, covered', 1)[1]}) SELECT count(*) FILTER (data_confidence = 'high') AS high, count(*) FILTER (data_confidence = 'review') AS review, count(*) FILTER (data_confidence = 'low') AS low FROM x")
def confidence_counts(spark, sf):
    return SM.confidence_counts(data_confidence_class(spark, sf))


@query(f"WITH {_SCREEN} SELECT CASE WHEN income_basis = 'ttm' THEN 'TTM' ELSE 'FY' END AS basis, count(*) AS n FROM sc GROUP BY ALL")
def basis_counts(spark, sf):
    s = _screened(spark, sf)
    return SM.basis_counts(s.withColumn("label", S.labels(s, "months", "period_end", "period_end", "income_basis")), "label")


_MET = ("revenue", "net_profit", "net_profit_attributable", "ordinary_equity", "cash", "bvps", "dps")


@query(f"""WITH {A.BASE}, s AS (UNPIVOT (SELECT ticker, revenue, net_profit, net_profit_attributable, ordinary_equity, cash, dps FROM w WHERE fy = 2000 AND confidence >= 0.8) ON revenue, net_profit, net_profit_attributable, ordinary_equity, cash, dps INTO NAME metric VALUE value)
SELECT DISTINCT i.ticker, m.metric FROM w i, (VALUES {', '.join(f"('{m}')" for m in _MET)}) m(metric) WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.ticker = i.ticker AND s.metric = m.metric)""")
def missing_metric_anti(spark, sf, sums=None):
    w = A.annual(spark, sf, sums)
    selected = A.long_facts(w.where((C("fy") == A.LAST_FY) & (C("confidence") >= 0.8)), ("revenue", "net_profit", "net_profit_attributable", "ordinary_equity", "cash", "dps"))
    return S.missing_metrics(w.select("ticker").distinct(), list(_MET), selected)


# ---------------------------------------------------------------- ranking and documents
def _order_docs(spark, sf):
    """Orders as filings: the customer files, the year ends, priority tells the kind."""
    o = A.table(spark, sf, "orders")
    kind = F.when(C("o_orderpriority").startswith("1") | C("o_orderpriority").startswith("2"), "annual_report").otherwise("interim_statement")
    return o.select(
        C("o_orderkey").cast("string").alias("doc_id"), C("o_custkey").cast("string").alias("ticker"), kind.alias("kind"), F.when(C("o_orderkey") % 9 == 0, "amended report").otherwise("report").alias("title"),
        F.last_day(C("o_orderdate").cast("date")).alias("period_end"), F.when(C("o_orderkey") % 10 != 0, C("o_orderdate").cast("date")).alias("publication_date"),
        F.concat(F.lit("u"), (C("o_orderkey") % 5000).cast("string")).alias("url"), F.when(C("o_orderkey") % 2 == 0, "d").alias("discovery_url"), C("o_orderkey").alias("ord"),
    )


_DOCS = """d AS (SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, CAST(o_custkey AS VARCHAR) AS ticker, CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'annual_report' ELSE 'interim_statement' END AS kind,
 o_orderkey % 9 = 0 AS amended, last_day(CAST(o_orderdate AS DATE)) AS period_end, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END AS pub, 'u' || (o_orderkey % 5000) AS url, o_orderkey % 2 = 0 AS disc, o_orderkey AS ord FROM orders)"""


@query("SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderpriority AS VARCHAR) AS metric, o_orderkey AS ord, round(o_totalprice, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY (o_orderkey % 11 = 0) DESC, CASE WHEN o_orderkey % 3 = 0 THEN 0.9 ELSE 0.85 END DESC, o_orderkey) AS r FROM orders WHERE o_orderkey % 7 <> 0) WHERE r = 1")
def best_fact_first_wins(spark, sf):
    conf = F.when(C("o_orderkey") % 7 == 0, "0.62").when(C("o_orderkey") % 3 == 0, "0.90").otherwise("0.85").cast("decimal(3,2)")
    f = A.table(spark, sf, "orders").select(C("o_custkey").cast("string").alias("ticker"), C("o_orderpriority").alias("metric"), C("o_totalprice").alias("value"), conf.alias("confidence"), F.when(C("o_orderkey") % 11 == 0, "c").alias("correction_id"), C("o_orderkey").alias("ord"))
    return r6(RK.best_facts(f).select("ticker", "metric", "ord", "value"))


@query(f"""WITH {_DOCS}, one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, kind, period_end ORDER BY coalesce(pub, DATE '0001-01-01') DESC, amended DESC, ord) AS r FROM d) WHERE r = 1),
t AS (SELECT *, row_number() OVER (PARTITION BY ticker, kind ORDER BY period_end DESC, pub DESC NULLS LAST, ord) AS k FROM one)
SELECT ticker, kind, doc_id, period_end FROM t WHERE (kind = 'annual_report' AND k <= 3) OR k = 1""")
def latest3_periods_plus_interim(spark, sf):
    return RK.latest_documents(_order_docs(spark, sf)).select("ticker", "kind", "doc_id", "period_end")


@query(f"""WITH {_DOCS}, u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, url ORDER BY ord DESC) AS r FROM d) WHERE r = 1),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, kind, period_end ORDER BY coalesce(CAST(pub AS VARCHAR), '') DESC, disc DESC, ord) AS r2 FROM u) WHERE r2 = 1),
t AS (SELECT *, row_number() OVER (PARTITION BY ticker, kind ORDER BY period_end DESC, ord) AS k FROM one)
SELECT ticker, kind, doc_id, period_end FROM t WHERE (kind = 'annual_report' AND k <= 3) OR k = 1""")
def merge_documents_rank(spark, sf):
    d = _order_docs(spark, sf)
    return RK.merge_documents(d.where("ord % 2 = 1"), d.where("ord % 2 = 0")).select("ticker", "kind", "doc_id", "period_end")


@query("""WITH a AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS annual_end FROM orders WHERE o_orderpriority < '3' GROUP BY ALL),
i AS (SELECT o.o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d, annual_end, row_number() OVER (PARTITION BY o.o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey) AS k FROM orders o JOIN a ON a.o_custkey = o.o_custkey WHERE o_orderpriority >= '3' AND CAST(o_orderdate AS DATE) > annual_end)
SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderkey AS VARCHAR) AS doc_id, d AS period_end, annual_end FROM i WHERE k = 1""")
def interim_asof_join(spark, sf):
    o = A.table(spark, sf, "orders").select(C("o_custkey").cast("string").alias("ticker"), C("o_orderkey").cast("string").alias("doc_id"), C("o_orderdate").cast("date").alias("period_end"), F.substring("o_orderpriority", 1, 1).alias("p"), C("o_orderkey").alias("ord"))
    a = o.where("p < '3'").groupBy("ticker").agg(F.max("period_end").alias("period_end"))
    return S.newest_interim(a, o.where("p >= '3'")).select("ticker", "doc_id", "period_end", "annual_end")


@query("SELECT o_orderpriority AS doc, CAST(mult AS INT) AS mult, n FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY n DESC, mult DESC) AS r FROM (SELECT o_orderpriority, pow(10, o_orderkey % 3 * 3) AS mult, count(*) AS n FROM orders GROUP BY ALL)) WHERE r = 1")
def consensus_unit_mode(spark, sf):
    o = A.table(spark, sf, "orders").select(C("o_orderpriority").alias("doc"), F.pow(F.lit(10.0), C("o_orderkey") % 3 * 3).cast("int").alias("mult"))
    return RK.mode_largest(o, ["doc"], "mult")


@query("""WITH a AS (SELECT DISTINCT o_custkey, o_orderkey, month(o_orderdate) AS m FROM orders), l AS (SELECT o_custkey, o_orderkey, m, lag(m) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM a)
SELECT o_custkey AS customer, o_orderkey AS k, CAST(m AS INT) AS m FROM l WHERE b IS NULL OR b <> m""")
def adjacent_dedup(spark, sf):
    o = A.table(spark, sf, "orders").select(C("o_custkey").alias("customer"), C("o_orderkey").alias("k"), F.month("o_orderdate").alias("m"))
    return RK.collapse_repeats(o, ["customer"], ["k"], "m")


@query("""WITH l AS (SELECT o_custkey, o_orderkey, year(o_orderdate) AS y, lag(year(o_orderdate)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM orders) SELECT o_custkey AS customer, o_orderkey AS k, CAST(y AS INT) AS y FROM l WHERE b IS NULL OR y > b""")
def block_restarts(spark, sf):
    o = A.table(spark, sf, "orders").select(C("o_custkey").alias("customer"), C("o_orderkey").alias("k"), F.year("o_orderdate").alias("y"))
    return RK.block_starts(o, ["customer"], ["k"], "y")


# ---------------------------------------------------------------- overlays and joins
@query("""WITH o AS (SELECT CAST(s_suppkey AS VARCHAR) AS ticker, CASE WHEN s_suppkey % 13 = 0 THEN 'renamed' ELSE s_name END AS name, n_name AS g FROM supplier JOIN nation ON n_nationkey = s_nationkey),
i AS (SELECT 'X' || CAST(s_suppkey AS VARCHAR) AS ticker, 'added' AS name, n_name AS g FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey <= 5 UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'updated', n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey % 10 = 3),
b AS (SELECT coalesce(o.ticker, i.ticker) AS ticker, coalesce(i.name, o.name) AS name, coalesce(i.g, o.g) AS industry_group, CASE WHEN o.ticker IS NULL THEN 'configured_include' WHEN i.ticker IS NOT NULL THEN 'configured_include+official' ELSE 'official' END AS membership FROM o FULL JOIN i ON o.ticker = i.ticker),
x AS (SELECT CAST(s_suppkey AS VARCHAR) AS x FROM supplier WHERE s_suppkey % 7 = 0 UNION ALL SELECT 'GONE')
SELECT coalesce(ticker, x) AS ticker, name, industry_group, coalesce(membership, 'configured_exclusion_not_present') AS membership, x IS NULL AS included FROM b FULL JOIN x ON ticker = x""")
def universe_overlay_full_outer(spark, sf):
    s, n = A.table(spark, sf, "supplier"), A.table(spark, sf, "nation")
    official = s.join(n, s.s_nationkey == n.n_nationkey).select(C("s_suppkey").cast("string").alias("ticker"), C("s_name").alias("name"), C("n_name").alias("industry_group"), "s_suppkey")
    include = official.where("s_suppkey <= 5").select(F.concat(F.lit("X"), "ticker").alias("ticker"), F.lit("added").alias("name"), "industry_group").unionByName(official.where("s_suppkey % 10 = 3").select("ticker", F.lit("updated").alias("name"), "industry_group"))
    override = official.where("s_suppkey % 13 = 0").select("ticker", F.lit("renamed").alias("name"), F.lit(None).cast("string").alias("industry_group"))
    exclude = official.where("s_suppkey % 7 = 0").select("ticker").unionByName(spark.createDataFrame([("GONE",)], "ticker string"))
    return O.apply_universe(official.drop("s_suppkey"), include, exclude, override, check=False)


def _corrections(spark, sf):
    """A correction for each order: every third is superseded, and every fifth names a period that no document has."""
    o, k = A.table(spark, sf, "orders"), C("o_orderkey")
    return o.select(
        F.concat(F.lit("c"), k.cast("string")).alias("id"), F.when(k % 3 == 1, "superseded").otherwise("active").alias("status"), C("o_custkey").cast("string").alias("ticker"), F.lit("revenue").alias("metric"),
        F.when(k % 5 == 1, F.lit("1900-01-01").cast("date")).otherwise(C("o_orderdate").cast("date")).alias("financial_period"), F.concat(F.lit("doc "), k.cast("string")).alias("source_document"), C("o_totalprice").alias("value"),
    )


def _correction_docs(spark, sf):
    return A.table(spark, sf, "orders").select(C("o_orderkey").cast("string").alias("doc_id"), C("o_custkey").cast("string").alias("ticker"), C("o_orderdate").cast("date").alias("period_end"), F.concat(F.lit("doc "), C("o_orderkey").cast("string")).alias("title"))


_CORR = """c AS (SELECT 'c' || o_orderkey AS id, CASE WHEN o_orderkey % 3 = 1 THEN 'superseded' ELSE 'active' END AS status, CAST(o_custkey AS VARCHAR) AS ticker, CASE WHEN o_orderkey % 5 = 1 THEN DATE '1900-01-01' ELSE CAST(o_orderdate AS DATE) END AS period_end, 'doc ' || o_orderkey AS title, o_totalprice AS value FROM orders),
d AS (SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderdate AS DATE) AS period_end, 'doc ' || o_orderkey AS title FROM orders),
ap AS (SELECT ticker, doc_id, id, value FROM c JOIN d USING (ticker, period_end, title) WHERE status = 'active')"""


@query(f"WITH {_CORR} SELECT ticker, doc_id, id AS correction_id, round(value, 6) AS value FROM ap")
def correction_overlay(spark, sf):
    return r6(O.correction_facts(_corrections(spark, sf), _correction_docs(spark, sf)).select("ticker", "doc_id", "correction_id", "value"))


@query(f"WITH {_CORR} SELECT id FROM c WHERE status = 'active' AND id NOT IN (SELECT id FROM ap)")
def unapplied_anti(spark, sf):
    c = _corrections(spark, sf)
    return O.unapplied(c, O.correction_facts(c, _correction_docs(spark, sf))).select("id")


@query("SELECT CAST(c_custkey // 3 AS VARCHAR) || '.' || c_custkey AS ticker, count(*) OVER (PARTITION BY c_custkey // 3) AS share_classes FROM customer")
def share_class_window_count(spark, sf):
    c = A.table(spark, sf, "customer").select(F.concat(F.floor(C("c_custkey") / 3).cast("string"), F.lit("."), C("c_custkey").cast("string")).alias("ticker"))
    return O.share_classes(c)


@query("SELECT c_custkey AS doc, b.k AS ticker FROM customer JOIN (SELECT CAST(s_suppkey // 2 AS VARCHAR) || '.' || s_suppkey AS k, s_suppkey // 2 AS base FROM supplier) b ON b.base = c_custkey % 50")
def base_symbol_fanout(spark, sf):
    docs = A.table(spark, sf, "customer").select(C("c_custkey").alias("doc"), F.concat((C("c_custkey") % 50).cast("string"), F.lit(".N")).alias("symbol"))
    companies = A.table(spark, sf, "supplier").select(F.concat(F.floor(C("s_suppkey") / 2).cast("string"), F.lit("."), C("s_suppkey").cast("string")).alias("ticker"))
    return O.fan_out(docs, companies).select("doc", "ticker")


@query("SELECT e_id, ticker FROM (SELECT event_id AS e_id, 'supplier' || lpad(CAST(user_id % 20 AS VARCHAR), 3, '0') AS k FROM events) e JOIN (SELECT max(s_suppkey) AS m, CAST(max(s_suppkey) AS VARCHAR) AS ticker, 'supplier' || lpad(CAST(s_suppkey % 10 AS VARCHAR), 3, '0') AS k FROM supplier GROUP BY s_suppkey % 10) s USING (k)")
def name_key_join(spark, sf):
    e = A.table(spark, sf, "events").select(C("event_id").alias("e_id"), F.concat(F.lit("Supplier#"), F.lpad((C("user_id") % 20).cast("string"), 3, "0")).alias("company"))
    s = A.table(spark, sf, "supplier").select(C("s_suppkey").cast("string").alias("ticker"), F.concat(F.lit("SUPPLIER "), F.lpad((C("s_suppkey") % 10).cast("string"), 3, "0")).alias("name"), C("s_suppkey").alias("ord"))
    return O.join_by_name(e, s).select("e_id", "ticker")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS ticker, coalesce(string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY CAST(s_suppkey AS VARCHAR)), '') AS documents FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey")
def document_fallback_append(spark, sf):
    n = A.table(spark, sf, "nation").select(C("n_nationkey").cast("string").alias("ticker"))
    d = A.table(spark, sf, "supplier").select(C("s_nationkey").cast("string").alias("ticker"), C("s_suppkey").cast("string").alias("doc_id"))
    return O.with_fallback_documents(n, d).select("ticker", F.array_join("documents", ",").alias("documents"))


@query(f"""WITH {A.BASE}, {A.INTERIM} SELECT w.ticker, m.metric, CASE WHEN tr.ticker IS NOT NULL THEN 'yes (TTM input)' WHEN fy = 2000 AND confidence2 >= 0.8 THEN 'yes' END AS used_in_screening, CAST(fy AS INT) AS fy
 FROM (SELECT *, confidence AS confidence2 FROM w) w, (VALUES ('revenue'), ('dps')) m(metric) LEFT JOIN tr ON tr.ticker = w.ticker AND tr.metric = m.metric AND w.fy = 2000""")
def used_in_screening_backmark(spark, sf):
    sums = A.period_sums(spark, sf)
    f = A.long_facts(A.annual(spark, sf, sums), ("revenue", "dps")).withColumn("fact_id", X.fact_id(C("ticker"), C("fy"), C("metric")))
    used = f.where((C("fy") == A.LAST_FY) & (C("confidence") >= 0.8))
    t = _trailing(spark, sf, sums)[2].select(X.fact_id(C("ticker"), F.lit(A.LAST_FY), C("metric")).alias("fact_id"))
    return S.mark_used(f, used, t).select("ticker", "metric", "used_in_screening", "fy")


@query(f"WITH {A.BASE}, {A.INTERIM} SELECT ticker, metric, round(al.value, 6) AS value, round(it.value, 6) AS interim_value FROM al JOIN it USING (ticker, metric) WHERE abs(it.value / nullif(al.value, 0)) > 3 OR abs(it.value / nullif(al.value, 0)) < 1 / 3.0::DOUBLE")
def cross_period_scale(spark, sf):
    sums = A.period_sums(spark, sf)
    _, long, _ = _trailing(spark, sf, sums)
    return r6(V.cross_period_scale(long, A.interim(spark, sf, sums), 3.0))


@query("SELECT CAST(o_custkey AS VARCHAR) AS ticker, CASE WHEN max(nullif(m, 0)) IS NULL THEN 12 ELSE max(nullif(m, 0)) END AS months FROM (SELECT o_custkey, CAST(CASE WHEN o_orderkey % 50 = 0 THEN 15 WHEN o_orderkey % 3 = 0 THEN 0 ELSE 12 END AS INT) AS m FROM orders) GROUP BY o_custkey")
def annual_period_lengths(spark, sf):
    o = A.table(spark, sf, "orders").select(C("o_custkey").cast("string").alias("ticker"), F.when(C("o_orderkey") % 50 == 0, 15).when(C("o_orderkey") % 3 == 0, 0).otherwise(12).alias("period_months"))
    return S.period_lengths(o)


# ---------------------------------------------------------------- validation
def _validated(spark, sf, sums=None):
    """Figures of the last year with planted faults. Every tenth issuer has several share classes, so no count by the market; the book
    value of some stands on the statement."""
    w = A.annual(spark, sf, sums).where(C("fy") == A.LAST_FY)
    names = ("revenue", "net_profit", "eps", "dps", "total_assets", "total_liabilities", "total_equity", "ordinary_equity", "bvps", "ordinary_shares_outstanding")
    w = w.withColumns({
        "eps": C("eps") * F.when(C("issuer") % 9 == 0, -1).when(C("issuer") % 8 == 0, 100).otherwise(1), "net_profit": C("net_profit") * F.when(C("issuer") % 4 == 0, 600).otherwise(1),
        "market_shares": F.when(C("issuer") % 10 != 3, C("ordinary_shares_outstanding") * F.when(C("issuer") % 11 == 2, 2).otherwise(1)), "bvps_printed": C("issuer") % 18 == 0,
        "bvps": C("ordinary_equity") / C("ordinary_shares_outstanding") * F.when(C("issuer") % 6 == 0, 2).otherwise(1), "dps": C("dps") * F.when(C("issuer") % 10 == 0, 5000).otherwise(1),
    })
    w = w.withColumn("ordinary_shares_outstanding", C("ordinary_shares_outstanding") / F.when(C("issuer") % 12 == 5, 1000).when(C("issuer") % 12 == 7, 3).otherwise(1))
    return w.drop("net_profit_attributable").withColumns({f"{m}_conf": C("confidence") for m in names})


# the rules as the reports' conventions state them: a count is right if any reference is near; only the market's count judges EPS
_VAL = f"""{A.BASE},
v0 AS (SELECT issuer, ticker, confidence AS c, revenue, total_assets AS a, total_liabilities AS li, total_equity AS e, ordinary_equity AS oe, issuer % 18 = 0 AS printed,
 CASE WHEN issuer % 10 <> 3 THEN ordinary_shares_outstanding * (CASE WHEN issuer % 11 = 2 THEN 2 ELSE 1 END) END AS ms,
 eps * (CASE WHEN issuer % 9 = 0 THEN -1 WHEN issuer % 8 = 0 THEN 100 ELSE 1 END) AS eps, net_profit * (CASE WHEN issuer % 4 = 0 THEN 600 ELSE 1 END) AS np,
 ordinary_equity / ordinary_shares_outstanding * (CASE WHEN issuer % 6 = 0 THEN 2 ELSE 1 END) AS bvps, dps * (CASE WHEN issuer % 10 = 0 THEN 5000 ELSE 1 END) AS dps,
 ordinary_shares_outstanding / (CASE WHEN issuer % 12 = 5 THEN 1000 WHEN issuer % 12 = 7 THEN 3 ELSE 1 END) AS sh FROM w WHERE fy = 2000),
v1 AS (SELECT *, c < 0.8 AS low, a <> 0 AND abs(a - li - e) > greatest(abs(a) * 0.05::DOUBLE, 1) AS eq, revenue <> 0 AND abs(np) > 2 * abs(revenue) AS scale, eps <> 0 AND np <> 0 AND sign(eps) <> sign(np) AS sgn FROM v0),
v2 AS (SELECT *, NOT sgn AND coalesce(eps <> 0 AND np <> 0 AND (abs(eps * ms / np) < 0.33::DOUBLE OR abs(eps * ms / np) > 3), false) AS eid FROM v1),
v3 AS (SELECT *, c >= 0.8 AND NOT sgn AND NOT eid AS sound FROM v2),
rf AS (SELECT issuer AS i2, np / eps AS ref, 0.25::DOUBLE AS tol FROM v3 WHERE sound AND eps <> 0 AND np / eps > 0 UNION ALL SELECT issuer, ms, 0.35::DOUBLE FROM v3 WHERE ms IS NOT NULL),
cm AS (SELECT issuer AS i3, bool_or(abs(sh - ref) <= abs(ref) * tol) AS ok, bool_or(abs(sh * 1000 - ref) <= abs(ref) * 0.05::DOUBLE) AS k, bool_or(abs(sh * 1000000 - ref) <= abs(ref) * 0.05::DOUBLE) AS mm FROM v3 JOIN rf ON issuer = i2 GROUP BY issuer),
v4 AS (SELECT *, CASE WHEN NOT ok AND k THEN 1000.0::DOUBLE WHEN NOT ok AND mm THEN 1000000.0::DOUBLE END AS f FROM v3 LEFT JOIN cm ON issuer = i3),
v5 AS (SELECT *, coalesce(NOT ok, false) AND f IS NULL AS cnt, sh * coalesce(f, 1) AS sh2 FROM v4),
v6 AS (SELECT *, CASE WHEN c >= 0.8 THEN oe / nullif(CASE WHEN cnt THEN ms ELSE sh2 END, 0) END AS ib FROM v5),
v7 AS (SELECT *, coalesce(ib > 0 AND abs(bvps - ib) > abs(ib) * 0.15::DOUBLE, false) AS bad_bv, dps < 0 OR (sound AND dps > greatest(5 * abs(eps), 1)) AS bad_dps FROM v6)"""


def _validation_query(name, rule, sql_col):
    def run(spark, sf):
        # an outer explode: a filter would be pushed through all the rules and make a plan of many copies of them
        return V.validate(_validated(spark, sf)).select("ticker", F.explode_outer("rules").alias("rule")).where(C("rule") == rule)

    run.__name__ = name
    query(f"WITH {_VAL} SELECT ticker, '{rule}' AS rule FROM v7 WHERE {sql_col}")(run)


for _n, _r, _c in (("validation_low_confidence", "low_confidence", "low"), ("validation_equation", "accounting_equation", "eq"), ("validation_profit_scale", "profit_revenue_scale", "scale"), ("validation_eps_sign", "eps_profit_sign", "sgn"), ("validation_eps_identity", "eps_identity", "eid"), ("validation_share_count", "share_count_identity", "cnt"), ("validation_bvps", "bvps_identity", "bad_bv"), ("validation_dps_range", "dps_range", "bad_dps")):
    _validation_query(_n, _r, _c)


@query(f"WITH {_VAL} SELECT ticker, CAST(f AS DOUBLE) AS shares_factor, round(sh2, 6) AS shares, round(CASE WHEN cnt THEN least(c, 0.6::DOUBLE) ELSE c END, 6) AS shares_confidence, round(CASE WHEN eq THEN greatest(0, c - 0.15::DOUBLE) ELSE c END, 6) AS assets_confidence, round(CASE WHEN bad_bv AND NOT printed THEN least(c, 0.6::DOUBLE) ELSE c END, 6) AS bvps_confidence, round(CASE WHEN sgn OR eid THEN least(c, 0.6::DOUBLE) ELSE c END, 6) AS eps_confidence FROM v7")
def share_scale_rescale(spark, sf):
    shown = {"shares_factor": "shares_factor", "ordinary_shares_outstanding": "shares", "ordinary_shares_outstanding_conf": "shares_confidence", "total_assets_conf": "assets_confidence", "bvps_conf": "bvps_confidence", "eps_conf": "eps_confidence"}
    return r6(V.validate(_validated(spark, sf)).select("ticker", *[C(k).alias(v) for k, v in shown.items()]))


_ISSUES = (("accounting_equation", "eq", ("total_assets", "total_liabilities", "total_equity")), ("profit_revenue_scale", "scale", ("revenue", "net_profit")), ("eps_profit_sign", "sgn", ("eps",)), ("eps_identity", "eid", ("eps",)), ("share_count_identity", "cnt", ("ordinary_shares_outstanding",)), ("bvps_identity", "bad_bv", ("bvps",)), ("dps_range", "bad_dps", ("dps",)))
_LOW = ("revenue", "net_profit", "eps", "dps", "total_assets", "total_liabilities", "total_equity", "ordinary_equity", "bvps", "ordinary_shares_outstanding", "cash")


def _fact_rows(spark, sf):
    """The figures of _validated as long facts: the one of a document and metric that counts, and a doubtful one that arrived before it."""
    w = _validated(spark, sf)
    rows = S.unpivot(w, ["ticker", "confidence", "bvps_printed"], list(_LOW)).withColumns({"ord": F.lit(2).cast("long"), "extraction_method": F.when(C("bvps_printed"), "primary_row").otherwise("label_scan")})
    doubtful = rows.withColumns({"value": C("value") * 3, "confidence": F.lit(0.3), "ord": F.lit(1).cast("long")})
    return w, rows.unionByName(doubtful).withColumnRenamed("ticker", "doc_id")


@query(f"""WITH {_VAL}, al AS (SELECT ticker, metric, c FROM v7, (VALUES {', '.join(f"('{m}', {m == 'ordinary_equity' or m == 'bvps'}, {m == 'cash'})" for m in _LOW)}) m(metric, own, cash) WHERE NOT (own AND oe IS NULL) AND NOT (cash AND issuer % 11 = 0))
SELECT ticker AS doc_id, metric, 'low_confidence' AS rule FROM al UNION ALL SELECT ticker, metric, 'low_confidence' FROM al WHERE c < 0.8
{' '.join(f"UNION ALL SELECT ticker, '{m}', '{r}' FROM v7 WHERE {c}" for r, c, of in _ISSUES for m in of)}""")
def validation_issues_long(spark, sf):
    w, rows = _fact_rows(spark, sf)
    return V.validate_facts(rows, w.select(C("ticker").alias("doc_id"), "market_shares", F.lit(True).alias("reconciled")))[1].select("doc_id", "metric", "rule")


_FIG = lambda x, digits=2: f"format('{{:,.{digits}f}}', {x})"
_SAID = f"""said AS (
 SELECT ticker, 'x' AS m, 0 AS k, '' AS rule, '' AS kind, '' AS t FROM v7 WHERE false
 UNION ALL SELECT ticker, m, 1, 'accounting_equation', 'warn', 'total assets differ from liabilities and equity by ' || {_FIG('abs(a - li - e)')} || ', more than 5%' FROM v7, (VALUES ('total_assets'), ('total_liabilities'), ('total_equity')) x(m) WHERE eq
 UNION ALL SELECT ticker, m, 2, 'profit_revenue_scale', 'warn', 'net profit is more than twice revenue in size' FROM v7, (VALUES ('revenue'), ('net_profit')) x(m) WHERE scale
 UNION ALL SELECT ticker, 'eps', 3, 'eps_profit_sign', 'demote', 'EPS ' || {_FIG('eps')} || ' and profit ' || {_FIG('np')} || ' differ in sign' FROM v7 WHERE sgn
 UNION ALL SELECT ticker, 'eps', 3, 'eps_identity', 'demote', 'EPS ' || {_FIG('eps')} || ' is ' || {_FIG('abs(eps / (np / ms))')} || ' times the profit for each share that the market counts (' || {_FIG('np / ms')} || ')' FROM v7 WHERE eid
 UNION ALL SELECT ticker, 'ordinary_shares_outstanding', 4, NULL, 'note', 'count agrees with ' || CASE WHEN near THEN 'profit / EPS' ELSE 'market value / price' END FROM (SELECT *, coalesce(sound AND np / eps > 0 AND abs(sh - np / eps) <= abs(np / eps) * 0.25::DOUBLE, false) AS near FROM v7) WHERE ok
 UNION ALL SELECT ticker, 'ordinary_shares_outstanding', 4, NULL, 'rescale', 'count was in units of ' || {_FIG('f', 0)} || ': scaled it is within 5% of ' || CASE WHEN near THEN 'profit / EPS' ELSE 'market value / price' END FROM (SELECT *, coalesce(sound AND np / eps > 0 AND abs(sh * f - np / eps) <= abs(np / eps) * 0.05::DOUBLE, false) AS near FROM v7) WHERE f IS NOT NULL
 UNION ALL SELECT ticker, 'ordinary_shares_outstanding', 4, 'share_count_identity', 'demote', 'count ' || {_FIG('sh', 0)} || ' agrees with none of ' || concat_ws('; ', CASE WHEN sound AND np / eps > 0 THEN 'profit / EPS = ' || {_FIG('np / eps', 0)} END, 'market value / price = ' || {_FIG('ms', 0)}) FROM v7 WHERE cnt
 UNION ALL SELECT ticker, 'bvps', 5, 'bvps_identity', CASE WHEN printed THEN 'note' ELSE 'demote' END, 'book value per share ' || {_FIG('bvps')} || ' differs by more than 15% from equity / shares (' || {_FIG('ib')} || '); ' || CASE WHEN printed THEN 'the one on the statement stands' ELSE 'the calculated one is used' END FROM v7 WHERE bad_bv
 UNION ALL SELECT ticker, 'dps', 6, 'dps_range', 'demote', CASE WHEN dps < 0 THEN 'dividend per share is negative' ELSE 'dividend per share ' || {_FIG('dps')} || ' is over five times EPS ' || {_FIG('eps')} END FROM v7 WHERE bad_dps)"""
_FACTS = {"revenue": "revenue", "net_profit": "np", "eps": "eps", "dps": "dps", "total_assets": "a", "total_liabilities": "li", "total_equity": "e", "ordinary_equity": "oe", "bvps": "bvps", "ordinary_shares_outstanding": "sh", "cash": "cash"}


@query(f"""WITH {_VAL.replace('revenue, total_assets AS a', 'revenue, cash, total_assets AS a')}, {_SAID},
fx AS (SELECT * FROM (UNPIVOT (SELECT ticker, c, coalesce(f, 1) AS f, {', '.join(f'{x} AS {m}' if x != m else m for m, x in _FACTS.items())} FROM v7) ON {', '.join(_FACTS)} INTO NAME metric VALUE value)),
low AS (SELECT ticker, metric, c, f, value, CASE WHEN c < 0.8 THEN 'read with a confidence of ' || {_FIG('c')} || ', below 0.80' END AS low FROM fx),
al AS (SELECT l.ticker, l.metric, any_value(c) AS c, any_value(value) AS value, any_value(l.f) AS f, any_value(low) AS low, string_agg(t, '; ' ORDER BY k) AS notes, coalesce(bool_or(kind IN ('warn', 'demote')), false) AS bad, coalesce(bool_or(kind = 'demote'), false) AS capped,
 coalesce(sum(CASE rule WHEN 'accounting_equation' THEN 0.15::DOUBLE WHEN 'profit_revenue_scale' THEN 0.12::DOUBLE END), 0) AS less, coalesce(bool_or(kind = 'rescale'), false) AS scaled FROM low l LEFT JOIN said ON said.ticker = l.ticker AND said.m = l.metric GROUP BY ALL)
SELECT ticker AS doc_id, metric, 2 AS ord, round(CASE WHEN scaled THEN value * f ELSE value END, 6) AS value, round(CASE WHEN capped THEN least(c, 0.6::DOUBLE) ELSE greatest(0, c - less) END, 6) AS confidence, CASE WHEN low IS NOT NULL OR bad THEN 'review' ELSE 'passed' END AS validation_status, concat_ws('; ', low, notes) AS validation_notes,
 CASE WHEN scaled THEN f ELSE 1.0::DOUBLE END AS multiplier, CASE WHEN scaled THEN 'shares x ' || {_FIG('f', 0)} || ' (inferred)' ELSE 'as printed' END AS original_unit FROM al
UNION ALL SELECT ticker, metric, 1, round(value * 3, 6), 0.3::DOUBLE, 'review', 'read with a confidence of 0.30, below 0.80', 1.0::DOUBLE, 'as printed' FROM fx""")
def validation_state_fold(spark, sf):
    """Every fact after its events: status, notes with figures, confidence, value, multiplier and unit."""
    w, rows = _fact_rows(spark, sf)
    facts = rows.withColumns({"multiplier": F.lit(1.0), "original_unit": F.lit("as printed")})
    done = V.validate_facts(facts, w.select(C("ticker").alias("doc_id"), "market_shares", F.lit(True).alias("reconciled")))[0]
    return r6(done.select("doc_id", "metric", C("ord").cast("int").alias("ord"), "value", "confidence", "validation_status", "validation_notes", "multiplier", "original_unit"))


@query("SELECT CAST(o_custkey AS VARCHAR) AS doc_id, o_orderpriority AS metric, o_orderkey AS ord FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey % 4 DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def validation_selected_facts(spark, sf):
    o = A.table(spark, sf, "orders").select(C("o_custkey").cast("string").alias("doc_id"), C("o_orderpriority").alias("metric"), (C("o_orderkey") % 4 / 4).alias("confidence"), C("o_orderkey").alias("ord"))
    return V.selected_facts(o).select("doc_id", "metric", "ord")


@query(f"""WITH {A.BASE}, g AS (SELECT *, CASE WHEN issuer % 4 = 0 THEN total_equity * 0.1::DOUBLE END AS mi, CASE WHEN issuer % 10 <> 1 THEN total_equity END AS te, CASE WHEN issuer % 3 <> 0 THEN total_liabilities END AS tl FROM w WHERE fy = 2000),
x AS (SELECT *, coalesce(te, ordinary_equity + coalesce(mi, 0)) AS te2 FROM g)
SELECT ticker, round(coalesce(tl, total_assets - te2), 6) AS total_liabilities, round(coalesce(ordinary_equity, te - coalesce(mi, 0)), 6) AS ordinary_equity, round(te2, 6) AS total_equity FROM x""")
def identity_derivation_nulls(spark, sf):
    w = A.annual(spark, sf).where(C("fy") == A.LAST_FY)
    w = w.select("ticker", "total_assets", F.when(C("issuer") % 3 != 0, C("total_liabilities")).alias("total_liabilities"), "ordinary_equity", F.when(C("issuer") % 4 == 0, C("total_equity") * 0.1).alias("minority_interest"), F.when(C("issuer") % 10 != 1, C("total_equity")).alias("total_equity"))
    return r6(V.derive_identities(w).select("ticker", "total_liabilities", "ordinary_equity", "total_equity"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS ticker, round_even(abs(s_acctbal) * 1000 / (s_suppkey % 7 + 1), 0) AS value, CAST(0.85 AS DOUBLE) AS confidence FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey % 5 <> 0")
def market_implied_shares(spark, sf):
    s = A.table(spark, sf, "supplier").withColumn("ticker", C("s_suppkey").cast("string"))
    issuers = s.select("ticker", (F.abs("s_acctbal") * 1000).alias("market_cap"), (C("s_suppkey") % 7 + 1).cast("double").alias("price"))
    reported = s.where("s_suppkey % 4 = 0").select("ticker", F.lit(0.9).alias("confidence"), F.lit(1.0).alias("value"))
    classes = s.select("ticker", F.when(C("s_suppkey") % 5 == 0, 2).otherwise(1).alias("share_classes"))
    return V.market_implied_shares(issuers, reported, classes)


@query("""SELECT l_orderkey AS k, CAST(sum(coalesce(a, 0)) AS DOUBLE) AS current, CAST(sum(coalesce(b, 0)) AS DOUBLE) AS prior, max(l_returnflag) AS worst_basis, string_agg(CAST(l_linenumber AS VARCHAR), ' + ' ORDER BY l_linenumber) AS components
 FROM (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS l_returnflag, CASE WHEN l_linenumber % 3 <> 0 THEN sum(CAST(l_extendedprice AS DECIMAL(18,2))) END AS a, CASE WHEN l_linenumber % 2 <> 0 THEN sum(CAST(l_extendedprice AS DECIMAL(18,2))) END AS b FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE a IS NOT NULL OR b IS NOT NULL GROUP BY l_orderkey""")
def debt_component_sum(spark, sf):
    li = A.table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_returnflag").alias("basis"), F.sum(C("l_extendedprice").cast("decimal(18,2)")).alias("v"))
    rows = li.select(C("l_orderkey").alias("k"), C("l_linenumber").alias("o"), C("l_linenumber").cast("string").alias("label"), "basis", F.when(C("l_linenumber") % 3 != 0, C("v")).alias("a"), F.when(C("l_linenumber") % 2 != 0, C("v")).alias("b"))
    d = SM.component_sum(rows, ["k"], "label", {"current": "a", "prior": "b"}, "basis", "o")
    return d.withColumns({"current": C("current").cast("double"), "prior": C("prior").cast("double")})


@query(f"WITH {A.BASE_PREV} SELECT ticker, CAST(fy AS INT) AS fy, round(CASE WHEN issuer % 3 = 0 THEN revenue_prev ELSE revenue_prev / 1000 * 1000 END, 4) AS previous_value FROM p")
def comparative_from_array(spark, sf):
    w = A.with_previous(A.annual(spark, sf))
    v = S.previous_value(F.when(C("issuer") % 3 == 0, C("revenue_prev")), F.array(C("revenue") / 1000, C("revenue_prev") / 1000), F.lit(1000.0))
    return w.select("ticker", "fy", F.round(v, 4).alias("previous_value"))


# ---------------------------------------------------------------- liquidity
@query(f"WITH {_LIQ} SELECT lt_ticker AS ticker, {R6('average_volume', 'median_volume')}, liquidity_days, first_date, last_date FROM lq".replace("k <= 28", "k <= 20"))
def liquidity_latest20(spark, sf):
    return r6(L.summaries(_daily(spark, sf), 20))


@query("SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS trading_date, round(arg_max(value, event_id), 6) AS share_volume FROM events GROUP BY ALL")
def liquidity_daily_upsert(spark, sf):
    e = A.table(spark, sf, "events").select(C("user_id").cast("string").alias("ticker"), C("ts").cast("date").alias("trading_date"), C("value").alias("share_volume"), C("event_id").alias("ord"))
    return r6(L.upsert(e.where("ord % 2 = 0"), e.where("ord % 2 = 1")).select("ticker", "trading_date", "share_volume"))


@query("""WITH d AS (SELECT CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS trading_date, arg_max(value, event_id) AS v FROM events GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY trading_date DESC) AS k FROM d)
SELECT ticker, round(avg(v), 6) AS average_volume, round(median(v), 6) AS median_volume, count(*) AS liquidity_days, min(trading_date) AS first_date, max(trading_date) AS last_date FROM k WHERE k <= 20 GROUP BY ticker""")
def liquidity_stream_latest20(spark, sf):
    """The summary of the latest 20 days from state that is kept for each ticker of a stream."""
    snapshots = lambda e: e.select(C("ts").cast("date").alias("trading_date"), C("user_id").cast("string").alias("ticker"), C("value").alias("share_volume"), C("event_id").alias("ord"))
    return r6(daily.latest_days_available_now(spark, f"{sf}/events.parquet", snapshots))


@query("WITH m AS (SELECT max(CAST(ts AS DATE)) AS trading_date FROM events), d AS (SELECT user_id, max(ts) AS last FROM events GROUP BY user_id) SELECT user_id AS ticker, trading_date, CAST(last AS DATE) AS last_date FROM d, m")
def trading_date_and_liquidity_join(spark, sf):
    e = A.table(spark, sf, "events").withColumn("ms", F.unix_millis(C("ts").cast("timestamp")))
    last = e.groupBy(C("user_id").alias("ticker")).agg(F.max("ms").alias("ms")).withColumn("last_date", P.epoch_date(C("ms")))
    return last.crossJoin(F.broadcast(L.trading_date(last, "last_date"))).select("ticker", "trading_date", "last_date")  # one row


@query("SELECT user_id AS ticker, CAST(ts AS DATE) AS trading_date, count(*) AS trade_count FROM events GROUP BY ALL")
def liquidity_stream_daily(spark, sf):
    return daily.daily_counts_available_now(spark, f"{sf}/events.parquet")


# ---------------------------------------------------------------- text


@query("""WITH a AS (SELECT l_linenumber % 4 AS f, CAST(l_extendedprice AS DECIMAL(18,2)) AS e FROM lineitem) SELECT CAST(f AS INT) AS f, CAST(e AS DOUBLE) AS e,
 CASE WHEN f = 0 THEN -CAST(e AS DOUBLE) WHEN f = 3 THEN NULL ELSE CAST(e AS DOUBLE) END AS value FROM a""")
def parse_number_tokens(spark, sf):
    a = A.table(spark, sf, "lineitem").select((C("l_linenumber") % 4).cast("int").alias("f"), C("l_extendedprice").cast("decimal(18,2)").alias("e"))
    plain = C("e").cast("string")
    text = F.when(C("f") == 0, F.concat(F.lit("("), F.format_number("e", 2), F.lit(")"))).when(C("f") == 1, F.format_number("e", 2)).when(C("f") == 2, F.replace(plain, F.lit("."), F.lit(","))).otherwise("-")
    return a.select("f", C("e").cast("double").alias("e"), X.parse_number(text).cast("double").alias("value"))


_UNITS = ("Rupees in thousands", "Rs. mn", "LKR billion", "Rs. '000", "Rs. 14,556,000", "Owners of the parent 14,051,822")


@query("SELECT c_custkey AS k, u.unit, CAST(u.multiplier AS DOUBLE) AS multiplier FROM customer JOIN (VALUES (0, 'LKR ''000', 1000.0), (1, 'LKR million', 1e6), (2, 'LKR billion', 1e9), (3, 'LKR ''000', 1000.0), (4, 'LKR', 1.0), (5, NULL, NULL)) u(i, unit, multiplier) ON u.i = c_custkey % 6")
def detect_unit(spark, sf):
    t = F.element_at(F.array(*map(F.lit, _UNITS)), (C("c_custkey") % 6 + 1).cast("int"))
    u = X.detect_unit(t)
    return A.table(spark, sf, "customer").select(C("c_custkey").alias("k"), u["unit"].alias("unit"), u["multiplier"].cast("double").alias("multiplier"))


@query("SELECT c_custkey AS k, CAST(CAST(c_acctbal AS DECIMAL(18,2)) * CASE c_custkey % 3 WHEN 0 THEN 1000 WHEN 1 THEN 1000000 ELSE 1 END AS DOUBLE) AS value FROM customer")
def normalize_amounts(spark, sf):
    t = F.element_at(F.array(F.lit("Rs. '000"), F.lit("Rs. mn"), F.lit("Rs. 5")), (C("c_custkey") % 3 + 1).cast("int"))
    return A.table(spark, sf, "customer").select(C("c_custkey").alias("k"), X.normalize_monetary(C("c_acctbal").cast("decimal(18,2)"), t).cast("double").alias("value"))


@query("""SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 3 THEN NULL WHEN 4 THEN CASE WHEN year(o_orderdate) >= 2000 THEN make_date(CAST(year(o_orderdate) AS INT) + 1, 3, 31) END ELSE CASE WHEN year(o_orderdate) >= 2000 THEN CAST(o_orderdate AS DATE) END END AS period_end FROM orders""")
def period_end_from_title(spark, sf):
    d = C("o_orderdate").cast("date")
    y = F.year(d)
    title = (
        F.when(C("o_orderkey") % 5 == 0, F.concat(F.lit("Interim "), F.date_format(d, "dd/MM/yyyy")))
        .when(C("o_orderkey") % 5 == 1, F.concat(F.lit("for the quarter ended "), F.date_format(d, "d"), F.lit("th "), F.date_format(d, "MMMM yyyy")))
        .when(C("o_orderkey") % 5 == 2, F.concat(F.lit("accounts at "), F.date_format(d, "dd.MM.yyyy")))
        .when(C("o_orderkey") % 5 == 3, F.lit("Circular to shareholders"))
        .otherwise(F.concat(F.lit("Annual Report "), y.cast("string"), F.lit("/"), F.lpad(((y + 1) % 100).cast("string"), 2, "0")))
    )
    # only years of this century are read from a title
    return A.table(spark, sf, "orders").select(C("o_orderkey").alias("k"), P.period_end(title).alias("period_end"))


@query("""SELECT k, CASE WHEN d = last_day(d) AND n BETWEEN 1 AND 11 THEN n ELSE 0 END AS months FROM (SELECT o_orderkey AS k, d, CAST((year(d) - year(a)) * 12 + month(d) - month(a) AS INT) AS n FROM
 (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN last_day(CAST(o_orderdate AS DATE)) ELSE CAST(o_orderdate AS DATE) END AS d, make_date(CAST(year(o_orderdate) AS INT) - 1, 12, 31) AS a FROM orders))""")
def months_since(spark, sf):
    d = C("o_orderdate").cast("date")
    end = F.when(C("o_orderkey") % 2 == 0, F.last_day(d)).otherwise(d)
    return A.table(spark, sf, "orders").select(C("o_orderkey").alias("k"), F.coalesce(P.months_since(F.make_date(F.year(d) - 1, F.lit(12), F.lit(31)), end), F.lit(0)).alias("months"))


@query("SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS uploaded FROM orders WHERE o_orderkey % 4 <> 0 UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderkey % 4 = 0")
def uploaded_date_parse(spark, sf):
    t = F.when(C("o_orderkey") % 4 == 0, F.lit("soon")).otherwise(F.concat(F.date_format("o_orderdate", "dd MMM yyyy"), F.lit(" 03:15:00 PM")))
    return A.table(spark, sf, "orders").select(C("o_orderkey").alias("k"), P.uploaded_date(t).alias("uploaded"))


_TITLES = (("Annual Report 2024", "annual_report"), ("Errata to the Annual Report 2024/25", None), ("Interim Financial Statements", "interim_statement"), ("Audited Financial Statement 2023", "annual_report"), ("Accounts for the quarter ended 31st March", "interim_statement"), ("Circular", None), ("Prospectus and quarterly results", None))


@query("SELECT o_orderkey AS k, t.kind FROM orders JOIN (VALUES " + ", ".join(f"({i}, {'NULL' if k is None else repr(k)})" for i, (_, k) in enumerate(_TITLES)) + ") t(i, kind) ON t.i = o_orderkey % 7")
def filing_kind_classify(spark, sf):
    t = F.element_at(F.array(*[F.lit(x) for x, _ in _TITLES]), (C("o_orderkey") % 7 + 1).cast("int"))
    return A.table(spark, sf, "orders").select(C("o_orderkey").alias("k"), X.filing_kind(t).alias("kind"))


def _lines(spark, sf):
    """(doc_id, n, line): the non-blank lines of the documents, from 0."""
    d = A.table(spark, sf, "documents")
    return d.select("doc_id", F.posexplode(X.clean_lines(F.coalesce("text", F.lit("")))).alias("n", "line"))


_LINES = r"ll AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '\r?\n|\r'), lambda x: trim(regexp_replace(x, '[ \t\n\v\f\r]+', ' ', 'g'))), lambda x: x <> '') AS l FROM documents), ln AS (SELECT doc_id, unnest(l) AS line, CAST(generate_subscripts(l, 1) - 1 AS INT) AS n FROM ll)"


@query(f"WITH {_LINES} SELECT doc_id, n, line FROM ln")
def whitespace_lines(spark, sf):
    return _lines(spark, sf)


_P1, _P2 = "license|licensed|the of", "work|software|and the"


@query(f"""WITH {_LINES}, t AS (SELECT *, regexp_extract(line, '(?i){_P1}') AS m, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS k FROM ln WHERE regexp_matches(line, '(?i){_P1}') AND regexp_matches(line, '(?i){_P2}')),
x AS (SELECT doc_id, n, line, m, strpos(line, m) AS pos FROM t WHERE k <= 3) SELECT doc_id, n, line[greatest(1, pos - 180):pos + length(m) + 219] AS excerpt FROM x""")
def one_off_excerpts_top3(spark, sf):
    lines = _lines(spark, sf).withColumns({"page_no": F.lit(1), "line_no": C("n")})
    return LY.first_one_offs(lines, 3, f"(?i){_P1}", f"(?i){_P2}").select("doc_id", C("line_no").alias("n"), "excerpt")


_PATTERNS = [("mail", r"[a-z]+@[a-z]+"), ("number", r"[0-9]{6}"), ("licence", r"(?i)license"), ("the", r"(?i)\bthe\b")]


@query(f"WITH {_LINES}, m AS (SELECT *, CASE {' '.join(f'''WHEN regexp_matches(line, '{p}') THEN {i}''' for i, (_, p) in enumerate(_PATTERNS))} END AS p FROM ln) SELECT doc_id, n, CASE p WHEN 0 THEN 'mail' WHEN 1 THEN 'number' WHEN 2 THEN 'licence' ELSE 'the' END AS pattern FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p, n) AS k FROM m WHERE p IS NOT NULL) WHERE k = 1")
def pattern_priority_first_match(spark, sf):
    return RK.first_by_pattern(_lines(spark, sf), ["doc_id"], _PATTERNS, ["n"]).select("doc_id", "n", "pattern")


@query(f"WITH {_LINES}, s AS (SELECT *, max(CASE WHEN length(line) > 400 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS stop, count(*) OVER (PARTITION BY doc_id ORDER BY n) AS c FROM ln) SELECT doc_id, n FROM s WHERE stop = 0 AND c <= 30")
def header_take_while(spark, sf):
    return RK.take_while(_lines(spark, sf), ["doc_id"], "n", F.length("line") > 400).select("doc_id", "n")


@query(f"WITH {_LINES}, h AS (SELECT *, last_value(CASE WHEN length(line) < 60 THEN n END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY n) AS heading_at FROM ln) SELECT doc_id, n, heading_at FROM h WHERE length(line) > 200 AND n > heading_at AND n - heading_at <= 4")
def heading_within_n_rows(spark, sf):
    return RK.under_heading(_lines(spark, sf), ["doc_id"], "n", F.length("line") < 60, F.length("line") > 200).select("doc_id", "n", "heading_at")


@query(f"WITH {_LINES}, c AS (SELECT doc_id, list_sort(list(CAST(len(string_split(line, ' ')) AS INT))) AS c FROM ln GROUP BY doc_id) SELECT doc_id, c[len(c) // 2 + 1] AS upper_median FROM c")
def upper_median_of_counts(spark, sf):
    counts = _lines(spark, sf).select("doc_id", F.size(F.split("line", " ")).alias("k"))
    return SL.exact_upper_medians(counts, ["doc_id"], "k").select("doc_id", C("median").alias("upper_median"))


@query(f"WITH {_LINES}, f AS (SELECT *, regexp_matches(line, '(?i)license') AS hit FROM ln), a AS (SELECT *, bool_or(hit) OVER (PARTITION BY doc_id) AS has FROM f) SELECT doc_id, n, hit AND regexp_matches(line, '(?i)the') AS at_the_end FROM a WHERE hit OR NOT has")
def candidate_pages_fallback(spark, sf):
    rows = _lines(spark, sf).withColumns({"heading": C("line").rlike("(?i)license"), "highlights": C("line").rlike("(?i)the"), "page_no": C("n")})
    return LY.candidate_pages(rows).select("doc_id", "n", C("scan_order.last").alias("at_the_end"))


@query(r"""WITH p AS (SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1), lambda x: trim(regexp_replace(x, '<[^>]*>', '', 'g'))), lambda x: x <> '') AS items FROM pages) SELECT page_id, coalesce(array_to_string(items, ' | '), '') AS items FROM p""")
def page_list_items(spark, sf):
    """The items of all lists of a page as one row of a table."""
    from ..sources.pages import table_rows

    items = F.coalesce(F.expr(r"regexp_extract_all(html, '(?s)<li[^>]*>(.*?)</li>', 1)"), F.array().cast("array<string>"))
    clean = F.filter(F.transform(items, lambda x: F.trim(F.regexp_replace(x, "<[^>]*>", ""))), lambda x: x != "")
    return A.table(spark, sf, "pages").select("page_id", F.array_join(table_rows(F.array(clean)), "\n").alias("items"))


@query("SELECT page_id FROM pages WHERE contains(lower(html), '<li>') AND contains(lower(html), 'href')")
def pages_with_terms(spark, sf):
    from ..sources.pages import pages_with

    return pages_with(A.table(spark, sf, "pages").select("page_id", C("html").alias("text")), "<li>", "HREF").select("page_id")


@query("""WITH d AS (SELECT doc_id // 40 AS report, doc_id, length(regexp_replace(text, '[ \t\n\v\f\r]', '', 'g')) < 700 AS thin, doc_id % 3 = 0 AS image, regexp_matches(text, '(?i)license') AS st FROM documents),
w AS (SELECT *, count(*) FILTER (thin AND image) OVER (PARTITION BY report) AS k, count(*) OVER (PARTITION BY report) AS n, max(CASE WHEN st THEN 1 ELSE 0 END) OVER (PARTITION BY report ORDER BY doc_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near FROM d)
SELECT doc_id, thin AND image AND (k >= 0.75 * n OR (k >= 3 AND k >= 0.25 * n) OR near = 1) AS ocr FROM w""")
def ocr_route_page_window(spark, sf):
    """Forty texts in a row are the pages of a report."""
    from ..sources.pages import ocr_candidates

    d = A.table(spark, sf, "documents").select(F.floor(C("doc_id") / 40).alias("report"), "doc_id", (F.length(F.regexp_replace("text", r"\s", "")) < 700).alias("thin"), (C("doc_id") % 3 == 0).alias("image"), C("text").rlike("(?i)license").alias("statement"))
    return ocr_candidates(d, "report", "doc_id").select("doc_id", "ocr")


@query("SELECT lang, string_agg(DISTINCT source, '; ' ORDER BY source) AS methods FROM documents GROUP BY lang")
def methods_joined(spark, sf):
    return A.table(spark, sf, "documents").groupBy("lang").agg(SM.distinct_joined("source").alias("methods"))


@query("SELECT doc_id, concat_ws('; ', nullif(lang, ''), CASE WHEN n_chars > 1000 THEN 'long' END, CASE WHEN doc_id % 2 = 0 THEN NULLIF('', '') ELSE 'odd' END) AS notes FROM documents")
def notes_joined(spark, sf):
    return A.table(spark, sf, "documents").select("doc_id", X.joined(C("lang"), F.when(C("n_chars") > 1000, "long"), F.when(C("doc_id") % 2 == 0, "").otherwise("odd")).alias("notes"))


@query("SELECT p_partkey AS k, 'a & b, ' || lower(p_name) AS name FROM part")
def group_name_normalise(spark, sf):
    return A.table(spark, sf, "part").select(C("p_partkey").alias("k"), X.normalize_group(F.concat(F.lit("  S&P/CSE  A&B ,"), C("p_name"))).alias("name"))


@query("SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'NA' ELSE format('{:,.2f}', CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS DOUBLE)) || '%' END AS shown FROM orders")
def render_metric(spark, sf):
    v = F.when(C("o_orderkey") % 5 != 0, C("o_totalprice").cast("decimal(18,2)"))
    return A.table(spark, sf, "orders").select(C("o_orderkey").alias("k"), X.render_metric(v, "percent").alias("shown"))


@query("SELECT o_orderkey AS k, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS quarter, CASE WHEN o_orderkey % 4 = 0 THEN '15 months to ' ELSE 'FY to ' END || strftime(o_orderdate, '%Y-%m-%d') AS label FROM orders")
def period_labels(spark, sf):
    d = C("o_orderdate").cast("date")
    return A.table(spark, sf, "orders").select(C("o_orderkey").alias("k"), P.quarter_label(d).alias("quarter"), P.period_label(F.when(C("o_orderkey") % 4 == 0, 15), d).alias("label"))


@query("SELECT o_custkey || ':' || strftime(o_orderdate, '%Y-%m-%d') || ':' || o_orderpriority || ':' || o_orderkey AS fact_id FROM orders")
def fact_ids(spark, sf):
    return A.table(spark, sf, "orders").select(X.fact_id(C("o_custkey"), C("o_orderdate").cast("date"), C("o_orderpriority"), C("o_orderkey")).alias("fact_id"))


# ---------------------------------------------------------------- unions and review
def _review(spark, sf):
    """Review rows of all five origins, with the order in which they arrive."""
    sums = A.period_sums(spark, sf)
    v = V.validate(_validated(spark, sf, sums)).select("issuer", "ticker", F.explode_outer("rules").alias("rule")).where("rule is not null").select("issuer", "ticker", "rule", F.concat(F.lit("group "), (C("issuer") % 5).cast("string")).alias("reason"))
    m = missing_metric_anti(spark, sf, sums).select(C("ticker").cast("long").alias("issuer"), "ticker", F.lit("missing_metric").alias("rule"), C("metric").alias("reason"))
    s = A.table(spark, sf, "supplier").select(C("s_suppkey").alias("issuer"), C("s_suppkey").cast("string").alias("ticker"))
    parser = s.where("issuer % 6 = 2").select("*", F.lit("page read without tables").alias("reason"))
    basis = s.where("issuer % 8 = 5").select("*", F.lit("interim not confirmed").alias("reason"))
    errors = s.where("issuer % 20 = 19").select("*", F.lit("no document").alias("reason"))
    return SM.review_rows({"parser_fallback": parser, "validation": v, "period_basis": basis, "missing_metric": m, "document_error": errors})


_REVIEW = f"""{_VAL}, vr AS (SELECT issuer, ticker, unnest([CASE WHEN low THEN 'low_confidence' END, CASE WHEN eq THEN 'accounting_equation' END, CASE WHEN scale THEN 'profit_revenue_scale' END, CASE WHEN sgn THEN 'eps_profit_sign' END, CASE WHEN eid THEN 'eps_identity' END, CASE WHEN cnt THEN 'share_count_identity' END, CASE WHEN bad_bv THEN 'bvps_identity' END, CASE WHEN bad_dps THEN 'dps_range' END]) AS rule, 'group ' || issuer % 5 AS reason FROM v7),
mm AS ({ORACLES['missing_metric_anti'].replace(f'WITH {A.BASE}, s AS', 'WITH s AS')}),
rv AS (SELECT issuer, ticker, rule, reason FROM vr WHERE rule IS NOT NULL UNION ALL SELECT CAST(ticker AS BIGINT), ticker, 'missing_metric', metric FROM mm
 UNION ALL SELECT s_suppkey, CAST(s_suppkey AS VARCHAR), 'parser_fallback', 'page read without tables' FROM supplier WHERE s_suppkey % 6 = 2 UNION ALL SELECT s_suppkey, CAST(s_suppkey AS VARCHAR), 'period_basis', 'interim not confirmed' FROM supplier WHERE s_suppkey % 8 = 5
 UNION ALL SELECT s_suppkey, CAST(s_suppkey AS VARCHAR), 'document_error', 'no document' FROM supplier WHERE s_suppkey % 20 = 19)"""


@query(f"WITH {_REVIEW} SELECT ticker, rule, reason FROM rv")
def union_review_sources(spark, sf):
    return _review(spark, sf).select("ticker", "rule", "reason")


@query(f"""WITH {_REVIEW}, r AS (SELECT rule, reason, count(*) AS k, min(issuer) AS f FROM rv GROUP BY ALL), o AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY f, reason) AS i FROM r),
g AS (SELECT rule, CAST(sum(k) AS BIGINT) AS n, string_agg(reason, ' | ' ORDER BY i) FILTER (i <= 3) AS reasons, CAST(greatest(count(*) - 3, 0) AS INT) AS more FROM o GROUP BY rule), t AS (SELECT rule, string_agg(DISTINCT ticker, ', ' ORDER BY ticker) AS tickers FROM rv GROUP BY rule) SELECT rule, n, tickers, reasons, more FROM g JOIN t USING (rule)""")
def warning_groups(spark, sf):
    return SM.warning_groups(_review(spark, sf).withColumnRenamed("issuer", "ord"))


@query("SELECT 'document' AS origin, CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title, NULL AS announcement, NULL AS volume FROM orders UNION ALL SELECT 'dividend', CAST(event_id AS VARCHAR), NULL, event_type, NULL FROM events WHERE event_type = 'purchase' UNION ALL SELECT 'liquidity', CAST(user_id AS VARCHAR), NULL, NULL, CAST(count(*) AS VARCHAR) FROM events GROUP BY user_id")
def union_sources_missing_columns(spark, sf):
    o, e = A.table(spark, sf, "orders"), A.table(spark, sf, "events")
    a = o.select(F.lit("document").alias("origin"), C("o_orderkey").cast("string").alias("id"), C("o_orderpriority").alias("title"))
    b = e.where("event_type = 'purchase'").select(F.lit("dividend").alias("origin"), C("event_id").cast("string").alias("id"), C("event_type").alias("announcement"))
    c = e.groupBy("user_id").agg(F.count("*").cast("string").alias("volume")).select(F.lit("liquidity").alias("origin"), C("user_id").cast("string").alias("id"), "volume")
    return a.unionByName(b, allowMissingColumns=True).unionByName(c, allowMissingColumns=True)


@query(r"""WITH ll AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), ' ')) AS t, generate_subscripts(string_split(coalesce(text, ''), ' '), 1) - 1 AS i FROM documents),
c AS (SELECT *, regexp_matches(t, '^(\(-?\d[\d,]*(\.\d+)?\)|-?\d[\d,]*(\.\d+)?)%?\*{0,2}$') OR t IN ('-', '–', '—', 'nil', 'Nil', 'NIL') AS ok FROM ll),
g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM c WHERE ok), r AS (SELECT doc_id, island, count(*) AS n, max(i) AS last FROM g GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, last DESC) AS k FROM r)
SELECT d.doc_id, CAST(coalesce(n, 0) AS INT) AS n, CAST(coalesce(last, -1) AS INT) AS last FROM documents d LEFT JOIN b ON b.doc_id = d.doc_id AND k = 1""")
def longest_numeric_run(spark, sf):
    run = X.longest_run(F.split(F.coalesce("text", F.lit("")), " ", -1))
    return A.table(spark, sf, "documents").select("doc_id", run.alias("r")).select("doc_id", "r.n", "r.last")


def _report_pages(spark, sf):
    """Issuers' figures of the last year as the pages of a report: a cover, income, position and cash-flow statement with columns of the group and
    the company, and a page on the shares."""
    w = A.with_previous(A.annual(spark, sf)).where(C("fy") == A.LAST_FY)

    def cell(c, places):
        v = F.round(C(c) / 1000) if not places else F.round(c, places)
        return F.when(v < 0, F.concat(F.lit("("), F.format_number(F.abs(v), places), F.lit(")"))).otherwise(F.format_number(v, places))

    def row(label, m, places=0):
        return F.when(C(m).isNull(), f"{label} - - - -").otherwise(F.concat(F.lit(label + " "), cell(m, places), F.lit(" "), F.coalesce(cell(f"{m}_prev", places), F.lit("-")), F.lit(" 1.00 1.00" if places else " 1 1")))

    head = "Group Company\nFor the year ended 31 December 2001 2000 2001 2000\nRs.'000 Rs.'000 Rs.'000 Rs.'000"
    page = lambda title, *rows: F.concat_ws("\n", F.lit(title), F.lit(head), *rows)
    fill = lambda *labels: [F.lit(f"{x} 1,000 2,000 1 1") for x in labels]
    pages = F.array(
        F.lit("Report of the directors"),
        page("STATEMENT OF PROFIT OR LOSS", row("Revenue", "revenue"), *fill("Cost of sales", "Gross profit", "Other income", "Administrative expenses"), row("Profit/(loss) for the year", "net_profit"), F.lit("Profit attributable to:"), row("Owners of the parent", "net_profit_attributable"), row("Basic earnings per share", "eps", 2), row("Dividends per share", "dps", 2)),
        page("STATEMENT OF FINANCIAL POSITION", *fill("Inventories", "Trade and other receivables", "Stated capital"), row("Cash & cash equivalents", "cash"), row("Total assets", "total_assets"), row("Equity attributable to owners of the parent", "ordinary_equity"), row("Total equity", "total_equity"), row("Borrowings", "total_debt"), row("Total liabilities", "total_liabilities")),
        page("STATEMENT OF CASH FLOWS", row("Net cash generated from operating activities", "operating_cash_flow"), row("Purchase of property, plant and equipment", "capital_expenditure"), *fill("Net cash used in investing activities", "Net cash used in financing activities", "Net increase in cash and cash equivalents")),
        F.concat(F.lit("Our shares\nNumber of shares in issue "), F.format_number(F.round("ordinary_shares_outstanding"), 0)),
    )
    return w.select("ticker", F.posexplode(pages).alias("page_no", "text")).select(C("ticker").alias("doc_id"), (C("page_no") + 1).alias("page_no"), "text")


def _filings(spark, sf):
    return A.table(spark, sf, "supplier").select(C("s_suppkey").cast("string").alias("doc_id"), F.lit("annual_report").alias("kind"))


_SHOWN = {m: (page, share) for page, share, names in ((2, False, ("revenue", "net_profit", "net_profit_attributable")), (2, True, ("eps", "dps")), (3, False, ("cash", "total_assets", "ordinary_equity", "total_equity", "total_debt", "total_liabilities")), (4, False, ("operating_cash_flow", "capital_expenditure"))) for m in names}


@query(f"""WITH {A.BASE_PREV}, m AS (SELECT * FROM (VALUES {', '.join(f"('{m}', {page}, {share})" for m, (page, share) in _SHOWN.items())}) m(metric, page, share)),
v AS (SELECT * FROM (UNPIVOT (SELECT ticker, {', '.join(_SHOWN)} FROM p WHERE fy = 2000) ON {', '.join(_SHOWN)} INTO NAME metric VALUE value)), q AS (SELECT * FROM (UNPIVOT (SELECT ticker, {', '.join(f'{m}_prev AS {m}' for m in _SHOWN)} FROM p WHERE fy = 2000) ON {', '.join(_SHOWN)} INTO NAME metric VALUE prev))
SELECT ticker AS doc_id, metric, CASE WHEN share THEN round(value, 2) ELSE round(value / 1000) * 1000 END + 0.0 AS value, CASE WHEN share THEN round(prev, 2) ELSE round(prev / 1000) * 1000 END + 0.0 AS previous_value, CASE WHEN share THEN 'LKR' ELSE 'LKR ''000' END AS unit,
 CASE WHEN metric = 'total_debt' THEN 0.88::DOUBLE ELSE 0.90::DOUBLE END AS confidence, 'group' AS statement_scope, CAST(page AS INT) AS page, CASE WHEN metric = 'total_debt' THEN 'component_sum' ELSE 'primary_statement' END AS extraction_method FROM v JOIN m USING (metric) LEFT JOIN q USING (ticker, metric)
UNION ALL SELECT ticker, 'ordinary_equity', round(total_equity / 1000) * 1000 + 0.0, NULL, 'LKR ''000', 0.90::DOUBLE, 'group', 3, 'derived' FROM p WHERE fy = 2000 AND ordinary_equity IS NULL
UNION ALL SELECT ticker, 'ordinary_shares_outstanding', round(ordinary_shares_outstanding) + 0.0, NULL, 'shares', 0.90::DOUBLE, 'unknown', 5, 'ordinary_share_count' FROM p WHERE fy = 2000""")
def layout_extract_facts(spark, sf):
    """All that the reader finds on pages that are written from known figures."""
    pages = _report_pages(spark, sf)
    f = LY.extract_facts(pages, _filings(spark, sf))
    shown = {c: (C(c).cast("double") + 0.0).alias(c) for c in ("value", "previous_value", "confidence")}
    return f.select("doc_id", "metric", *shown.values(), "unit", "statement_scope", "page", "extraction_method")


def _order_pages(spark, sf):
    """Orders as interim pages, one for each: company columns ahead of the group's or behind them, rising or falling years, two periods or one, notes ahead of amounts,
    rows of odd numbers of cells, and a label over two lines."""
    o = A.table(spark, sf, "orders").withColumns({"k": C("o_orderkey"), "a": F.floor("o_totalprice").cast("long") + 1000})
    number = lambda c: F.format_number(c, 0)
    four = F.concat_ws(" ", *[number(C("a") + i) for i in (0, 10, 20, 30)])
    years = F.when(C("k") % 3 == 0, "2029 2030 2029 2030").otherwise("2030 2029 2030 2029")
    scopes = F.when(C("k") % 2 == 0, "Group Company").otherwise("Company Group")
    text = F.concat_ws(
        "\n", F.lit("STATEMENT OF PROFIT OR LOSS"), scopes, F.when(C("k") % 5 == 0, "Quarter ended 30 June").otherwise("Six months ended 30 June"), F.concat(F.lit("Note "), years), F.concat(F.lit("Revenue "), F.when(C("k") % 4 == 0, "12 ").otherwise(""), four),
        F.lit("Net cash generated from operating"), F.concat(F.lit("activities "), four), F.concat(F.lit("Gross profit "), number(C("a")), F.lit(" (5) -")),
    )
    return o.select(C("k").cast("string").alias("doc_id"), F.lit("interim_statement").alias("kind"), F.lit(1).alias("page_no"), text.alias("text"))


_FOUR = lambda i: f"format('{{:,}}', a + {i})"


@query(f"""WITH o AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) + 1000 AS a FROM orders),
r AS (SELECT k, a, 4 AS place, 'Revenue' AS label, [0, 10, 20, 30] AS v FROM o UNION ALL SELECT k, a, 5, 'Net cash generated from operating activities', [0, 10, 20, 30] FROM o UNION ALL SELECT k, a, 7, 'Gross profit', [0] FROM o)
SELECT CAST(k AS VARCHAR) AS doc_id, CAST(place AS INT) AS place, label, CASE WHEN place = 7 THEN {_FOUR(0)} || ' (5) -' ELSE concat_ws(' ', {', '.join(_FOUR(i) for i in (0, 10, 20, 30))}) END AS cells,
 CASE WHEN place = 7 THEN CASE WHEN k % 2 = 0 AND k % 3 = 0 THEN -5 WHEN k % 2 = 0 THEN a WHEN k % 3 = 0 THEN NULL ELSE -5 END WHEN k % 2 = 0 AND k % 3 = 0 THEN a + 10 WHEN k % 2 = 0 THEN a WHEN k % 3 = 0 THEN a + 30 ELSE a + 20 END AS current,
 CASE WHEN place = 7 THEN CASE WHEN k % 2 = 0 AND k % 3 = 0 THEN a WHEN k % 2 = 0 THEN -5 WHEN k % 3 = 0 THEN -5 ELSE NULL END WHEN k % 2 = 0 AND k % 3 = 0 THEN a WHEN k % 2 = 0 THEN a + 10 WHEN k % 3 = 0 THEN a + 20 ELSE a + 30 END AS previous,
 CASE WHEN place <> 7 THEN 0.9::DOUBLE WHEN k % 2 = 0 THEN 0.85::DOUBLE ELSE 0.6::DOUBLE END AS sure, CASE WHEN k % 5 = 0 THEN 3 ELSE 6 END AS months, CASE WHEN k % 2 = 0 THEN 'group,company' ELSE 'company,group' END AS scopes FROM r""")
def page_logical_rows(spark, sf):
    """Rows of pages: labels over two lines, amounts without notes, the wanted pair of columns, and what the header says of them."""
    read = PR.with_pages(_order_pages(spark, sf))
    rows = PR.logical_rows(read, ["doc_id", "page_no", "months", "years", "starts", "falling", "change", "scopes", "block"], bare=False).where(C("place") > 3)
    pair = PR.column_pair(F.transform("cells", PR.amount), *[C(c) for c in ("years", "starts", "falling", "change", "scopes", "block", "counts")])
    rows = rows.withColumn("p", pair)
    return rows.select("doc_id", "place", "label", F.array_join("cells", " ").alias("cells"), C("p.current").cast("bigint").alias("current"), C("p.previous").cast("bigint").alias("previous"), C("p.sure").cast("double").alias("sure"), "months", F.array_join("scopes", ",").alias("scopes"))


@query(f"""WITH o AS (SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) + 1000 AS a FROM orders), t AS (SELECT k, a, t.tag, t.place, t.ord FROM o, (VALUES ('metric:revenue', 4, 1), ('row:income:revenue', 4, 0), ('flow:revenue', 4, 0), ('metric:operating_cash_flow', 5, 0), ('row:cash_flow:operating', 5, 0), ('flow:operating_cash_flow', 5, 0), ('row:income:gross_profit', 7, 0)) t(tag, place, ord))
SELECT CAST(k AS VARCHAR) AS doc_id, CAST(place AS INT) AS place, tag, CAST(ord AS INT) AS ord FROM t""")
def label_phrases(spark, sf):
    """The phrases that the labels of pages have, by a join with the table of phrases."""
    rows = PR.logical_rows(PR.with_pages(_order_pages(spark, sf)), ["doc_id", "page_no"], bare=False)
    return PH.with_tags(rows, ["doc_id", "place"], ["label"]).select("doc_id", "place", "tag", "ord")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS doc_id, statement, CAST(page AS INT) AS page FROM supplier, (VALUES ('income', 2), ('position', 3), ('cash_flow', 4)) m(statement, page)")
def statement_score_band_join(spark, sf):
    """The pages that the reader takes for the three statements, by score and place."""
    pages = _report_pages(spark, sf)
    return LY.statement_pages(pages, _filings(spark, sf))
