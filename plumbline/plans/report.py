"""The whole screening run: inputs as DataFrames in, the output tables as lazy DataFrames out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions import text as X
from ..operators import flags as FL
from ..operators import history as H
from ..operators import liquidity as L
from ..operators import overlays as O
from ..operators import provenance as PV
from ..operators import ranking as RK
from ..operators import screening as S
from ..operators import summary as SM
from ..operators import validation as V
from ..schemas import HISTORY_METRICS, REQUIRED_METRICS
from ..session import materialize
from ..sources.settings import DEFAULTS

C = F.col
_CORE = ("revenue", "net_profit", "eps", "total_equity", "operating_cash_flow", "total_assets")


def _with_market_shares(facts: DataFrame, companies: DataFrame, latest: DataFrame, classes: DataFrame) -> DataFrame:
    """facts and, for issuers of one share class without a usable count in their latest annual report, the count that the market implies."""
    reported = facts.where("metric = 'ordinary_shares_outstanding'").join(latest.select(C("doc_id").alias("_doc")), C("doc_id") == C("_doc"), "left_semi")
    implied = V.market_implied_shares(companies.select("ticker", "market_cap", "price"), reported, classes)
    rows = V.market_fact_record(implied, latest)
    kinds = dict(facts.dtypes)
    return facts.unionByName(rows.select(*[C(c).cast(kinds[c]).alias(c) for c in rows.columns if c in kinds]), allowMissingColumns=True)


def screen(companies: DataFrame, documents: DataFrame, facts: DataFrame, snapshots: DataFrame, corrections: DataFrame | None = None, settings: dict | None = None, as_of: str | None = None, warnings: DataFrame | None = None) -> dict[str, DataFrame]:
    """companies(ticker, name, industry_group, price, market_cap), documents and facts as in schemas (facts of annual reports and of interim
    statements by doc_id), snapshots(trading_date, ticker, share_volume, ord), warnings(ticker, metric, rule, reason) of the parser -> screening, ratios,
    provenance, history, raw, flags, review and summary. Identities fill what a document lacks, then its facts are validated, then the market's count of shares stands in
    where none is usable. as_of (a date, today if none) decides whether an annual report is out of date."""
    flags = (settings or DEFAULTS)["flags"]
    facts = facts.withColumns({"value": C("value").cast("double"), "previous_value": S.previous_value(C("previous_value"), C("comparatives"), C("multiplier")).cast("double"), "confidence": C("confidence").cast("double")})
    if corrections is not None:
        fixed = O.correction_facts(corrections, documents).withColumns({"value": C("value").cast("double"), "confidence": F.lit(1.0), "ord": F.lit(1 << 40).cast("long")})
        facts = facts.unionByName(fixed, allowMissingColumns=True)
    for c in ("fact_id", "extraction_method", "page"):
        if c not in facts.columns:
            facts = facts.withColumn(c, F.lit(None).cast("string"))
    latest, classes = RK.latest_annual(documents).select("doc_id", "ticker"), O.share_classes(companies)
    market = companies.join(classes, "ticker").select(C("ticker").alias("_t"), F.when(C("share_classes") == 1, F.try_divide(C("market_cap"), C("price"))).alias("market_shares"))
    # counts are compared in the document whose values are screened; others still have their own identities
    context = latest.join(market, C("ticker") == C("_t"), "left").select("doc_id", "market_shares", F.lit(True).alias("reconciled"))
    # each step reads the facts before it several times, so they are kept in between
    facts, issues = V.validate_facts(materialize(V.with_identities(facts)), context)
    facts = materialize(_with_market_shares(materialize(facts), companies, latest, classes))
    annual_doc = RK.latest_annual(documents).select("doc_id", "period_end", C("ticker").alias("t"))
    of_annual = facts.join(annual_doc, "doc_id").drop("t")
    best = materialize(RK.best_facts(of_annual))
    months = S.period_lengths(best.where(C("metric").isin(*S.INCOME_FLOWS, *S.CASH_FLOWS)))
    interim_docs = S.newest_interim(RK.latest_annual(documents), documents.where("kind = 'interim_statement'"))
    i = facts.join(interim_docs.select("doc_id", "period_end", C("comparative_period_end").alias("prior_end"), C("period_months").alias("months")), "doc_id")
    # columns of another length than the document's, or of none that is known, confirm no year to date; 0 is the document's own
    selected = RK.best_facts(i)
    interim = selected.where(C("period_months").isin(0) | (C("period_months") == C("months"))).select("ticker", "metric", "value", "previous_value", "confidence", "months", "period_end", "prior_end")
    flows = best.where(C("metric").isin(*S.INCOME_FLOWS, *S.CASH_FLOWS)).select("ticker", "metric", "value", "confidence", C("period_end").alias("annual_end"))
    # a year that isn't of twelve months has no trailing figures
    trailing = materialize(S.trailing_rows(flows.join(months.where("months = 12").select("ticker"), "ticker", "left_semi"), interim))
    unproven = flows.select("ticker", "metric").join(selected.where("months is not null and prior_end is not null").where(~F.coalesce(C("period_months").isin(0) | (C("period_months") == C("months")), F.lit(False))).select("ticker", "metric"), ["ticker", "metric"], "left_semi")
    wide = best.groupBy("ticker").agg(F.max("period_end").alias("period_end"), *[F.max(F.when(C("metric") == m, C(c))).alias(m + suffix) for m in REQUIRED_METRICS for c, suffix in (("value", ""), ("previous_value", "_prev"))])
    ttm = trailing.groupBy("ticker").agg(F.max("period_end").alias("ttm_end"), *[F.max(F.when(C("metric") == m, C("ttm"))).alias(f"ttm_{m}") for m in (*S.INCOME_FLOWS, *S.CASH_FLOWS)])
    out = companies.join(wide, "ticker", "left").join(ttm, "ticker", "left").join(S.basis(flows, trailing), "ticker", "left").join(months, "ticker", "left")
    screened = materialize(S.screening_metrics(S.with_flows(out)))
    h = materialize(H.history_rows(facts.join(documents.where("kind = 'annual_report'").select("doc_id", "period_end"), "doc_id"), HISTORY_METRICS))
    ends = RK.latest_annual(documents).select("ticker", F.explode(F.array(F.lit("revenue"), F.lit("eps"))).alias("metric"), C("period_end").alias("end"))
    of_fact = best.select("ticker", "metric", F.lit(True).alias("found"), C("previous_value").alias("previous"))
    compound = materialize(H.chained_cagr(h, ends.join(of_fact, ["ticker", "metric"], "left").join(months, "ticker", "left")).select("ticker", "metric", "cagr", "note"))
    growth = compound.groupBy("ticker").agg(*[F.max(F.when(C("metric") == m, C("cagr"))).alias(f"{m}_cagr_3y") for m in ("revenue", "eps")])
    fell = H.consecutive_decline(h).groupBy("ticker").agg(*[F.bool_or((C("metric") == m) & C("declined")).alias(f"{m}_declined") for m in ("eps", "revenue")])
    volume = L.summaries(snapshots, flags["liquidity_lookback_days"])
    row = screened.join(growth, "ticker", "left").join(fell, "ticker", "left").join(volume, "ticker", "left").join(S.data_confidence(of_annual, list(_CORE)), "ticker", "left")
    row = FL.relative_flags(row, ["industry_group"])
    sure = F.coalesce(C("data_confidence"), F.lit("low"))
    sure = S.stale(F.lit(as_of).cast("date") if as_of else F.current_date(), C("period_end"), sure)
    row = row.withColumns({
        "data_confidence": F.when((C("months") != 12) & (sure == "high"), "review").otherwise(sure),
        "ebit_used": F.coalesce("flow_ebit", "flow_operating_profit"), "ebit_is_proxy": C("flow_ebit").isNull() & C("flow_operating_profit").isNotNull(),
    })
    shown = row.select(C("flow_eps").alias("eps"), C("flow_net_profit").alias("net_profit"), C("flow_operating_cash_flow").alias("operating_cash_flow"), "ocf_to_net_profit", "debt_to_equity", "total_equity", "payout", "average_volume", "liquidity_days", "eps_declined", "revenue_declined", "months")
    limits = {k: v for k, v in flags.items() if k in FL.DEFAULTS}
    names = {"eps": "flow_eps", "net_profit": "flow_net_profit", "operating_cash_flow": "flow_operating_cash_flow"}
    plain = row.drop(*names).withColumnsRenamed({v: k for k, v in names.items()})
    row = plain.withColumn("flags", X.joined(FL.company_flags(shown, **limits), C("relative_flags")))
    label = S.labels(row, "months", "period_end", "ttm_end", "income_basis")
    missing = S.missing_metrics(companies, list(REQUIRED_METRICS), best).withColumn("reason", F.lit("no candidate in the latest annual report"))
    failed = issues.join(documents.select(C("doc_id").alias("_doc"), "ticker"), C("doc_id") == C("_doc")).select("ticker", "metric", "rule", C("doc_id").alias("document"), "reason")
    bare = companies.join(documents.select("ticker").distinct(), "ticker", "left_anti").select("ticker", F.lit("document").alias("metric"), F.lit("no document of the issuer").alias("reason"))
    origins = {"validation": failed, "period_basis": unproven.withColumns({"rule": F.lit("unconfirmed_interim_period"), "reason": F.lit("interim columns of another length")}), "missing_metric": missing, "document_error": bare}
    review = materialize(SM.review_rows(({"parser_fallback": warnings} if warnings is not None else {}) | origins))
    row = materialize(row.withColumn("income_period", label))
    raised = FL.flag_records(row)
    grown = compound.where("cagr is not null").select("ticker", "metric").join(ends, ["ticker", "metric"]).withColumn("start_end", P.prior_year_end(C("end")))
    of_years = RK.best_facts(facts.join(documents.where("kind = 'annual_report'").select("doc_id", "period_end"), "doc_id"), ("ticker", "metric", "period_end"))
    made_of = [PV.ratio_edges(screened, best), PV.flag_edges(raised, screened, best), PV.trailing_edges(trailing, best, selected), PV.derived_edges(facts, V.selected_facts(facts)), PV.growth_edges(grown, of_years)]
    ways = PV.closure(reduce(DataFrame.unionByName, made_of))
    return {
        "screening": row, "ratios": S.lineage(screened, P.period_label(C("months"), C("period_end")), facts, compound, ways), "provenance": ways, "history": H.deduplicate(h),
        "raw": S.mark_used(facts, best, facts.join(trailing.select("ticker", "metric"), ["ticker", "metric"], "left_semi").join(interim_docs.select("doc_id"), "doc_id", "left_semi")),
        "flags": raised, "review": review,
        "summary": SM.summary_lines("Screening summary", row, review.withColumn("ord", F.lit(0))),
    }
