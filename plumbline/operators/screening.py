"""From selected facts to screening rows: trailing figures, period basis, ratios and their lineage.

Works on one wide row per issuer (annual facts `x`, comparatives `x_prev`) and one long table of interim facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions import ratios as R
from ..functions import text as X
from ..schemas import CASH_FLOWS, INCOME_ANCHORS, INCOME_FLOWS

C = F.col


def previous_value(explicit: Column, comparatives: Column, multiplier: Column) -> Column:
    """The comparative column's value: given as such, or the second printed amount in units."""
    return F.coalesce(explicit, F.get(comparatives, F.lit(1)) * F.coalesce(multiplier, F.lit(1)))


def unpivot(wide: DataFrame, ids: list[str], metrics: list[str], name: str = "metric", value: str = "value") -> DataFrame:
    """Long rows of the metrics that aren't null: one pass, no join."""
    return wide.unpivot(ids, metrics, name, value).where(C(value).isNotNull())


def newest_interim(annual: DataFrame, interim: DataFrame) -> DataFrame:
    """As-of join: for each issuer the newest interim document after its newest annual report."""
    from .ranking import top

    a = annual.select(C("ticker").alias("_t"), C("period_end").alias("annual_end"))
    later = interim.join(a, interim.ticker == C("_t")).where("period_end > annual_end").drop("_t")
    return top(later, ["ticker"], [C("period_end").desc(), C("ord").asc()])


def trailing_rows(annual: DataFrame, interim: DataFrame) -> DataFrame:
    """annual(ticker, metric, value, confidence, annual_end) and interim(ticker, metric, value, previous_value, confidence, months,
    period_end, prior_end) -> trailing facts that the periods prove; all of an issuer's income metrics are rejected if its
    revenue to date isn't plausible."""
    i = interim.select("ticker", "metric", C("value").alias("ytd"), C("previous_value").alias("prior"), C("confidence").alias("i_conf"), "months", "period_end", "prior_end")
    t = annual.join(i, ["ticker", "metric"]).withColumn("ttm", R.trailing(C("value"), C("ytd"), C("prior"), C("annual_end"), C("period_end"), C("prior_end"), C("months")))
    bad = F.max(F.when((C("metric") == "revenue") & ~R.plausible_ytd(C("ytd"), C("value"), C("months")), 1).otherwise(0)).over(W.partitionBy("ticker"))
    t = t.withColumn("_bad", bad).where("ttm is not null").where(~((C("_bad") == 1) & C("metric").isin(*INCOME_FLOWS)))
    return t.select("ticker", "metric", "ttm", "ytd", "prior", C("value").alias("annual"), F.least("confidence", "i_conf").alias("confidence"), "period_end")


def basis(annual: DataFrame, trailing: DataFrame) -> DataFrame:
    """(ticker, income_basis, cash_basis): ttm only if each anchor that the annual report has is there as trailing figure too."""
    t = trailing.select("ticker", "metric", F.lit(True).alias("has"))
    a = annual.join(t, ["ticker", "metric"], "left").withColumn("has", F.coalesce("has", F.lit(False)))
    anchors = C("metric").isin(*INCOME_ANCHORS)
    return a.groupBy("ticker").agg(
        F.when(F.coalesce(F.bool_and(F.when(anchors, C("has"))), F.lit(False)), "ttm").otherwise("fy").alias("income_basis"),
        F.when(F.coalesce(F.bool_or(F.when(C("metric") == "operating_cash_flow", C("has"))), F.lit(False)) & F.coalesce(F.bool_and(F.when(C("metric") == "capital_expenditure", C("has"))), F.lit(True)), "ttm").otherwise("fy").alias("cash_basis"),
    )


def mark_used(facts: DataFrame, used: DataFrame, trailing_inputs: DataFrame) -> DataFrame:
    """facts with used_in_screening: yes, yes (TTM input) before it, or null."""
    u = used.select(C("fact_id").alias("_u")).distinct()
    t = trailing_inputs.select(C("fact_id").alias("_t")).distinct()
    out = facts.join(u, facts.fact_id == C("_u"), "left").join(t, facts.fact_id == C("_t"), "left")
    return out.withColumn("used_in_screening", F.when(C("_t").isNotNull(), "yes (TTM input)").when(C("_u").isNotNull(), "yes")).drop("_u", "_t")


#: (name, numerator, denominator, how they are put together), over a row of facts; the lineage rows follow from the same table.
def _ratios() -> dict[str, tuple[Column, str, str, str]]:
    c = C
    profit, equity, equity_prev = F.coalesce("net_profit_attributable", "net_profit"), F.coalesce("ordinary_equity", "total_equity"), F.coalesce("ordinary_equity_prev", "total_equity_prev")
    opening = F.when(c("ordinary_equity").isNotNull(), c("ordinary_equity_prev")).otherwise(equity_prev)
    full = c("months") == 12
    bvps = F.coalesce(c("bvps"), F.try_divide(c("ordinary_equity"), c("ordinary_shares_outstanding")))
    return {
        "revenue_growth": (F.when(full, R.growth(c("revenue"), c("revenue_prev"))), "revenue", "revenue_prev", "(current - previous) / abs(previous)"),
        "net_profit_growth": (F.when(full, R.growth(c("net_profit"), c("net_profit_prev"))), "net_profit", "net_profit_prev", "(current - previous) / abs(previous)"),
        "eps_growth": (F.when(full, R.growth(c("eps"), c("eps_prev"))), "eps", "eps_prev", "(current - previous) / abs(previous)"),
        "roe": (F.when(full, F.try_divide(profit, R.positive((equity + opening) / 2))), "net_profit_attributable", "ordinary_equity", "profit / average equity"),
        "roa": (F.when(full, F.try_divide(c("net_profit"), (c("total_assets") + c("total_assets_prev")) / 2)), "net_profit", "total_assets", "profit / average assets"),
        "debt_to_equity": (F.try_divide(c("total_debt"), R.positive(equity)), "total_debt", "ordinary_equity", "debt / equity"),
        "net_debt": (R.net_debt(c("total_debt"), c("cash")), "total_debt", "cash", "debt - cash"),
        "free_cash_flow": (R.free_cash_flow(c("flow_operating_cash_flow"), c("flow_capital_expenditure")), "operating_cash_flow", "capital_expenditure", "operating cash flow - abs(capex)"),
        "ocf_to_net_profit": (F.try_divide(c("flow_operating_cash_flow"), c("cash_net_profit")), "operating_cash_flow", "net_profit", "operating cash flow / profit"),
        "bvps_used": (bvps, "ordinary_equity", "ordinary_shares_outstanding", "equity / shares"),
        "pe": (F.try_divide(c("price"), R.positive(c("flow_eps"))), "price", "eps", "price / eps"),
        "earnings_yield": (F.try_divide(c("flow_eps"), c("price")), "eps", "price", "eps / price"),
        "pb": (F.try_divide(c("price"), R.positive(bvps)), "price", "bvps", "price / book value per share"),
        "dividend_yield": (F.try_divide(c("dps"), c("price")), "dps", "price", "dps / price"),
        "payout": (F.try_divide(c("dps"), R.positive(c("eps"))), "dps", "eps", "annual dps / annual eps"),
    }


RATIOS = ("revenue_growth", "net_profit_growth", "eps_growth", "roe", "roa", "debt_to_equity", "net_debt", "free_cash_flow", "ocf_to_net_profit", "bvps_used", "pe", "earnings_yield", "pb", "dividend_yield", "payout")


def with_flows(wide: DataFrame) -> DataFrame:
    """Adds flow_x for each flow metric: the trailing figure (column ttm_x) where the group's basis is ttm, else the annual one. Profit
    for the cash ratio is of the cash basis' period."""
    there = set(wide.columns)

    def flow(m: str, base: str) -> Column:
        annual = C(m) if m in there else F.lit(None).cast("double")
        return F.when(C(base) == "ttm", C(f"ttm_{m}")).otherwise(annual) if f"ttm_{m}" in there else annual

    columns = {f"flow_{m}": flow(m, "income_basis") for m in INCOME_FLOWS} | {f"flow_{m}": flow(m, "cash_basis") for m in CASH_FLOWS}
    return wide.withColumns(columns | {"cash_net_profit": flow("net_profit", "cash_basis")})


def screening_metrics(wide: DataFrame) -> DataFrame:
    """All ratios of a wide row, in one projection."""
    needed = {"bvps", "ordinary_equity_prev", "total_equity_prev", "months"}
    for name in sorted(needed - set(wide.columns)):
        wide = wide.withColumn(name, F.lit(12) if name == "months" else F.lit(None).cast("double"))
    return wide.withColumns({k: v[0] for k, v in _ratios().items()})


def lineage(screened: DataFrame, basis_col: Column, facts: DataFrame | None = None, growth: DataFrame | None = None, ways: DataFrame | None = None) -> DataFrame:
    """(ticker, metric, value, formula, numerator, denominator, period_basis, fact_ids, source_pages, notes): one row for each ratio that is
    defined. ways, the closure of provenance, has all that a ratio is made of, and facts(fact_id, page, extraction_method) where that stands; growth(ticker,
    metric, cagr, note) adds compound growth over three years, its reason where it is withheld."""
    rows = screened.withColumn("_basis", basis_col).unpivot(["ticker", "_basis"], list(RATIOS), "metric", "value").where("value is not null")
    table = _ratios()
    pick = lambda k: F.element_at(F.create_map(*[F.lit(x) for n, v in table.items() for x in (n, v[k])]), C("metric"))
    out = rows.select("ticker", "metric", "value", pick(3).alias("formula"), pick(1).alias("numerator"), pick(2).alias("denominator"), C("_basis").alias("period_basis"), F.lit(None).cast("string").alias("note"))
    if growth is not None:
        ends = screened.select(C("ticker").alias("_t"), basis_col.alias("_b"))
        more = growth.join(ends, growth.ticker == ends["_t"]).where("cagr is not null or note is not null")
        out = out.unionByName(more.select("ticker", F.concat("metric", F.lit("_cagr_3y")).alias("metric"), C("cagr").alias("value"), F.lit("(current / two years before) ^ (1 / 2) - 1").alias("formula"), C("metric").alias("numerator"), C("metric").alias("denominator"), C("_b").alias("period_basis"), "note"))
    if ways is None or facts is None:
        return out.select("*", *[F.lit(None).cast("string").alias(c) for c in ("fact_ids", "source_pages")], C("note").alias("notes")).drop("note")
    known = facts.where("fact_id is not null").groupBy(C("fact_id").alias("_id")).agg(F.min(C("page").cast("string")).alias("_page"), F.min("extraction_method").alias("_how"))
    used = ways.where(C("node").startswith("ratio:")).join(known, C("source") == C("_id"))
    used = used.groupBy(C("node").alias("_node")).agg(F.array_sort(F.collect_set("_id")).alias("_ids"), F.array_sort(F.collect_set("_page")).alias("_pages"), F.max(X.market_share_note(C("_how"))).alias("_market"))  # a handful for each
    out = out.join(used, F.concat_ws(":", F.lit("ratio"), "ticker", "metric") == C("_node"), "left")
    none = F.array().cast("array<string>")
    return out.select(
        *[c for c in out.columns if not c.startswith("_") and c != "note"], F.concat_ws("; ", F.coalesce("_ids", none)).alias("fact_ids"),
        F.concat_ws("; ", F.coalesce("_pages", none)).alias("source_pages"), F.nullif(X.joined(C("note"), C("_market")), F.lit("")).alias("notes"),
    )


def data_confidence(selected: DataFrame, core: list[str], gate: float = 0.8) -> DataFrame:
    """(ticker, data_confidence): low for fewer than half of the core metrics, high for all of them without one under review. A metric
    that has both an extraction and a correction counts once."""
    rows = selected.where(C("metric").isin(*core))
    doubtful = C("confidence") < gate
    if "validation_status" in selected.columns:
        doubtful = doubtful | F.coalesce(C("validation_status") == "review", F.lit(False))
    n, flagged = F.count_distinct(F.when(C("value").isNotNull() & (C("confidence") >= gate), C("metric"))), F.bool_or(doubtful)
    return rows.groupBy("ticker").agg(n.alias("covered"), flagged.alias("flagged")).select("ticker", "covered", F.when(C("covered") < len(core) / 2, "low").when((C("covered") == len(core)) & ~C("flagged"), "high").otherwise("review").alias("data_confidence"))


def stale(as_of: Column, annual_end: Column, confidence: Column, days: int = 548) -> Column:
    """A report older than so many days takes confidence down by one step: high to review, review to low."""
    return F.when(F.datediff(as_of, annual_end) > days, F.when(confidence == "high", "review").otherwise("low")).otherwise(confidence)


def missing_metrics(issuers: DataFrame, metrics: list[str], selected: DataFrame) -> DataFrame:
    """(ticker, metric): what is required and not there. The metrics are a short fixed list, so each issuer is exploded, not joined."""
    wanted = issuers.select("ticker", F.explode(F.array(*map(F.lit, metrics))).alias("metric"))
    return wanted.join(selected.select("ticker", "metric"), ["ticker", "metric"], "left_anti")


def period_lengths(facts: DataFrame) -> DataFrame:
    """(ticker, months): 12 if that is the only length among the annual facts or none is given, else the longest; 0 isn't a length."""
    known = F.nullif("period_months", F.lit(0))
    return facts.groupBy("ticker").agg(F.coalesce(F.max(known), F.lit(12)).alias("months"))


def four_quarters(df: DataFrame, by: list[str], end: str, value: str, months: str) -> DataFrame:
    """The sum of four consecutive three-month periods; null where one is missing."""
    w = W.partitionBy(*by).orderBy(end)
    gap = (F.year(end) - F.year(F.lag(end).over(w))) * 12 + F.month(end) - F.month(F.lag(end).over(w))
    rows = df.withColumn("_ok", ((C(months) == 3) & (F.coalesce(gap, F.lit(3)) == 3)).cast("int"))
    four = W.partitionBy(*by).orderBy(end).rowsBetween(-3, 0)
    three = W.partitionBy(*by).orderBy(end).rowsBetween(-2, 0)
    whole = (F.count("*").over(four) == 4) & (F.min(C(months)).over(four) == 3) & (F.max(C(months)).over(four) == 3) & (F.min("_ok").over(three) == 1)
    return rows.withColumn("ttm", F.when(whole, F.sum(value).over(four))).drop("_ok")


def labels(df: DataFrame, months: str, annual_end: str, trailing_end: str, base: str) -> Column:
    return F.when(C(base) == "ttm", F.concat(F.lit("TTM to "), F.date_format(trailing_end, "yyyy-MM-dd"))).otherwise(P.period_label(C(months), C(annual_end)))


def all_of(*tests: Column) -> Column:
    return reduce(Column.__and__, tests)
