"""What a figure is made of, as a graph: flag -> ratio -> trailing figure or derived fact -> printed fact.

Edges (parent, child, role) say that child is an input of parent, in what role; they are made by joins of the tables that the screening run has.
`closure` follows them by iterated joins, each of which moves every open path by one step, and ends at sources, nodes that
aren't made of anything. An issuer's graph has some hundred edges and paths of a few steps, so the rounds are few and no group is large."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

C = F.col
EDGE = ("parent", "child", "role")
MAX_DEPTH = 16

_GROWTH = lambda m: (("current", "annual", (m,)), ("previous", "annual", (m,)))
_EQUITY = ("ordinary_equity", "total_equity")
_BOOK = (("book value", "annual", ("bvps",)), ("equity", "unprinted", ("ordinary_equity",)), ("shares", "unprinted", ("ordinary_shares_outstanding",)))
#: The inputs of each ratio: (role, kind, metrics of which the first that is there counts). Kinds: annual is the annual report's fact, whose comparative
#: is part of it; income and cash are the trailing figure where that is the basis, else the annual fact; market is the price; unprinted is an annual
#: fact that counts only where no book value per share is printed.
RATIO_INPUTS = {
    "revenue_growth": _GROWTH("revenue"), "net_profit_growth": _GROWTH("net_profit"), "eps_growth": _GROWTH("eps"),
    "roe": (("profit", "annual", ("net_profit_attributable", "net_profit")), ("closing equity", "annual", _EQUITY), ("opening equity", "annual", _EQUITY)),
    "roa": (("profit", "annual", ("net_profit",)), ("closing assets", "annual", ("total_assets",)), ("opening assets", "annual", ("total_assets",))),
    "debt_to_equity": (("debt", "annual", ("total_debt",)), ("equity", "annual", _EQUITY)), "net_debt": (("debt", "annual", ("total_debt",)), ("cash", "annual", ("cash",))),
    "free_cash_flow": (("operating cash flow", "cash", ("operating_cash_flow",)), ("capital expenditure", "cash", ("capital_expenditure",))),
    "ocf_to_net_profit": (("operating cash flow", "cash", ("operating_cash_flow",)), ("profit", "cash", ("net_profit",))),
    "bvps_used": _BOOK, "pe": (("price", "market", ()), ("eps", "income", ("eps",))), "earnings_yield": (("eps", "income", ("eps",)), ("price", "market", ())),
    "pb": (("price", "market", ()), *_BOOK), "dividend_yield": (("dps", "annual", ("dps",)), ("price", "market", ())), "payout": (("dps", "annual", ("dps",)), ("eps", "annual", ("eps",))),
}
#: The inputs of each flag: (role, kind, name), of the kinds above or ratio.
FLAG_INPUTS = {
    "negative EPS": (("eps", "income", "eps"),), "declining EPS for 2+ consecutive years": (("eps", "annual", "eps"),), "declining revenue for 2+ consecutive years": (("revenue", "annual", "revenue"),),
    "negative operating cash flow": (("operating cash flow", "cash", "operating_cash_flow"),), "high debt-to-equity": (("ratio", "ratio", "debt_to_equity"),),
    "operating cash flow materially below net profit": (("ratio", "ratio", "ocf_to_net_profit"),), "negative equity": (("equity", "annual", "total_equity"),), "dividend payout above 100%": (("ratio", "ratio", "payout"),),
    "P/E unusually high relative to sector median": (("ratio", "ratio", "pe"),), "P/B unusually high relative to sector median": (("ratio", "ratio", "pb"),), "P/B unusually low relative to sector median": (("ratio", "ratio", "pb"),),
}
#: Identities by which facts are derived: metric -> the metrics of the document that it follows from.
DERIVED_FROM = {"total_liabilities": ("total_assets", "total_equity"), "ordinary_equity": ("total_equity", "minority_interest"), "total_equity": ("ordinary_equity", "minority_interest")}


def node(kind: str, ticker: Column, name: Column | str) -> Column:
    return F.concat_ws(":", F.lit(kind), ticker, F.lit(name) if isinstance(name, str) else name)


def _facts_of(facts: DataFrame) -> DataFrame:
    """facts(ticker, metric, fact_id), one for each metric -> (_of, _facts): a short map for each issuer."""
    return facts.where("fact_id is not null").groupBy(C("ticker").alias("_of")).agg(F.map_from_entries(F.collect_list(F.struct("metric", "fact_id"))).alias("_facts"))


def _child(kind: Column, metrics: Column) -> Column:
    """The node of an input, of a row with ticker, income_basis, cash_basis and _facts; null where there's none."""
    there = F.filter(metrics, lambda m: F.try_element_at("_facts", m).isNotNull())
    metric = F.get(there, F.lit(0))
    trailing = ((kind == "income") & (C("income_basis") == "ttm")) | ((kind == "cash") & (C("cash_basis") == "ttm"))
    hidden = (kind == "unprinted") & F.try_element_at("_facts", F.lit("bvps")).isNotNull()
    return F.when(kind == "market", node("market", C("ticker"), "price")).when(trailing, node("trailing", C("ticker"), F.get(metrics, F.lit(0)))).when(~F.coalesce(hidden, F.lit(False)), F.try_element_at("_facts", metric))


def _with_inputs(rows: DataFrame, key: str, table: dict, facts: DataFrame) -> DataFrame:
    """rows(ticker, key, income_basis, cash_basis) joined with the inputs that a fixed table has for the key, and with the issuer's facts."""
    spark = rows.sparkSession
    flat = [(k, role, kind, [m] if isinstance(m, str) else list(m)) for k, inputs in table.items() for role, kind, m in inputs]
    fixed = F.broadcast(spark.createDataFrame(flat, "_key string, role string, kind string, metrics array<string>"))  # a few dozen rows
    out = rows.join(fixed, C(key) == C("_key"))
    return out.join(_facts_of(facts), C("ticker") == C("_of"), "left")


def ratio_edges(screened: DataFrame, facts: DataFrame) -> DataFrame:
    """Inputs of each ratio that is defined in screened(ticker, income_basis, cash_basis, ratios..); facts are the selected ones of the annual report."""
    ratios = [r for r in RATIO_INPUTS if r in screened.columns]
    rows = screened.unpivot(["ticker", "income_basis", "cash_basis"], ratios, "ratio", "value").where("value is not null")
    out = _with_inputs(rows, "ratio", RATIO_INPUTS, facts).withColumn("child", _child(C("kind"), C("metrics")))
    return out.where("child is not null").select(node("ratio", C("ticker"), C("ratio")).alias("parent"), "child", "role")


def flag_edges(flags: DataFrame, screened: DataFrame, facts: DataFrame) -> DataFrame:
    """Inputs of each of flags(ticker, flag); flags that say that something is missing have none."""
    rows = flags.join(screened.select(C("ticker").alias("_t"), "income_basis", "cash_basis"), C("ticker") == C("_t"))
    out = _with_inputs(rows, "flag", FLAG_INPUTS, facts)
    child = F.when(C("kind") == "ratio", node("ratio", C("ticker"), F.get("metrics", F.lit(0)))).otherwise(_child(C("kind"), C("metrics")))
    return out.withColumn("child", child).where("child is not null").select(node("flag", C("ticker"), C("flag")).alias("parent"), "child", "role")


def trailing_edges(trailing: DataFrame, annual: DataFrame, interim: DataFrame) -> DataFrame:
    """A trailing figure of trailing(ticker, metric) is made of the year's fact and, twice, of the interim fact: its amount and its comparative."""
    parts = []
    for facts, roles in ((annual, ("year",)), (interim, ("year to date", "year to date before"))):
        f = facts.where("fact_id is not null").select(C("ticker").alias("_t"), C("metric").alias("_m"), C("fact_id").alias("child"))
        rows = trailing.select("ticker", "metric").join(f, (C("ticker") == C("_t")) & (C("metric") == C("_m")))
        parts.append(rows.select(node("trailing", C("ticker"), C("metric")).alias("parent"), "child", F.explode(F.array(*map(F.lit, roles))).alias("role")))
    return parts[0].unionByName(parts[1])


def derived_edges(facts: DataFrame, selected: DataFrame) -> DataFrame:
    """facts(doc_id, metric, fact_id, extraction_method); selected has the fact of each document and metric that identities read."""
    flat = [(m, x) for m, inputs in DERIVED_FROM.items() for x in inputs]
    fixed = F.broadcast(facts.sparkSession.createDataFrame(flat, "_metric string, input string"))
    made = facts.where("extraction_method = 'derived'").join(fixed, C("metric") == C("_metric")).select("doc_id", C("fact_id").alias("parent"), "input")
    given = selected.where("extraction_method <> 'derived' or extraction_method is null").select(C("doc_id").alias("_doc"), C("metric").alias("_m"), C("fact_id").alias("child"))
    return made.join(given, (C("doc_id") == C("_doc")) & (C("input") == C("_m"))).select("parent", "child", C("input").alias("role"))


def growth_edges(compound: DataFrame, annual_facts: DataFrame) -> DataFrame:
    """compound(ticker, metric, end, start_end), annual_facts(ticker, metric, period_end, fact_id): compound growth is made of the latest report's fact and of the
    comparative that the report of the year before prints."""
    f = annual_facts.select(C("ticker").alias("_t"), C("metric").alias("_m"), C("period_end").alias("_e"), C("fact_id").alias("child"))
    rows = compound.select("ticker", "metric", F.explode(F.array(F.struct(C("end").alias("at"), F.lit("end").alias("role")), F.struct(C("start_end").alias("at"), F.lit("start").alias("role")))).alias("x"))
    rows = rows.join(f, (C("ticker") == C("_t")) & (C("metric") == C("_m")) & (C("x.at") == C("_e")))
    return rows.select(node("ratio", C("ticker"), F.concat("metric", F.lit("_cagr_3y"))).alias("parent"), "child", C("x.role").alias("role"))


def closure(edges: DataFrame) -> DataFrame:
    """edges(parent, child, role) -> (node, source, path, depth): each way from a node down to what isn't made of anything, its roles joined. An edge that is
    there twice counts once; a cycle raises."""
    e = materialize(edges.select(*EDGE).where("parent is not null and child is not null").distinct())
    step = e.select(C("parent").alias("_parent"), C("child").alias("_child"), C("role").alias("_role"))
    open_ways = e.select(C("parent").alias("node"), C("child").alias("source"), C("role").alias("path"), F.lit(1).alias("depth"))
    done = []
    for _ in range(MAX_DEPTH):
        further = open_ways.join(step, C("source") == C("_parent"), "left")
        moved = materialize(further.select("node", F.coalesce("_child", "source").alias("source"), F.when(C("_child").isNull(), C("path")).otherwise(F.concat_ws(" / ", "path", "_role")).alias("path"), (C("depth") + C("_child").isNotNull().cast("int")).alias("depth"), C("_child").isNull().alias("ended")))
        done.append(moved.where("ended").drop("ended"))
        open_ways = moved.where("not ended").drop("ended")
        if open_ways.isEmpty():
            break
    else:
        raise ValueError(f"the graph of inputs has a cycle, or a path of over {MAX_DEPTH} steps")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def sources_of(ways: DataFrame, kind: str = "ratio") -> DataFrame:
    """closure()'s rows -> (ticker, name, fact_ids): the facts that each node of the kind is made of in the end, sorted; market data isn't a fact."""
    of = ways.where(C("node").startswith(f"{kind}:") & ~C("source").startswith("market:"))
    parts = F.split("node", ":", 3)
    return of.groupBy(parts[1].alias("ticker"), parts[2].alias("name")).agg(F.array_sort(F.collect_set("source")).alias("fact_ids"))  # a handful for each
