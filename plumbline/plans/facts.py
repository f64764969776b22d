"""Financial facts over the star schema: an issuer is a supplier, its industry group a nation, its sector a region, a fiscal year
the year of order. Everything follows from one aggregation of lineitem by supplier, year and half, small from there on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

C = F.col
LAST_FY = 2000
FACTS = ("revenue", "net_profit", "net_profit_attributable", "operating_cash_flow", "capital_expenditure", "ordinary_shares_outstanding", "eps", "dps", "total_equity", "ordinary_equity", "total_assets", "total_liabilities", "total_debt", "cash")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def period_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(issuer, fy, h1, month sums): exact decimal sums, so their order doesn't matter. The one pass over lineitem: what is made of the sums,
    in several branches, reads the checkpoint, which has a row for each issuer and half-year."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("fy"), (F.month("o_orderdate") <= 6).alias("h1"))
    e, d, x, n = C("l_extendedprice").cast("decimal(18,2)"), C("l_discount").cast("decimal(4,2)"), C("l_tax").cast("decimal(4,2)"), C("l_quantity").cast("decimal(18,2)")
    lit = lambda v: F.lit(v).cast("decimal(4,2)")
    rows = li.join(o, li.l_orderkey == o.o_orderkey)
    return materialize(rows.groupBy(C("l_suppkey").alias("issuer"), "fy", "h1").agg(F.sum(e * (lit(1) - d)).alias("rev"), F.sum(e * (lit("0.05") - d)).alias("np"), F.sum(e * (lit("0.04") - x)).alias("ocf"), F.sum(n).alias("qty"), F.sum(e).alias("ext")))


def _flows(sums: DataFrame, by: list[str]) -> DataFrame:
    dbl = lambda c: F.sum(c).cast("double")
    return sums.groupBy(*by).agg(dbl("rev").alias("revenue"), dbl("np").alias("net_profit"), dbl("ocf").alias("operating_cash_flow"), (dbl("qty") * -10).alias("capital_expenditure"))


def annual(spark: SparkSession, sf_dir: str, sums: DataFrame | None = None) -> DataFrame:
    """One wide row per issuer and fiscal year."""
    sums = period_sums(spark, sf_dir) if sums is None else sums
    total = sums.groupBy(C("issuer").alias("i2")).agg(F.sum("qty").cast("double").alias("ordinary_shares_outstanding"), F.sum("ext").cast("double").alias("ext"))
    w = _flows(sums.where(C("fy") <= LAST_FY), ["issuer", "fy"]).join(total, C("issuer") == C("i2"))
    w = w.join(table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("i3"), "s_acctbal", C("s_nationkey").alias("nation")), C("issuer") == C("i3"))
    equity = C("s_acctbal") * 1000 + C("fy") * 100
    w = w.withColumns({
        "net_profit_attributable": F.when(C("issuer") % 2 == 0, C("net_profit") * 0.9), "eps": C("net_profit") / C("ordinary_shares_outstanding"), "dps": C("revenue") * 0.002 / C("ordinary_shares_outstanding"),
        "total_equity": equity, "ordinary_equity": F.when(C("issuer") % 5 != 0, equity * 0.8), "total_assets": equity + C("revenue") * 0.4,
        "total_debt": C("revenue") * 0.3, "cash": F.when(C("issuer") % 11 != 0, C("revenue") * 0.05), "price": C("ext") / C("ordinary_shares_outstanding") / 1000,
        "confidence": F.when((C("issuer") + C("fy")) % 13 == 0, 0.62).otherwise(0.9), "period_end": F.make_date(C("fy").cast("int"), F.lit(12), F.lit(31)), "months": F.lit(12),
    })
    w = w.withColumn("total_liabilities", (C("total_assets") - C("total_equity")) * F.when(C("issuer") % 7 == 0, 1.5).otherwise(1.0))
    return w.withColumn("ticker", C("issuer").cast("string")).drop("i2", "i3", "ext")


def with_previous(wide: DataFrame, metrics=FACTS) -> DataFrame:
    """Adds x_prev: the value of the year before, null where that year is missing."""
    w = W.partitionBy("issuer").orderBy("fy")
    there = F.lag("fy").over(w) == C("fy") - 1
    return wide.withColumns({f"{m}_prev": F.when(there, F.lag(m).over(w)) for m in metrics})


def long_facts(wide: DataFrame, metrics=FACTS) -> DataFrame:
    from ..operators.screening import unpivot

    return unpivot(wide, ["issuer", "ticker", "fy", "period_end", "confidence"], list(metrics))


def interim(spark: SparkSession, sf_dir: str, sums: DataFrame | None = None) -> DataFrame:
    """First halves of LAST_FY + 1, with those of the year before as comparative: long rows."""
    from ..operators.screening import unpivot

    sums = period_sums(spark, sf_dir) if sums is None else sums
    total = sums.groupBy(C("issuer").alias("i2")).agg(F.sum("qty").cast("double").alias("shares"))
    h = _flows(sums.where(C("h1") & C("fy").isin(LAST_FY, LAST_FY + 1)), ["issuer", "fy"]).join(total, C("issuer") == C("i2")).withColumn("eps", C("net_profit") / C("shares"))
    rows = unpivot(h, ["issuer", "fy"], ["revenue", "net_profit", "operating_cash_flow", "capital_expenditure", "eps"])
    both = rows.groupBy("issuer", "metric").agg(F.max(F.when(C("fy") == LAST_FY + 1, C("value"))).alias("value"), F.max(F.when(C("fy") == LAST_FY, C("value"))).alias("previous_value"))
    return both.where("value is not null").select(C("issuer").cast("string").alias("ticker"), "metric", "value", "previous_value", F.lit(0.9).alias("confidence"), F.lit(6).alias("months"), F.lit("2001-06-30").cast("date").alias("period_end"), F.lit("2000-06-30").cast("date").alias("prior_end"))


#: The same in SQL, on which the oracles build.
BASE = """ps AS (
  SELECT l_suppkey AS issuer, year(o_orderdate) AS fy, month(o_orderdate) <= 6 AS h1,
         sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))) AS rev,
         sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(0.05 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))) AS np,
         sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST(0.04 AS DECIMAL(4,2)) - CAST(l_tax AS DECIMAL(4,2)))) AS ocf,
         sum(CAST(l_quantity AS DECIMAL(18,2))) AS qty, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS ext
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
tot AS (SELECT issuer, CAST(sum(qty) AS DOUBLE) AS shares, CAST(sum(ext) AS DOUBLE) AS ext FROM ps GROUP BY issuer),
fl AS (SELECT issuer, fy, CAST(sum(rev) AS DOUBLE) AS revenue, CAST(sum(np) AS DOUBLE) AS net_profit, CAST(sum(ocf) AS DOUBLE) AS operating_cash_flow, CAST(sum(qty) AS DOUBLE) * -10 AS capital_expenditure FROM ps WHERE fy <= 2000 GROUP BY ALL),
w0 AS (
  SELECT fl.*, shares AS ordinary_shares_outstanding, s_nationkey AS nation, s_acctbal,
         CASE WHEN issuer % 2 = 0 THEN net_profit * 0.9::DOUBLE END AS net_profit_attributable, net_profit / shares AS eps, revenue * 0.002::DOUBLE / shares AS dps,
         s_acctbal * 1000 + fy * 100 AS total_equity, CASE WHEN issuer % 5 <> 0 THEN (s_acctbal * 1000 + fy * 100) * 0.8::DOUBLE END AS ordinary_equity,
         s_acctbal * 1000 + fy * 100 + revenue * 0.4::DOUBLE AS total_assets, revenue * 0.3::DOUBLE AS total_debt, CASE WHEN issuer % 11 <> 0 THEN revenue * 0.05::DOUBLE END AS cash,
         ext / shares / 1000 AS price, CASE WHEN (issuer + fy) % 13 = 0 THEN 0.62::DOUBLE ELSE 0.9::DOUBLE END AS confidence, make_date(CAST(fy AS INT), 12, 31) AS period_end
  FROM fl JOIN tot USING (issuer) JOIN supplier ON s_suppkey = issuer),
w AS (SELECT *, CAST(issuer AS VARCHAR) AS ticker, (total_assets - total_equity) * (CASE WHEN issuer % 7 = 0 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END) AS total_liabilities FROM w0)"""
PREV = ", ".join(f"CASE WHEN lag(fy) OVER z = fy - 1 THEN lag({m}) OVER z END AS {m}_prev" for m in FACTS)
BASE_PREV = f"{BASE},\np AS (SELECT *, {PREV} FROM w WINDOW z AS (PARTITION BY issuer ORDER BY fy))"
INTERIM = """hf AS (SELECT issuer, fy, CAST(sum(rev) AS DOUBLE) AS revenue, CAST(sum(np) AS DOUBLE) AS net_profit, CAST(sum(ocf) AS DOUBLE) AS operating_cash_flow, CAST(sum(qty) AS DOUBLE) * -10 AS capital_expenditure FROM ps WHERE h1 AND fy IN (2000, 2001) GROUP BY ALL),
he AS (SELECT hf.*, net_profit / shares AS eps FROM hf JOIN tot USING (issuer)),
hl AS (UNPIVOT he ON revenue, net_profit, operating_cash_flow, capital_expenditure, eps INTO NAME metric VALUE value),
it AS (SELECT CAST(issuer AS VARCHAR) AS ticker, metric, max(value) FILTER (fy = 2001) AS value, max(value) FILTER (fy = 2000) AS previous_value FROM hl GROUP BY ALL HAVING max(value) FILTER (fy = 2001) IS NOT NULL),
al AS (SELECT * FROM (UNPIVOT (SELECT ticker, confidence, revenue, net_profit, operating_cash_flow, capital_expenditure, eps FROM w WHERE fy = 2000) ON revenue, net_profit, operating_cash_flow, capital_expenditure, eps INTO NAME metric VALUE value)),
tr0 AS (SELECT al.ticker, metric, al.value AS annual, it.value AS ytd, it.previous_value AS prior, al.value + it.value - it.previous_value AS ttm, least(al.confidence, 0.9::DOUBLE) AS confidence,
  metric = 'revenue' AND NOT coalesce(abs(it.value / nullif(al.value, 0)) BETWEEN 0.5 / 4 AND 0.5 * 4, false) AS implausible FROM al JOIN it USING (ticker, metric)),
tr AS (SELECT * FROM (SELECT *, bool_or(implausible) OVER (PARTITION BY ticker) AS bad FROM tr0) WHERE ttm IS NOT NULL AND NOT (bad AND metric IN ('revenue', 'net_profit', 'eps')))"""
