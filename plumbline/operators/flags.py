"""Descriptive flags. They state what was found and neither rank nor recommend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .selection import exact_medians

C = F.col
#: Thresholds that settings may replace.
DEFAULTS = {"high_debt_to_equity": 2.0, "ocf_to_net_profit_low": 0.7, "liquidity_minimum_observations": 5, "low_liquidity_average_daily_volume": 10000.0, "relative_high": 2.0, "relative_low": 0.5}


def company_flags(df: DataFrame, **thresholds) -> Column:
    """The flags of one row, in their order, joined; columns that df lacks can't raise theirs."""
    t = DEFAULTS | thresholds
    has = lambda *names: all(n in df.columns for n in names)
    least = t["liquidity_minimum_observations"]
    flags = []

    def add(test: Column, text, *needs: str) -> None:
        if has(*needs):
            flags.append(F.when(test, text))

    add(C("eps") < 0, "negative EPS", "eps")
    add(C("eps_declined"), "declining EPS for 2+ consecutive years", "eps_declined")
    add(C("revenue_declined"), "declining revenue for 2+ consecutive years", "revenue_declined")
    add(C("operating_cash_flow") < 0, "negative operating cash flow", "operating_cash_flow")
    add(C("debt_to_equity") > t["high_debt_to_equity"], "high debt-to-equity", "debt_to_equity")
    add((C("net_profit") > 0) & (C("ocf_to_net_profit") < t["ocf_to_net_profit_low"]), "operating cash flow materially below net profit", "net_profit", "ocf_to_net_profit")
    add(C("total_equity") < 0, "negative equity", "total_equity")
    add(C("payout") > 1, "dividend payout above 100%", "payout")
    if has("average_volume", "liquidity_days"):
        days = F.coalesce("liquidity_days", F.lit(0))
        none = C("average_volume").isNull() | (days < least)
        flags.append(F.when(none, F.concat(F.lit("multi-day liquidity unavailable ("), days.cast("string"), F.lit(f"/{least} observations)"))).when(C("average_volume") <= t["low_liquidity_average_daily_volume"], "low trading liquidity (average daily volume)"))
    add(C("one_off"), "possible one-off profit or loss", "one_off")
    if has("months"):
        flags.append(F.when(C("months") != 12, F.concat(F.lit("financial period of "), C("months").cast("string"), F.lit(" months (year-end changed)"))))
    return F.concat_ws("; ", F.array_compact(F.array(*flags)))


def relative_flags(df: DataFrame, group: list[str], **thresholds) -> DataFrame:
    """df with relative_flags: P/E and P/B against the exact medians of the group's positive values. The medians are found by narrowing and
    joined back, so a large group is never held in one task."""
    t = DEFAULTS | thresholds
    positive = df.unpivot([C(g) for g in group], ["pe", "pb"], "_metric", "_value").where("_value > 0")
    found = exact_medians(positive, [*group, "_metric"], "_value")
    m = found.groupBy(*group).agg(*[F.max(F.when(C("_metric") == x, C("median"))).alias(f"_{x}") for x in ("pe", "pb")])
    out = df.join(m, group, "left") if group else df.crossJoin(F.broadcast(m))  # a single row when there is no group
    high, low = t["relative_high"], t["relative_low"]
    flags = F.array(
        F.when((C("pe") > 0) & (C("pe") > high * C("_pe")), "P/E unusually high relative to sector median"),
        F.when((C("pb") > 0) & (C("pb") > high * C("_pb")), "P/B unusually high relative to sector median"),
        F.when((C("pb") > 0) & (C("pb") < low * C("_pb")), "P/B unusually low relative to sector median"),
    )
    return out.withColumn("relative_flags", F.concat_ws("; ", F.array_compact(flags))).drop("_pe", "_pb")


def flag_counts(df: DataFrame, column: str = "flags") -> DataFrame:
    return df.select(F.explode(F.split(column, "; ")).alias("flag")).where("flag <> ''").groupBy("flag").agg(F.count("*").alias("n"))


def flag_records(df: DataFrame, column: str = "flags") -> DataFrame:
    """(ticker, flag, evidence): one row for each flag, with the figures that raised it where the row has them."""
    rows = df.withColumn("flag", F.explode(F.split(column, "; "))).where("flag <> ''")
    shows = {"negative EPS": "eps", "negative operating cash flow": "operating_cash_flow", "high debt-to-equity": "debt_to_equity", "negative equity": "total_equity", "dividend payout above 100%": "payout"}
    evidence = F.coalesce(*[F.when(C("flag") == f, F.concat(F.lit(f"{c} = "), C(c).cast("string"))) for f, c in shows.items() if c in df.columns], C("flag"))
    return rows.select("ticker", "flag", evidence.alias("evidence"))
