"""Aggregates of the summary, and review rows grouped by rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import render_metric
from .ranking import top
from .selection import exact_medians

C = F.col


def medians(df: DataFrame, metrics: list[str], by: list[str] | None = None) -> DataFrame:
    """(by, metric, median, observations): exact, over all defined values, negative ones too; found by narrowing, so that no group is held in one task."""
    by = by or []
    return exact_medians(df.unpivot([C(b) for b in by], metrics, "metric", "value"), [*by, "metric"], "value")


def confidence_counts(df: DataFrame, column: str = "data_confidence") -> DataFrame:
    return df.agg(*[F.count_if(C(column) == c).alias(c) for c in ("high", "review", "low")])


def basis_counts(df: DataFrame, column: str) -> DataFrame:
    kind = F.when(C(column).startswith("TTM"), "TTM").when(C(column).startswith("FY"), "FY").otherwise("other")
    return df.groupBy(kind.alias("basis")).agg(F.count("*").alias("n"))


def missing_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    return df.select("ticker", F.concat_ws(", ", F.array_compact(F.array(*[F.when(C(f).isNull(), f) for f in fields]))).alias("missing"))


def warning_groups(review: DataFrame, show: int = 3) -> DataFrame:
    """(rule, n, tickers, reasons, more): issuers sorted; the first reasons in order of arrival, and how many more there are. A rule's reasons, which are as
    many as its rows, are never held together; its issuers are, as the line names them. review needs `ord`."""
    base = review.groupBy("rule", "reason", "ticker").agg(F.count("*").alias("k"), F.min("ord").alias("first"))  # one exchange, that all sides reuse
    reasons = base.groupBy("rule", "reason").agg(F.sum("k").alias("k"), F.min("first").alias("first"))
    # of a rule's reasons only the shown ones are brought together; the others are counted
    r = reasons.groupBy("rule").agg(F.sum("k").alias("n"), F.count("*").alias("kinds"))
    few = top(reasons, ["rule"], [C("first").asc(), C("reason").asc()], show)
    few = few.groupBy("rule").agg(F.concat_ws(" | ", F.transform(F.sort_array(F.collect_list(F.struct("first", "reason"))), lambda x: x["reason"])).alias("reasons"))
    t = base.select("rule", "ticker").distinct().groupBy("rule").agg(F.concat_ws(", ", F.array_sort(F.collect_list("ticker"))).alias("tickers"))
    return r.join(t, "rule").join(few, "rule").select("rule", "n", "tickers", "reasons", F.greatest(C("kinds") - show, F.lit(0)).cast("int").alias("more"))


def distinct_joined(column: str) -> Column:
    """An aggregate: the distinct values, sorted and joined."""
    return F.concat_ws("; ", F.array_sort(F.collect_set(column)))


def component_sum(rows: DataFrame, by: list[str], label: str, values: dict[str, str], basis: str, ord_col: str) -> DataFrame:
    """The sum of component rows, the worst of their bases and their labels in order; a nil component counts as zero only beside a sibling
    with a value, and no component at all gives null."""
    some = F.coalesce(*[C(v) for v in values.values()])
    rows = rows.where(some.isNotNull())
    sums = [F.sum(F.coalesce(C(v), F.lit(0))).alias(k) for k, v in values.items()]
    return rows.groupBy(*by).agg(*sums, F.max(basis).alias("worst_basis"), F.concat_ws(" + ", F.transform(F.sort_array(F.collect_list(F.struct(ord_col, label))), lambda x: x[label])).alias("components"))


def all_components(rows: DataFrame, by: list[str], label: str, value: str, wanted: tuple[str, ...], ord_col: str) -> DataFrame:
    """The sum of the first row of each wanted label (cash: deposits and cash at bank), only where every label is there."""
    first = top(rows.where(C(label).isin(*wanted) & C(value).isNotNull()), [*by, label], [C(ord_col).asc()])
    return first.groupBy(*by).agg(F.sum(value).alias(value), F.count("*").alias("_n")).where(C("_n") == len(wanted)).drop("_n")


def review_rows(origins: dict[str, DataFrame]) -> DataFrame:
    """All review rows in one table: of the parser, the validation, the basis of a period, missing metrics and documents' errors. Rows without
    a rule of their own have their origin's name; columns that an origin lacks are null."""
    parts = [df if "rule" in df.columns else df.withColumn("rule", F.lit(name)) for name, df in origins.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


#: What the summary shows of each.
MEDIANS = ("roe", "dividend_yield", "pe", "debt_to_equity", "revenue_growth")
EXTREMES = ("flow_revenue", "flow_net_profit", "eps", "roe", "operating_cash_flow", "free_cash_flow", "dps", "average_volume")
COMPLETE = ("price", "market_cap", "flow_revenue", "flow_net_profit", "eps", "roe", "roa", "debt_to_equity", "operating_cash_flow", "free_cash_flow", "pe", "pb", "dps", "dividend_yield")
PERCENT = ("roe", "roa", "dividend_yield", "revenue_growth", "payout")
NAMES = {"flow_revenue": "Revenue", "flow_net_profit": "Net Profit", "eps": "EPS", "roe": "ROE", "roa": "ROA", "pe": "P/E", "pb": "P/B", "dps": "DPS", "operating_cash_flow": "Operating Cash Flow", "free_cash_flow": "Free Cash Flow", "debt_to_equity": "Debt-to-Equity", "dividend_yield": "Dividend Yield", "revenue_growth": "Revenue Growth", "average_volume": "Average Daily Volume", "price": "Current Price", "market_cap": "Market Cap"}
CLOSING = "Values above are descriptive observations only. This report contains no ranking, score, selection, or investment recommendation."


def summary_lines(title: str, screening: DataFrame, review: DataFrame) -> DataFrame:
    """(section, key, line): the summary's text in order of section and key. Its lists grow with the issuers, so it stays a table until it
    is written; screening needs ticker, data_confidence, income_period and flags, review ticker, rule, reason and ord."""
    spark = screening.sparkSession
    has = lambda names: [m for m in names if m in screening.columns]
    name = lambda c: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv]), c), c)
    shown = lambda c, v: F.when(c.isin(*PERCENT), render_metric(v, "percent")).otherwise(render_metric(v, "ratio"))
    lines = lambda df, section, key, line: df.select(F.lit(section).alias("section"), key.cast("string").alias("key"), line.alias("line"))
    text = [(1, "0", f"# {title}"), (2, "", "## Period basis"), (3, "", "## Sector medians"), (4, "", "## Highest and lowest observed values"), (5, "", "## Missing data"), (6, "", "## Anomaly flag counts"), (7, "", "## Extraction warnings"), (9, "", CLOSING)]
    counts = confidence_counts(screening).crossJoin(screening.agg(F.count("*").alias("n")))  # two single rows
    said = F.concat(F.lit("Companies processed: "), C("n"), F.lit("; high data confidence: "), C("high"), F.lit("; review: "), C("review"), F.lit("; low: "), C("low"), F.lit("."))
    long = screening.select("ticker", *[C(m).cast("double").alias(m) for m in has(dict.fromkeys((*MEDIANS, *EXTREMES)))])
    order = lambda names: F.array_position(F.array(*map(F.lit, names)), C("metric")).cast("string")
    med = medians(long, has(MEDIANS))
    values = long.unpivot(["ticker"], has(EXTREMES), "metric", "value").where("value is not null")
    # the first ticker of ties, at both ends
    upper, lower = (top(values, ["metric"], [o, C("ticker").asc()]).select("metric", C("ticker").alias(t), C("value").alias(v)) for o, t, v in ((C("value").desc(), "hi", "hv"), (C("value").asc(), "lo", "lv")))
    known = spark.createDataFrame([(m,) for m in has(EXTREMES)], "metric string")
    ends = known.join(upper, "metric", "left").join(lower, "metric", "left")
    absent = F.concat_ws(", ", F.array_compact(F.array(*[F.when(C(m).isNull(), F.lit(NAMES.get(m, m))) for m in has(COMPLETE)])))
    flags = screening.select(F.explode(F.split("flags", "; ")).alias("flag")).where("flag <> ''").groupBy("flag").agg(F.count("*").alias("n"))
    warned = warning_groups(review).withColumn("head", F.concat(F.lit("- `"), C("rule"), F.lit("`: "), C("n"), F.lit(" items ("), C("tickers"), F.lit("): "), C("reasons"), F.when(C("more") > 0, F.concat(F.lit("; and "), C("more"), F.lit(" more distinct reasons"))).otherwise("")))
    parts = [
        spark.createDataFrame(text, "section int, key string, line string"), lines(counts, 1, F.lit("1"), said),
        lines(basis_counts(screening, "income_period"), 2, C("basis"), F.concat(F.lit("- "), C("basis"), F.lit(": "), C("n"), F.lit(" companies"))),
        lines(med, 3, order(has(MEDIANS)), F.concat(F.lit("- Sector median "), name(C("metric")), F.lit(": "), shown(C("metric"), C("median")), F.lit(" ("), C("observations"), F.lit(" companies)"))),
        lines(ends, 4, order(has(EXTREMES)), F.when(C("hi").isNull(), F.concat(F.lit("- "), name(C("metric")), F.lit(": NA"))).otherwise(F.concat(F.lit("- "), name(C("metric")), F.lit(": highest "), C("hi"), F.lit(" ("), shown(C("metric"), C("hv")), F.lit("); lowest "), C("lo"), F.lit(" ("), shown(C("metric"), C("lv")), F.lit(")")))),
        lines(screening.withColumn("_absent", absent).where("_absent <> ''"), 5, C("ticker"), F.concat(F.lit("- "), C("ticker"), F.lit(": "), C("_absent"))),
        lines(flags, 6, C("flag"), F.concat(F.lit("- "), C("flag"), F.lit(": "), C("n"))),
        lines(warned, 7, C("rule"), C("head")),
    ]
    return reduce(DataFrame.unionByName, parts)


def markdown(title: str, sections: dict[str, list[dict]]) -> str:
    """A plain summary from small aggregates that are on the driver already."""
    out = [f"# {title}", ""]
    for name, rows in sections.items():
        out.append(f"## {name}")
        out += [f"- {', '.join(f'{k}: {v}' for k, v in row.items())}" for row in rows] or ["- none"]
        out.append("")
    return "\n".join(out)
