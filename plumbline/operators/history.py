"""History rows, their de-duplication, chained growth and declines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.periods import prior_year_end
from ..functions.ratios import cagr
from ..schemas import GATE, HISTORY_METRICS
from .ranking import top, usable

C = F.col
#: How far a comparative may differ from what was reported before.
TOLERANCE = {"eps": 0.02, "revenue": 0.10}


def history_rows(facts: DataFrame, metrics: tuple[str, ...] = HISTORY_METRICS, gate: str = GATE) -> DataFrame:
    """facts(ticker, metric, period_end, value, previous_value, confidence, period_months, ord) -> the observation of the year and,
    if it is at least a hundredth of it in size, that of the comparative year."""
    rows = facts.where(C("metric").isin(*metrics) & usable(gate) & C("value").isNotNull() & F.coalesce(C("period_months") == 12, F.lit(True)))
    prev = F.when(F.abs("previous_value") >= F.abs("value") * 0.01, C("previous_value"))
    pair = F.array(
        F.struct(C("period_end").alias("financial_year_end"), C("value").alias("value"), F.lit("current").alias("value_basis")),
        F.struct(prior_year_end(C("period_end")).alias("financial_year_end"), prev.alias("value"), F.lit("comparative").alias("value_basis")),
    )
    rows = rows.select("ticker", "metric", C("period_end").alias("source_period_end"), "confidence", "ord", *([C("correction_id")] if "correction_id" in facts.columns else []), F.explode(pair).alias("o"))
    return rows.select("ticker", "metric", "source_period_end", "confidence", "ord", *([C("correction_id")] if "correction_id" in facts.columns else []), "o.*").where("value is not null")


def deduplicate(history: DataFrame) -> DataFrame:
    """One observation per issuer, metric and year: corrected, then current, then the later source, then confidence, then the first;
    sorted from the latest."""
    corrected = C("correction_id").isNotNull() if "correction_id" in history.columns else F.lit(False)
    one = top(history, ["ticker", "metric", "financial_year_end"], [corrected.desc(), (C("value_basis") == "current").desc(), C("source_period_end").desc(), C("confidence").desc(), C("ord").asc()])
    return one.orderBy(C("ticker").desc(), C("metric").desc(), C("financial_year_end").desc())


def _first(history: DataFrame, name: str, source_shift: int, year_shift: int, ends: DataFrame) -> DataFrame:
    """The first observation, in order of arrival, of year end - year_shift in the report of end - source_shift."""
    h = history.select("ticker", "metric", C("source_period_end").alias("_s"), C("financial_year_end").alias("_y"), C("value").alias(name), "ord")
    j = ends.join(h, ["ticker", "metric"]).where((C("_s") == prior_year_end(C("end"), source_shift)) & (C("_y") == prior_year_end(C("end"), year_shift)))
    return top(j, ["ticker", "metric"], [C("ord").asc()]).select("ticker", "metric", name)


def chained_cagr(history: DataFrame, ends: DataFrame, years: int = 2) -> DataFrame:
    """history and ends(ticker, metric, end, found, previous, months) -> (ticker, metric, cagr, note): growth over years FY-2 to FY0. found says whether the latest
    report has a selected fact, previous is its comparative, which may be one that the history leaves out. The value of the middle year has to be in
    its own report and to agree with that comparative; the start is the comparative of the middle year's report. A note says why there's no result."""
    now, before, start = _first(history, "v0", 0, 0, ends), _first(history, "v1", 1, 1, ends), _first(history, "p2", 1, 2, ends)
    r = ends
    for x in (now, before, start):
        r = r.join(x, ["ticker", "metric"], "left")
    limit = F.when(C("metric") == "eps", TOLERANCE["eps"]).otherwise(TOLERANCE["revenue"])
    grown = cagr(C("v0"), C("p2"), years)
    figure = lambda c: F.format_number(c, 2)
    withheld = (
        F.when(C("months") != 12, "the latest period isn't of twelve months").when(~F.coalesce("found", F.lit(False)), "no value in the latest annual report")
        .when(C("v0").isNull() | C("v1").isNull() | C("p2").isNull(), "chain of years is incomplete").when(C("previous").isNull() | (C("v1") == 0), "no comparative to check the basis by")
        .when(F.abs(C("previous") - C("v1")) > F.abs("v1") * limit, F.concat(F.lit("restated from "), figure("v1"), F.lit(" to "), figure("previous")))
    )
    r = r.withColumn("_withheld", withheld)
    value = F.when(C("_withheld").isNull(), grown)
    return r.select("ticker", "metric", value.alias("cagr"), F.coalesce("_withheld", F.when(value.isNull(), "undefined: the start isn't positive or the end is negative")).alias("note"))


def consecutive_decline(history: DataFrame) -> DataFrame:
    """(ticker, metric, declined): whether each of the two latest reports shows less than its own comparative, the reports being one year
    apart to the day; within a report the last observation of a year counts."""
    last = top(history, ["ticker", "metric", "source_period_end", "financial_year_end"], [C("ord").desc()])
    is_now = C("financial_year_end") == C("source_period_end")
    is_then = C("financial_year_end") == prior_year_end(C("source_period_end"))
    reports = last.groupBy("ticker", "metric", "source_period_end").agg(F.max(F.when(is_now, C("value"))).alias("now"), F.max(F.when(is_then, C("value"))).alias("then"))
    two = top(reports, ["ticker", "metric"], [C("source_period_end").desc()], 2)
    pair = two.groupBy("ticker", "metric").agg(F.count("*").alias("n"), F.max("source_period_end").alias("a"), F.min("source_period_end").alias("b"), F.bool_and(F.coalesce(C("now") < C("then"), F.lit(False))).alias("fell"))
    adjacent = (C("n") == 2) & (F.year("a") - F.year("b") == 1) & (F.month("a") == F.month("b")) & (F.dayofmonth("a") == F.dayofmonth("b"))
    return pair.select("ticker", "metric", (adjacent & C("fell")).alias("declined"))


def three_year_decline(values: DataFrame) -> DataFrame:
    """The same from one value per year, values(ticker, metric, financial_year_end, value), over three strictly consecutive years."""
    three = top(values, ["ticker", "metric"], [C("financial_year_end").desc()], 3)
    g = three.groupBy("ticker", "metric").agg(F.sort_array(F.collect_list(F.struct("financial_year_end", "value")), asc=False).alias("o"))
    d = lambda i: F.get("o", F.lit(i))["financial_year_end"]
    v = lambda i: F.get("o", F.lit(i))["value"]
    steps = [(F.year(d(i)) - F.year(d(i + 1)) == 1) & (F.month(d(i)) == F.month(d(i + 1))) & (F.dayofmonth(d(i)) == F.dayofmonth(d(i + 1))) & (v(i) < v(i + 1)) for i in (0, 1)]
    return g.select("ticker", "metric", F.coalesce((F.size("o") == 3) & steps[0] & steps[1], F.lit(False)).alias("declined"))
