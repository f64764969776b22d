"""Deterministic choice of one row or a few. Every rank ends in the order of arrival, so ties never depend on the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import GATE


def top(df: DataFrame, by: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each group; Spark keeps only n rows of a group before the shuffle (window group limit)."""
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_rank") <= n).drop("_rank")


def usable(gate: str = GATE) -> Column:
    return F.col("confidence").cast("decimal(3,2)") >= F.lit(gate).cast("decimal(3,2)")


def best_facts(facts: DataFrame, by: tuple[str, ...] = ("ticker", "metric"), gate: str = GATE) -> DataFrame:
    """One usable fact per metric: a correction before an extraction, then confidence, then the earlier one."""
    rows = facts.where(F.col("value").isNotNull() & usable(gate))
    return top(rows, list(by), [F.col("correction_id").isNotNull().desc(), F.col("confidence").desc(), F.col("ord").asc()])


def latest_annual(docs: DataFrame) -> DataFrame:
    return top(docs.where("kind = 'annual_report'"), ["ticker"], [F.col("period_end").desc(), F.col("ord").asc()])


def latest_documents(docs: DataFrame) -> DataFrame:
    """One filing per fiscal period: the later publication, amended before original, the earlier one on ties; then the three
    latest annual reports and the newest interim statement of each issuer."""
    amended = F.lower("title").rlike("amended|updated")
    one = top(docs, ["ticker", "kind", "period_end"], [F.coalesce("publication_date", F.lit("0001-01-01").cast("date")).desc(), amended.desc(), F.col("ord").asc()])
    return latest_three_and_interim(one, F.col("publication_date").desc_nulls_last())


def latest_three_and_interim(docs: DataFrame, *order: Column) -> DataFrame:
    annual = top(docs.where("kind = 'annual_report'"), ["ticker"], [F.col("period_end").desc(), F.col("ord").asc()], 3)
    interim = top(docs.where("kind = 'interim_statement'"), ["ticker"], [F.col("period_end").desc(), *order, F.col("ord").asc()])
    return annual.unionByName(interim)


def merge_documents(configured: DataFrame, discovered: DataFrame) -> DataFrame:
    """Of one url the last wins, of one period the later publication (compared as text, null as empty), then one that was
    discovered, then the first; three annual reports and one interim statement stay."""
    both = configured.unionByName(discovered)
    by_url = top(both, ["ticker", "url"], [F.col("ord").desc()])
    one = top(by_url, ["ticker", "kind", "period_end"], [F.coalesce(F.col("publication_date").cast("string"), F.lit("")).desc(), F.col("discovery_url").isNotNull().desc(), F.col("ord").asc()])
    return latest_three_and_interim(one)


def arg_extremes(df: DataFrame, name: str, value: str, ord_col: str, by: list[str]) -> DataFrame:
    """(by, highest, lowest): the name with the largest and the smallest value, the first of ties."""
    v = F.col(value)
    return df.where(v.isNotNull()).groupBy(*by).agg(F.max_by(name, F.struct(v, -F.col(ord_col))).alias("highest"), F.min_by(name, F.struct(v, F.col(ord_col))).alias("lowest"))


def mode_largest(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The most frequent value of each group, the larger one on ties."""
    return top(df.groupBy(*by, value).agg(F.count("*").alias("n")), by, [F.col("n").desc(), F.col(value).desc()])


def take_while(df: DataFrame, by: list[str], order: str, stop: Column, most: int = 30) -> DataFrame:
    """The rows before the first that stops, at most so many."""
    w = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn("_stop", F.max(stop.cast("int")).over(w)).withColumn("_n", F.count("*").over(w)).where((F.col("_stop") == 0) & (F.col("_n") <= most)).drop("_stop", "_n")


def collapse_repeats(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from the one before."""
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("_before", F.lag(value).over(w)).where(~F.col(value).eqNullSafe(F.col("_before"))).drop("_before")


def block_starts(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Rows where a falling sequence starts anew: the first one, and those above the one before."""
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("_before", F.lag(value).over(w)).where(F.col("_before").isNull() | (F.col(value) > F.col("_before"))).drop("_before")


def under_heading(df: DataFrame, by: list[str], order: str, heading: Column, row: Column, within: int = 4) -> DataFrame:
    """Rows at most `within` places below the last heading."""
    w = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    at = df.withColumn("heading_at", F.last(F.when(heading, F.col(order)), ignorenulls=True).over(w))
    return at.where(row & (F.col(order) > F.col("heading_at")) & (F.col(order) - F.col("heading_at") <= within))


def first_by_pattern(lines: DataFrame, by: list[str], patterns: list[tuple[str, str]], order: list[str], text: str = "line") -> DataFrame:
    """(by, pattern, ...): for each group the first line of the first pattern that has any; earlier patterns win."""
    which = F.coalesce(*[F.when(F.col(text).rlike(p), i) for i, (_, p) in enumerate(patterns)])
    hit = lines.withColumn("pattern_no", which).where("pattern_no is not null")
    first = top(hit, by, [F.col("pattern_no").asc(), *[F.col(c).asc() for c in order]])
    return first.withColumn("pattern", F.element_at(F.array(*[F.lit(n) for n, _ in patterns]), F.col("pattern_no") + 1)).drop("pattern_no")
