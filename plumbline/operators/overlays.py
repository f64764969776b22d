"""Universe and correction overlays, and the joins that bring the inputs together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import company_key
from .ranking import top

C = F.col
COMPANY = ("name", "industry_group")


class OverlayError(ValueError):
    """An overlay that names something unknown, or contradicts itself."""


def require_empty(df: DataFrame, message: str) -> None:
    """Raises with a few examples if df has rows; only those are brought to the driver."""
    if rows := df.limit(5).collect():
        raise OverlayError(f"{message}: {', '.join(str(r[0]) for r in rows)}")


def apply_universe(official: DataFrame, include: DataFrame, exclude: DataFrame, override: DataFrame, check: bool = True) -> DataFrame:
    """(ticker, name, industry_group, membership, included): overrides change official members, inclusions add or update those of the same
    group, exclusions win; one audit row for each ticker that is selected or excluded."""
    if check:
        require_empty(override.join(official, "ticker", "left_anti").select("ticker"), "override of unknown ticker")
    o = override.select(C("ticker").alias("_o"), *[C(c).alias(f"o_{c}") for c in COMPANY])
    base = official.join(o, official.ticker == C("_o"), "left").select("ticker", *[F.coalesce(f"o_{c}", c).alias(c) for c in COMPANY], F.lit(True).alias("official"))
    i = include.select(C("ticker").alias("_i"), *[C(c).alias(f"i_{c}") for c in COMPANY])
    both = base.join(i, base.ticker == C("_i"), "full_outer")
    fits = C("_i").isNotNull() & (C("i_industry_group").isNull() | C("industry_group").isNull() | (C("i_industry_group") == C("industry_group")))
    both = both.select(
        F.coalesce("ticker", "_i").alias("ticker"), *[F.when(fits, F.coalesce(f"i_{c}", c)).otherwise(C(c)).alias(c) for c in COMPANY],
        F.when(C("official").isNull(), "configured_include").when(fits, "configured_include+official").otherwise("official").alias("membership"),
    )
    x = exclude.select(C("ticker").alias("_x")).distinct()
    out = both.join(x, both.ticker == C("_x"), "full_outer")
    member = F.when(C("ticker").isNull(), "configured_exclusion_not_present").otherwise(C("membership"))
    return out.select(F.coalesce("ticker", "_x").alias("ticker"), *COMPANY, member.alias("membership"), C("_x").isNull().alias("included"))


def members(audit: DataFrame) -> DataFrame:
    """The universe: what apply_universe includes, sorted by ticker."""
    return audit.where("included").drop("included").orderBy("ticker")


def audit_rows(audit: DataFrame) -> DataFrame:
    """One row for each ticker that is selected or excluded, sorted."""
    return audit.orderBy("ticker")


def check_corrections(corrections: DataFrame) -> None:
    """Raises on missing fields, repeated ids, unknown states, pages below one, or two active corrections of one target."""
    needed = ("id", "status", "ticker", "metric", "financial_period", "source_document", "value", "reason", "author")
    bad = corrections.where(" or ".join(f"{c} is null" for c in needed) + " or status not in ('active', 'superseded') or source_page < 1")
    require_empty(bad.select(F.coalesce("id", F.lit("?"))), "invalid correction")
    require_empty(corrections.groupBy("id").count().where("count > 1").select("id"), "repeated correction id")
    require_empty(corrections.where("status = 'active'").groupBy("ticker", "metric", "financial_period", "source_document").count().where("count > 1").select("ticker"), "more than one active correction of")


def correction_facts(corrections: DataFrame, docs: DataFrame) -> DataFrame:
    """Active corrections as facts of full confidence, on the document of that issuer, period and title."""
    c = corrections.where("status = 'active'").select("id", "ticker", "metric", C("financial_period").alias("period_end"), C("source_document").alias("title"), "value")
    return c.join(docs.select("doc_id", "ticker", "period_end", "title"), ["ticker", "period_end", "title"]).select("ticker", "doc_id", "metric", "value", F.lit(1.0).cast("decimal(3,2)").alias("confidence"), C("id").alias("correction_id"))


def unapplied(corrections: DataFrame, applied: DataFrame) -> DataFrame:
    return corrections.where("status = 'active'").join(applied.select(C("correction_id").alias("id")), "id", "left_anti")


def fan_out(docs: DataFrame, companies: DataFrame) -> DataFrame:
    """A filing of a base symbol for each share class of it."""
    d = docs.withColumn("_base", F.split_part("symbol", F.lit("."), F.lit(1)))
    c = companies.select("ticker", F.split_part("ticker", F.lit("."), F.lit(1)).alias("_base"))
    return d.join(c, "_base").drop("_base")


def share_classes(companies: DataFrame) -> DataFrame:
    """(ticker, share_classes): how many tickers share the base symbol, counted over the full universe."""
    base = companies.select("ticker", F.split_part("ticker", F.lit("."), F.lit(1)).alias("base"))
    return base.select("ticker", F.count("*").over(W.partitionBy("base")).alias("share_classes"))


def join_by_name(feed: DataFrame, issuers: DataFrame, name: str = "company") -> DataFrame:
    """A feed joined on the letters and digits of names; of issuers with the same one the last counts (issuers need `ord`)."""
    key = top(issuers.withColumn("_key", company_key(C("name"))), ["_key"], [C("ord").desc()]).select("_key", "ticker")
    return feed.withColumn("_key", company_key(C(name))).join(key, "_key").drop("_key")


def with_fallback_documents(companies: DataFrame, configured: DataFrame) -> DataFrame:
    """(ticker, documents): the configured documents of each issuer as an array, empty where there are none."""
    d = configured.groupBy("ticker").agg(F.array_sort(F.collect_list("doc_id")).alias("documents"))
    return companies.select("ticker").join(d, "ticker", "left").select("ticker", F.coalesce("documents", F.array().cast("array<string>")).alias("documents"))
