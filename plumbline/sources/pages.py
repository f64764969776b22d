"""Landed payloads and page tables. Fetching is a job of its own; Spark reads what has landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import GROUP_ALIASES, filing_kind, normalize_group
from ..operators.liquidity import price
from ..operators.overlays import join_by_name
from ..operators.ranking import top

C = F.col
#: Headings of the primary statements.
STATEMENT_TERMS = ("statement of financial position", "statement of profit or loss", "statement of cash flows", "income statement", "statement of comprehensive income", "balance sheet")


def industry_groups(spark: SparkSession, path: str) -> DataFrame:
    """Landed sectors, {gicsSectors: [{name, groups: [{name}]}]} -> (sector, industry_group)."""
    raw = spark.read.schema("gicsSectors array<struct<name: string, groups: array<struct<name: string>>>>").json(path)
    sectors = raw.select(F.explode("gicsSectors").alias("s"))
    return sectors.select(C("s.name").alias("sector"), F.explode("s.groups").alias("g")).select("sector", C("g.name").alias("industry_group"))


def resolve_group(groups: DataFrame, requested: str) -> str:
    """The group as it is published; raises with the supported names."""
    want = " ".join(requested.lower().split())
    want = GROUP_ALIASES.get(want, want)
    rows = groups.where(normalize_group(C("industry_group")) == want).select("industry_group").limit(1).collect()
    if not rows:
        names = ", ".join(r[0] for r in groups.select("industry_group").distinct().orderBy("industry_group").limit(100).collect())
        raise ValueError(f"unknown group {requested!r}; supported: {names}")
    return rows[0][0]


def companies(spark: SparkSession, path: str) -> DataFrame:
    """Landed constituents -> (ticker, name, current_price, market_cap, share_volume)."""
    raw = spark.read.schema("companies array<struct<symbol: string, name: string, market: struct<lastTradedPrice: double, closingPrice: double, marketCap: double, volume: double>>>").json(path)
    c = raw.select(F.explode("companies").alias("c")).select("c.symbol", "c.name", "c.market.*")
    return c.select(C("symbol").alias("ticker"), "name", price("lastTradedPrice", "closingPrice").alias("current_price"), C("marketCap").alias("market_cap"), C("volume").alias("share_volume"))


def filings(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """Landed filing index of a date range; those of no known kind are left out."""
    raw = spark.read.schema("id long, path string, uploadedDate string, authorizedDate string, fileText string, symbol string").json(path)
    from ..functions.periods import uploaded_date

    f = raw.withColumns({"publication_date": uploaded_date(C("uploadedDate")), "kind": filing_kind(C("fileText"))})
    return f.where(C("kind").isNotNull() & C("path").isNotNull() & C("publication_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def dividends(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema("announcementCategory string, company string, announcementId long, id long").json(path)
    return raw.where("announcementCategory = 'CASH DIVIDEND'")


def latest_dividends(feed: DataFrame, issuers: DataFrame, details: DataFrame) -> DataFrame:
    """feed(company, announcementId, id), issuers(ticker, name, ord), details(announcementId, ..) -> the announcements of known issuers with their
    details, and `recency`, 1 for an issuer's latest. Of a detail that has landed more than once, the last (by `ord`, if it has one) counts."""
    own = join_by_name(feed.where("announcementId is not null"), issuers).select("ticker", C("announcementId").alias("_announcement"), C("id").alias("feed_id"))
    if "ord" in details.columns:
        details = top(details, ["announcementId"], [C("ord").desc()])
    out = own.join(details, own["_announcement"] == details["announcementId"]).drop("_announcement")
    return out.withColumn("recency", F.row_number().over(W.partitionBy("ticker").orderBy(C("announcementId").desc(), C("feed_id").desc())))


def pdf_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, content) of binary files that are PDFs."""
    return spark.read.format("binaryFile").load(path).where(F.substring("content", 1, 4) == F.lit(b"%PDF")).select("path", F.sha2("content", 256).alias("sha256"), "content")


def needs_tables(text: Column) -> Column:
    return (F.length(text) < 1200) | F.lower(text).rlike("|".join(STATEMENT_TERMS))


def table_rows(rows: Column, separator: str = " | ") -> Column:
    """array<array<string>> -> lines of joined cells, blank ones dropped."""
    return F.filter(F.transform(rows, lambda r: F.array_join(F.transform(r, lambda c: F.trim(F.coalesce(c, F.lit("")))), separator)), lambda x: F.regexp_replace(x, r"[\s|]", "") != "")


def thin(text: Column, images: Column) -> Column:
    """A page that OCR may help: fewer than 80 visible characters, and an image."""
    return (F.length(F.regexp_replace(text, r"\s", "")) < 80) & (images > 0)


def ocr_candidates(pages: DataFrame, doc: str, page: str) -> DataFrame:
    """pages(doc, page, thin, image, statement) -> with ocr: all thin pages of a document in which they are three quarters, or at least
    three and a quarter; of other documents only those beside a statement page."""
    need = C("thin") & C("image")
    whole, beside = W.partitionBy(doc), W.partitionBy(doc).orderBy(page).rowsBetween(-1, 1)
    p = pages.withColumns({"_k": F.count_if(need).over(whole), "_n": F.count("*").over(whole), "_near": F.max(C("statement").cast("int")).over(beside)})
    return p.withColumn("ocr", need & ((C("_k") >= 0.75 * C("_n")) | ((C("_k") >= 3) & (C("_k") >= 0.25 * C("_n"))) | (C("_near") == 1))).drop("_k", "_n", "_near")


def read_pages(pages: DataFrame) -> DataFrame:
    """The text of pages alone."""
    return pages.select("doc_id", "page_no", "text")


def pages_with(pages: DataFrame, *terms: str) -> DataFrame:
    out = pages
    for t in terms:
        out = out.where(F.lower("text").contains(t.lower()))
    return out


def only_ticker(df: DataFrame, ticker: str) -> DataFrame:
    """One issuer's rows; raises if there are none."""
    out = df.where(C("ticker") == ticker)
    if not out.limit(1).collect():
        raise ValueError(f"no such ticker: {ticker}")
    return out


def current_warnings(warnings: DataFrame, candidates: DataFrame) -> DataFrame:
    """Cached OCR warnings of pages that still are candidates."""
    return warnings.join(candidates.where("ocr").select("doc_id", "page_no"), ["doc_id", "page_no"], "left_semi")
