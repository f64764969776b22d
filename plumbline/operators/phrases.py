"""Phrases of report labels as one flat table, and labels matched with it by a join.

Labels and phrases are compared as words: lower case, letters only, without "the" and plural endings, "profit/(loss)" as "profit". A phrase is
found where a label begins with it, words of `before` standing ahead of it or not, or anywhere in the label; `later` has to stand
somewhere behind it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

C = F.col


class Phrase(NamedTuple):
    tag: str
    order: int
    phrase: str
    before: str = ""
    later: str = ""
    anywhere: bool = False


STATEMENTS = ("income", "position", "cash_flow")
_DEBT = "current non portion of short long term"
# ---- fixed values: phrases of the reports that this reads, by tag; order is a metric's preference among its phrases ----
PHRASES = (
    Phrase("attribution", 0, "profit attributable to"), Phrase("attribution", 0, "profit for the period attributable to"), Phrase("attribution", 0, "profit for the year attributable to"),
    Phrase("basic", 0, "basic"),
    Phrase("debt", 0, "bank overdrafts", _DEBT), Phrase("debt", 0, "borrowings", _DEBT), Phrase("debt", 0, "debentures", _DEBT), Phrase("debt", 0, "due to banks", _DEBT), Phrase("debt", 0, "import demand loans", _DEBT), Phrase("debt", 0, "import loans", _DEBT),
    Phrase("debt", 0, "interest bearing borrowings", _DEBT), Phrase("debt", 0, "interest bearing liabilities", _DEBT), Phrase("debt", 0, "interest bearing loans and borrowings", _DEBT), Phrase("debt", 0, "interest bearing loans and liabilities", _DEBT),
    Phrase("debt", 0, "interest bearing loans borrowings", _DEBT), Phrase("debt", 0, "interest bearing loans liabilities", _DEBT), Phrase("debt", 0, "loans and borrowings", _DEBT), Phrase("debt", 0, "term loans", _DEBT),
    Phrase("earnings_close", 0, "balance as at the end of the year"),
    Phrase("flow:capital_expenditure", 0, "purchase and construction of property plant and equipment", anywhere=True), Phrase("flow:capital_expenditure", 0, "purchase of property plant and equipment", anywhere=True),
    Phrase("flow:net_profit", 0, "profit for the period", anywhere=True), Phrase("flow:net_profit_attributable", 0, "owners of the parent", anywhere=True),
    Phrase("flow:operating_cash_flow", 0, "net cash flows generated from operating activities", anywhere=True), Phrase("flow:operating_cash_flow", 0, "net cash flows inflow from operating activities", anywhere=True), Phrase("flow:operating_cash_flow", 0, "net cash flows used in operating activities", anywhere=True),
    Phrase("flow:operating_cash_flow", 0, "net cash generated from operating activities", anywhere=True), Phrase("flow:operating_cash_flow", 0, "net cash inflow from operating activities", anywhere=True), Phrase("flow:operating_cash_flow", 0, "net cash used in operating activities", anywhere=True),
    Phrase("flow:operating_profit", 0, "operating profit", anywhere=True), Phrase("flow:operating_profit", 0, "results from operating activities", anywhere=True), Phrase("flow:revenue", 0, "revenue", anywhere=True),
    Phrase("lone_bank", 0, "cash in hand and at bank"),
    Phrase("lone_debt", 0, "borrowings"), Phrase("lone_debt", 0, "current portion of long term interest bearing borrowings"), Phrase("lone_debt", 0, "interest bearing borrowings"), Phrase("lone_debt", 0, "loans and borrowings"), Phrase("lone_debt", 0, "short term interest bearing borrowings"),
    Phrase("lone_deposits", 0, "short term deposits"),
    Phrase("metric:bvps", 0, "net assets per share"), Phrase("metric:bvps", 0, "net assets per ordinary share"), Phrase("metric:bvps", 0, "net assets value per share"), Phrase("metric:bvps", 0, "net assets value per ordinary share"), Phrase("metric:bvps", 1, "book value per share"),
    Phrase("metric:capital_expenditure", 0, "acquisition and construction of property plant and equipment"), Phrase("metric:capital_expenditure", 0, "acquisition of property plant and equipment"), Phrase("metric:capital_expenditure", 0, "acquisition to property plant and equipment"),
    Phrase("metric:capital_expenditure", 0, "addition and construction of property plant and equipment"), Phrase("metric:capital_expenditure", 0, "addition of property plant and equipment"), Phrase("metric:capital_expenditure", 0, "addition to property plant and equipment"),
    Phrase("metric:capital_expenditure", 0, "purchase and construction of property plant and equipment"), Phrase("metric:capital_expenditure", 0, "purchase of property plant and equipment"), Phrase("metric:capital_expenditure", 1, "investment in property plant and equipment"),
    Phrase("metric:cash", 0, "cash and cash equivalents"), Phrase("metric:cash", 1, "cash and short term deposits"), Phrase("metric:cash", 2, "cash in hand and at bank"), Phrase("metric:cash", 3, "cash and balances with banks"), Phrase("metric:cash", 4, "bank and cash balances"), Phrase("metric:cash", 4, "cash and bank balances"),
    Phrase("metric:dps", 0, "dividends per ordinary share"), Phrase("metric:dps", 0, "dividends per share"),
    Phrase("metric:ebit", 0, "earnings before interest and tax"), Phrase("metric:ebit", 1, "profit before interest and tax"),
    Phrase("metric:eps", 0, "basic", later="earnings per ordinary share"), Phrase("metric:eps", 0, "basic", later="earnings per share"), Phrase("metric:eps", 0, "basic", later="loss per ordinary share"), Phrase("metric:eps", 0, "basic", later="loss per share"),
    Phrase("metric:eps", 1, "earnings per ordinary share"), Phrase("metric:eps", 1, "earnings per share"), Phrase("metric:eps", 1, "loss per ordinary share"), Phrase("metric:eps", 1, "loss per share"),
    Phrase("metric:net_profit", 0, "profit after tax for the period", "net"), Phrase("metric:net_profit", 0, "profit after tax for the year", "net"), Phrase("metric:net_profit", 0, "profit for the period", "net"), Phrase("metric:net_profit", 0, "profit for the year", "net"),
    Phrase("metric:net_profit", 1, "loss for the period", "net"), Phrase("metric:net_profit", 1, "loss for the year", "net"),
    Phrase("metric:operating_cash_flow", 0, "net cash", later="operating activities"),
    Phrase("metric:operating_profit", 0, "operating loss"), Phrase("metric:operating_profit", 0, "operating profit"), Phrase("metric:operating_profit", 1, "profit from operating activities"), Phrase("metric:operating_profit", 1, "profit from operations"), Phrase("metric:operating_profit", 2, "results from operating activities"),
    Phrase("metric:ordinary_equity", 0, "equity attributable to", "total"), Phrase("metric:ordinary_equity", 1, "shareholders funds"),
    Phrase("metric:retained_earnings", 0, "retained earnings"), Phrase("metric:retained_earnings", 0, "retained profits"), Phrase("metric:retained_earnings", 1, "accumulated losses"), Phrase("metric:retained_earnings", 2, "revenue reserves"),
    Phrase("metric:revenue", 0, "total revenue"), Phrase("metric:revenue", 1, "revenue", "gross net"), Phrase("metric:revenue", 2, "turnover", "gross net"),
    Phrase("metric:total_assets", 0, "total assets"), Phrase("metric:total_equity", 0, "total equity"), Phrase("metric:total_liabilities", 0, "total liabilities"),
    Phrase("minority", 0, "minority"), Phrase("minority", 0, "non controlling interests"),
    Phrase("other_attribution", 0, "total comprehensive income", later="attributable to"),
    Phrase("owners", 0, "equity holders of the company"), Phrase("owners", 0, "equity holders of the parent"), Phrase("owners", 0, "equity shareholders of the company"), Phrase("owners", 0, "equity shareholders of the parent"),
    Phrase("owners", 0, "owners of the company"), Phrase("owners", 0, "owners of the parent"), Phrase("owners", 0, "shareholders of the company"), Phrase("owners", 0, "shareholders of the parent"),
    Phrase("per_share_heading", 0, "per ordinary share", anywhere=True), Phrase("per_share_heading", 0, "per share", anywhere=True),
    Phrase("row:cash_flow:beginning", 0, "cash and cash equivalents at the beginning"), Phrase("row:cash_flow:beginning", 0, "cash and cash equivalents at the end"), Phrase("row:cash_flow:change", 0, "net decrease"), Phrase("row:cash_flow:change", 0, "net increase"),
    Phrase("row:cash_flow:financing", 0, "financing activities", anywhere=True), Phrase("row:cash_flow:investing", 0, "investing activities", anywhere=True), Phrase("row:cash_flow:operating", 0, "operating activities", anywhere=True),
    Phrase("row:cash_flow:other", 0, "depreciation"), Phrase("row:cash_flow:other", 0, "dividends paid"), Phrase("row:cash_flow:other", 0, "income tax paid"), Phrase("row:cash_flow:other", 0, "income taxes paid"), Phrase("row:cash_flow:other", 0, "interest paid"),
    Phrase("row:cash_flow:plant", 0, "acquisition and construction of property"), Phrase("row:cash_flow:plant", 0, "acquisition of property"), Phrase("row:cash_flow:plant", 0, "purchase and construction of property"), Phrase("row:cash_flow:plant", 0, "purchase of property"),
    Phrase("row:income:administration", 0, "administrative costs"), Phrase("row:income:administration", 0, "administrative expenses"), Phrase("row:income:before_tax", 0, "loss before tax"), Phrase("row:income:before_tax", 0, "loss before income tax"), Phrase("row:income:before_tax", 0, "profit before income tax"), Phrase("row:income:before_tax", 0, "profit before tax"),
    Phrase("row:income:cost", 0, "cost of revenue"), Phrase("row:income:cost", 0, "cost of sales"), Phrase("row:income:distribution", 0, "distribution costs", "selling and"), Phrase("row:income:distribution", 0, "distribution expenses", "selling and"),
    Phrase("row:income:finance", 0, "finance cost", "net"), Phrase("row:income:finance", 0, "finance expense", "net"), Phrase("row:income:finance", 0, "finance income", "net"), Phrase("row:income:finance", 0, "interest cost", "net"), Phrase("row:income:finance", 0, "interest expense", "net"), Phrase("row:income:finance", 0, "interest income", "net"),
    Phrase("row:income:gross_profit", 0, "gross profit"), Phrase("row:income:other", 0, "other income"), Phrase("row:income:other", 0, "other operating income"), Phrase("row:income:per_share", 0, "earnings per share", anywhere=True), Phrase("row:income:per_share", 0, "loss per share", anywhere=True),
    Phrase("row:income:revenue", 0, "revenue", "total gross net"), Phrase("row:income:revenue", 0, "turnover", "total gross net"), Phrase("row:income:tax", 0, "tax", "income"), Phrase("row:income:tax", 0, "taxation", "income"),
    Phrase("row:income:year", 0, "loss for the period"), Phrase("row:income:year", 0, "loss for the year"), Phrase("row:income:year", 0, "profit for the period"), Phrase("row:income:year", 0, "profit for the year"),
    Phrase("row:position:assets", 0, "total assets"), Phrase("row:position:capital", 0, "stated capital"), Phrase("row:position:current", 0, "total current assets"), Phrase("row:position:current_liabilities", 0, "total current liabilities"), Phrase("row:position:earnings", 0, "retained earnings"), Phrase("row:position:earnings", 0, "retained profits"),
    Phrase("row:position:equity", 0, "total equity"), Phrase("row:position:inventories", 0, "inventories"), Phrase("row:position:liabilities", 0, "total liabilities"), Phrase("row:position:non_current", 0, "total non current assets"), Phrase("row:position:payables", 0, "trade and other payables"),
    Phrase("row:position:plant", 0, "property plant and equipment"), Phrase("row:position:receivables", 0, "trade and other receivables"), Phrase("row:position:sum", 0, "total equity and liabilities"),
)
#: Phrases that rule a label out for a tag, wherever they stand in it.
UNLESS = {
    "debt": ("receivable", "related part", "related parties", "related party", "advances", "lease"), "metric:operating_cash_flow": ("before",), "metric:operating_profit": ("before working capital",), "metric:revenue": ("revenue reserve", "revenue tax"),
    "metric:total_equity": ("equity and liabilities", "equity attributable"),
}
TITLES = {
    "income": ("statement of profit or loss", "income statement", "statement of comprehensive income", "statement of income"), "position": ("statement of financial position", "balance sheet"),
    "cash_flow": ("statement of cash flows", "cash flow statement", "statement of cash flow"),
}
#: The statement that prints a metric, metrics per share, and those that reports print outside of their statements too.
STATEMENT_OF = {
    "bvps": "position", "capital_expenditure": "cash_flow", "cash": "position", "dps": "income", "ebit": "income", "eps": "income", "net_profit": "income", "operating_cash_flow": "cash_flow", "operating_profit": "income", "ordinary_equity": "position",
    "retained_earnings": "position", "revenue": "income", "total_assets": "position", "total_equity": "position", "total_liabilities": "position",
}
PER_SHARE, ELSEWHERE = ("eps", "bvps", "dps"), ("bvps", "dps", "ebit")
#: Headings of the pages that a scan for labels looks at first; pages with the last one come last.
HEADINGS = ("statement of profit or loss", "income statement", "consolidated statement", "statement of financial position", "statement of cash flows", "results from operating activities", "financial highlights")
HIGHLIGHTS = "financial highlights"


def words(label: Column) -> Column:
    """The words of a label or phrase by which they are compared, joined by single spaces."""
    plain = F.replace(F.replace(F.lower(label), F.lit("&"), F.lit(" and ")), F.lit("'"), F.lit(""))
    one = lambda w: F.when(w.endswith("xes"), F.left(w, F.length(w) - 2)).when((F.length(w) > 3) & w.endswith("s") & ~w.endswith("ss"), F.left(w, F.length(w) - 1)).otherwise(w)
    found = F.transform(F.filter(F.regexp_extract_all(plain, F.lit("[a-z]+"), F.lit(0)), lambda w: w != "the"), one)
    both = F.regexp_replace(F.array_join(found, " "), r"\b(profit|earning) loss\b", "$1")
    return F.regexp_replace(both, r"\bloss (profit|earning)\b", "$1")


def phrase_table(spark: SparkSession) -> DataFrame:
    """(tag, order, phrase, before, later, anywhere, barred, head): the phrases as words; head is the first one."""
    barred = [(tag, list(u)) for tag, u in UNLESS.items()]
    rows = spark.createDataFrame([tuple(p) for p in PHRASES], "tag string, order int, phrase string, before string, later string, anywhere boolean")
    rows = rows.join(F.broadcast(spark.createDataFrame(barred, "_tag string, barred array<string>")), C("tag") == C("_tag"), "left").drop("_tag")
    rows = rows.withColumns({"phrase": words(C("phrase")), "later": words(C("later")), "before": F.split("before", " "), "barred": F.transform(F.coalesce("barred", F.array().cast("array<string>")), words)})
    return rows.withColumn("head", F.substring_index("phrase", " ", 1))


def with_tags(rows: DataFrame, keys: list[str], carry: list[str], label: str = "label") -> DataFrame:
    """(keys, tag, ord, carry..): the phrases that each row's label has, the best order of a tag. What stands to the right of amounts begins no label."""
    table = F.broadcast(phrase_table(rows.sparkSession))  # some 170 rows
    said = rows.select(*keys, F.struct(*carry).alias("_row"), words(C(label)).alias("_w"), (~C(label).rlike(r"^\(?-?[0-9][0-9,]{2}")).alias("_starts"))
    said = said.withColumn("_words", F.split("_w", " ")).select("*", F.posexplode_outer("_words").alias("_at", "_word"))
    rest = F.concat(F.array_join(F.slice("_words", C("_at") + 1, F.size("_words")), " "), F.lit(" "))
    padded = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
    # the rest of a label is made only where a phrase begins
    tail = said.join(table, C("_word") == C("head")).withColumn("_tail", rest).where(C("_tail").startswith(F.concat("phrase", F.lit(" "))))
    begins = C("_starts") & F.forall(F.slice("_words", F.lit(1), C("_at")), lambda w: F.array_contains(C("before"), w))
    behind = F.concat(F.lit(" "), F.substring(C("_tail"), F.length("phrase") + 2, F.length("_tail")))
    fits = (C("anywhere") | begins) & ((C("later") == "") | F.contains(behind, padded(C("later")))) & ~F.exists("barred", lambda b: F.contains(padded(C("_w")), padded(b)))
    return tail.where(fits).groupBy(*keys, "tag").agg(F.min("order").alias("ord"), F.first("_row").alias("_row")).select(*keys, "tag", "ord", "_row.*")
