"""Quality rules (operator 4): a table of thresholds, compiled into one projection of built-in expressions.

Defined cases: null text has no words, fails on n_words and isn't kept; repeated rows each get a row; a null id stays;
further columns are ignored by `quality_report` and kept by `keep_good`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text

#: Separators of words, as the contract has them.
SEPARATORS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of English; German; French; Spanish; Italian, Portuguese and Dutch; Polish and Czech; Russian;
#: Turkish; Swedish and Danish; Romanian; Indonesian. A text in another language has to be given its words, or thresholds without that row.
STOP_WORDS = (
    "the be to of and that have with in for on is are was this it as by at from or an not he she they we you "
    "der die das und ist ein eine zu den von mit im auf für nicht sich des dem als auch es "
    "le la les de des et en un une du que qui pour par sur au aux est pas avec dans il elle "
    "el los las y o del se con su al lo como más no una para por "
    "il di che e per non sono della gli nel os as da em uma não het een van op te "
    "na się nie do że jest jak od po dla není že který tak ale "
    "и в не на что он как это по из для от "
    "ve bir bu için ile da daha olarak gibi çok "
    "och att det som på är med av ikke til "
    "și în nu este care mai din dan yang di untuk dengan ini itu"
).split()
#: (measure, least, most, words from which the row holds); None leaves an end open. A document is kept if it passes the base rules
#: and every row; a short text may well have no function word.
THRESHOLDS = (
    ("mean_word_chars", 2.0, 12.0, 0),
    ("symbol_ratio", None, 0.1, 0),
    ("stop_ratio", 0.06, None, 40),
    ("dup_line_ratio", None, 0.5, 0),
    ("same_next_ratio", None, 0.2, 0),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _gram(words: Column, i: Column) -> Column:
    return F.array_join(F.slice(words, i + 1, 5), " ")


def repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more. Hashes of the windows only tell that a text has none; where they
    repeat, the windows themselves are sorted and compared."""
    n = F.size(words)
    starts = F.sequence(F.lit(0), n - 5)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(5)]))
    ordered = F.sort_array(F.transform(starts, lambda i: F.struct(_gram(words, i).alias("g"), i.alias("p"))))
    # bound once: lambdas below would compute the array again for each element
    twice = F.get(F.transform(F.array(ordered), lambda s: F.filter(s, lambda x, i: (F.get(s, i - 1)["g"] == x["g"]) | (F.get(s, i + 1)["g"] == x["g"]))), F.lit(0))
    places = F.sort_array(F.transform(twice, lambda x: x["p"]))
    covered = F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(-5).alias("last")), lambda acc, p: F.struct((acc["n"] + F.least(F.lit(5), p - acc["last"])).alias("n"), p.alias("last")), lambda acc: acc["n"])
    some = F.get(F.transform(F.array(hashes), lambda h: F.size(F.array_distinct(h)) < F.size(h)), F.lit(0))
    return F.when(n < 6, 0).when(~some, 0).otherwise(covered).cast("long")


def _measures(rows: DataFrame) -> DataFrame:
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.translate(x, SEPARATORS, "") != "")
    rows = rows.withColumns({"_words": F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != ""), "_lines": lines})
    rows = rows.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.translate("text", SEPARATORS, "")).cast("long"),
        "n_symbols": (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("_words")),
        "n_same_next": F.size(F.filter("_words", lambda w, i: w == F.get("_words", i - 1))).cast("long"),
        "n_stop_words": F.size(F.filter("_words", lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?")).isin(STOP_WORDS))).cast("long"),
    })
    return rows.withColumns({
        "mean_word_chars": _ratio(F.col("word_chars"), F.col("n_words")),
        "symbol_ratio": _ratio(F.col("n_symbols"), F.col("n_words")),
        "stop_ratio": _ratio(F.col("n_stop_words"), F.col("n_words")),
        "same_next_ratio": _ratio(F.col("n_same_next"), F.col("n_words")),
        "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
    })


def _passes(thresholds) -> Column:
    out = F.lit(True)
    for measure, least, most, words in thresholds:
        for test in ([F.col(measure) >= least] if least is not None else []) + ([F.col(measure) <= most] if most is not None else []):
            out = out & (test if not words else (F.col("n_words") < words) | test)
    return out


REPORT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_same_next", "n_stop_words")


def quality_report(docs: DataFrame, thresholds=THRESHOLDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_same_next, n_stop_words, base_failed, kept)"""
    rows = _measures(id_and_text(docs, id_col, text_col)).withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return rows.select("doc_id", *REPORT, "base_failed", (~F.col("base_failed") & _passes(thresholds)).alias("kept"))


def keep_good(docs: DataFrame, thresholds=THRESHOLDS, text_col: str = "text") -> DataFrame:
    """docs without the documents that are not kept; all columns stay. The verdict passes through a generator of one row, so
    that the filter isn't pushed below the projection and every measure is computed once."""
    whole = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = _measures(whole).withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    judged = rows.select("_row", F.explode(F.array(~F.col("base_failed") & _passes(thresholds))).alias("_kept"))
    return judged.where("_kept").select("_row.*")
