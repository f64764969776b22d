"""Numbers, units, titles, names and labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and labels of the data this engine reads.
NIL = ["", "-", "—", "–", "N/A", "NA"]
THOUSAND_WORDS = r"(?i)rupees?\s+(in\s+)?thousand|thousands?\s+of\s+(rs|rupee|lkr)"
MILLION = r"(?i)(rs\.?|lkr)\s*(in\s*)?(mn|million)"
BILLION = r"(?i)(rs\.?|lkr)\s*(in\s*)?(bn|billion)"
THOUSAND_MARK = r"(?i)(rs\.?|lkr)\s*(in\s*)?000|['‘’]000|\b000s\b"
PLAIN = r"(?i)\b(rs(\.)?|lkr)(\s|$|['0-9)])"
EXCLUDED_TITLE = r"(?i)\b(errata|trust deed|prospectus|articles? of association|accountants?' report|key investor information|bond framework)\b"
ANNUAL_TITLE = r"(?i)\b(annual report|audited financial statements?)\b"
INTERIM_TITLE = r"(?i)\b(interim|quarterly|quarter ended|financial statements? for the quarter)\b"
DIVIDEND_TYPES = (
    ("typeFirstInt", "first interim"), ("typeSecondInt", "second interim"), ("typeThirdInt", "third interim"), ("typeFourthInt", "fourth interim"),
    ("typeFinalInt", "final interim"), ("firstAndFinal", "first and final"), ("finalDividend", "final"), ("typeOther", "other"),
)
GROUP_ALIASES = {"real estate management & development": "real estate", "software & services": "technology hardware & equipment"}
ONE_OFF_PHRASE = r"(?i)\b(one[- ]off|non[- ]recurring|exceptional\s+(item|gain|loss|charge|income|expense)s?)\b"
ONE_OFF_OUTCOME = r"(?i)\b(profit|loss|gain|earnings|income|expense|charge)\b"


def parse_number(text: Column) -> Column:
    """An amount as printed: nil marks are null, brackets mean negative, a lone comma before one or two digits is a decimal comma."""
    t = F.replace(F.trim(text), F.lit(" "), F.lit(""))
    bracketed = t.startswith("(") & t.endswith(")")
    body = F.when(bracketed, F.substring(t, 2, 1 << 20)).otherwise(t)
    body = F.when(bracketed, F.regexp_replace(body, r"\)$", "")).otherwise(body)
    body = F.when(body.rlike(r"^-?\d+,\d{1,2}$"), F.replace(body, F.lit(","), F.lit("."))).otherwise(F.replace(body, F.lit(","), F.lit("")))
    value = F.regexp_replace(body, r"[^0-9.\-]", "").try_cast("decimal(24,6)")
    return F.when(~t.isin(NIL), F.when(bracketed, -value).otherwise(value))


def detect_unit(text: Column) -> Column:
    """struct(unit, multiplier), words before million, billion, a thousands mark and a plain currency; null where none shows."""

    def unit(name: str, multiplier: int) -> Column:
        return F.struct(F.lit(name).alias("unit"), F.lit(multiplier).cast("decimal(24,6)").alias("multiplier"))

    return (
        F.when(text.rlike(THOUSAND_WORDS), unit("LKR '000", 1000)).when(text.rlike(MILLION), unit("LKR million", 10**6)).when(text.rlike(BILLION), unit("LKR billion", 10**9))
        .when(text.rlike(THOUSAND_MARK), unit("LKR '000", 1000)).when(text.rlike(PLAIN), unit("LKR", 1))
    )


def normalize_monetary(value: Column, unit_text: Column) -> Column:
    """The value in units; an unknown unit raises, as it can't be guessed."""
    u = detect_unit(unit_text)
    return F.when(value.isNotNull(), F.when(u.isNull(), F.raise_error(F.concat(F.lit("Unrecognized monetary unit: "), unit_text)).cast("decimal(24,6)")).otherwise((value * u["multiplier"]).cast("decimal(24,6)")))


def filing_kind(title: Column) -> Column:
    return F.when(title.rlike(EXCLUDED_TITLE), F.lit(None)).when(title.rlike(ANNUAL_TITLE), "annual_report").when(title.rlike(INTERIM_TITLE), "interim_statement")


def normalize_group(name: Column) -> Column:
    t = F.regexp_replace(F.trim(name), r"(?i)^S&P/CSE\s+", "")
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"\s*&\s*", " & "), r"\s*,\s*", ", "), r"\s+", " "))


def company_key(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def clean_lines(text: Column) -> Column:
    """Lines with white space squeezed, blank ones dropped."""
    return F.filter(F.transform(F.split(text, r"\r?\n|\r", -1), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")


def fold_quotes(text: Column) -> Column:
    """Typographic quotes, dashes' look-alikes of spaces and ligatures as plain characters."""
    t = F.translate(text, "‘’‛′“”„″   ", "''''\"\"\"\"   ")
    for ligature, plain in (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬀ", "ff"), ("ﬃ", "ffi"), ("ﬄ", "ffl")):
        t = F.replace(t, F.lit(ligature), F.lit(plain))
    return t


def dividend_type(flags: dict[str, Column]) -> Column:
    """The label of the first of the eight marks that is set."""
    return F.coalesce(*[F.when(flags[k], label) for k, label in DIVIDEND_TYPES if k in flags], F.lit(None).cast("string"))


def joined(*parts: Column, sep: str = "; ") -> Column:
    """Parts with a separator; null and empty ones are left out."""
    return F.concat_ws(sep, *[F.nullif(p, F.lit("")) for p in parts])


def fact_id(*parts: Column) -> Column:
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def render_metric(value: Column, kind: str) -> Column:
    """Percent with two digits, a number with two, or a whole number; NA for null."""
    shown = {"percent": F.concat(F.format_number(value * 100, 2), F.lit("%")), "ratio": F.format_number(value, 2), "integer": F.format_number(value, 0)}[kind]
    return F.coalesce(shown, F.lit("NA"))


def market_share_note(method: Column) -> Column:
    return F.when(method.startswith("cse_market_data"), "share count implied by market data")


def excerpt_around(line: Column, pattern: str, before: int = 180, after: int = 220) -> Column:
    """The stretch of a line from so many characters before a pattern's first match to so many behind its end."""
    at = F.regexp_instr(line, F.lit(pattern))
    start = F.greatest(F.lit(1), at - before)
    return F.substring(line, start, at + F.length(F.regexp_extract(line, pattern, 0)) + after - start)


CELL = r"^(\(-?\d[\d,]*(\.\d+)?\)|-?\d[\d,]*(\.\d+)?)%?\*{0,2}$"


def longest_run(tokens: Column, lone_nil: bool = True) -> Column:
    """struct(n, last): the length of the longest run of amounts and nil marks and the place of its last token, from 0; of equally long
    runs the last. Without lone_nil, nil marks alone are a run only as two or more at the end. Each token is looked at once and becomes a
    letter: a for an amount, n for a nil mark, w for a word; runs are then stretches of that text."""
    kinds = F.array_join(F.transform(tokens, lambda t: F.when(t.isin("-", "–", "—", "nil", "Nil", "NIL"), "n").when(t.rlike(CELL), "a").otherwise("w")), "")
    of = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))  # noqa: E731  a value that is made once and used several times
    none = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("last"))

    def placed(kinds: Column, best: Column) -> Column:
        behind = F.length(F.call_function("substring_index", F.concat(F.lit("w"), kinds, F.lit("w")), F.concat(F.lit("w"), best, F.lit("w")), F.lit(-1)))
        return F.struct(F.length(best).alias("n"), (F.length(kinds) - 1 - behind).alias("last"))

    def among(kinds: Column, runs: Column) -> Column:
        most = lambda x: F.element_at(F.filter(x, lambda r: F.length(r) == F.array_max(F.transform(x, F.length))), -1)
        return F.when(F.size(runs) == 0, none).otherwise(of(F.when(F.size(runs) == 1, F.get(runs, F.lit(0))).otherwise(most(runs)), lambda best: placed(kinds, best)))

    runs = lambda k: F.regexp_extract_all(k, F.lit("[an]+" if lone_nil else "n*a[an]*|nn+$"), F.lit(0))
    return F.when(tokens.isNotNull(), of(kinds, lambda k: of(runs(k), lambda r: among(k, r))))


def normalize_text(text: Column) -> Column:
    """Compatibility forms folded (NFKC) and plain quotes; there is no built-in for the former, so it goes through Arrow."""
    import unicodedata

    import pandas as pd

    quotes = {0x2018: "'", 0x2019: "'", 0x60: "'"}

    def folded(s):
        return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).translate(quotes))

    folded.__annotations__ = {"s": pd.Series, "return": pd.Series}  # the kind of UDF is told by these
    return F.pandas_udf(folded, "string")(text)
