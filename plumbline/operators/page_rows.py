"""Rows of report pages as a plan: from text to lines, tokens, runs of amounts, logical rows, columns.

All steps of a page share one exchange by document and page. A page's lines, their tokens and runs of amounts, and what the header above the first row
of amounts says are projections; so is which lines belong together. Only the
folding of compatibility forms has no built-in expression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from . import phrases as PH

C = F.col
PAGE = ["doc_id", "kind", "page_no"]
AMOUNT = "decimal(28,6)"
# ---- fixed values: notations of the reports that this reads ----
NIL = ("-", "–", "—", "nil", "Nil", "NIL")
CURRENCY = ("rs", "rs.", "lkr")
FOREIGN = ("us$", "us $", "usd", "us dollar", "convenience translation")
CHANGE = ("%", "change", "variance", "+/(-)", "+ / (-)")
#: Lengths that headers name, in months; 0 is the time from the start of the financial year.
PERIODS = {"period ended": 0, "quarter": 3, "three month": 3, "3 month": 3, "03 month": 3, "half year": 6, "half-year": 6, "six month": 6, "6 month": 6, "06 month": 6, "nine month": 9, "9 month": 9, "09 month": 9, "twelve month": 12, "12 month": 12, "year ended": 12}
#: Words with which a label goes on in the next line; ends of labels that head further rows.
GOES_ON = ("and", "for", "from", "in", "of", "on", "operating", "other", "plant", "the", "through", "to", "using")
HEADS = (":", "as follows", "attributable to")
#: What a page without a located statement of financial position has to say for its rows to stand in.
SAYS = ("current assets", "current liabilities", "retained earnings", "total assets", "total liabilities")
SHARES_TOLD = (r"(?i)represented by ([0-9][0-9,]*) (?:ordinary|voting) shares", r"(?i)stated capital \(([0-9][0-9,]*) shares\)")
SHARES_AT_END = r"^(number of ordinary shares|number of shares in issue|issued ordinary shares as at|total number of shares|total number of ordinary shares)"
SHARES_AVERAGE = r"weighted[ -]average (number|no\.?) of ordinary shares"
NOT_AT_END = r"denominator|weighted|basic|diluted"
CONFIRMED, ASSUMED, AMBIGUOUS = "0.90", "0.85", "0.60"

CELL = X.CELL
_NOTE = r"^[0-9]{1,2}(\.[0-9]{1,2}){0,2}$"
_YEAR = r"(?<![/\-0-9])20[0-9]{2}(?![/\-0-9])"
_DATE = r"[0-9]{1,2}[./-][0-9]{1,2}[./-]20[0-9]{2}"
_MONTH = r"\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?,?\s+20[0-9]{2}\b"


def _texts() -> Column:
    return F.array().cast("array<string>")


def with_lines(pages: DataFrame) -> DataFrame:
    """pages(doc_id, kind, page_no, text) -> (doc_id, kind, page_no, lines), lines being an array of (place from 0, line, label, cells): normalised lines, and of
    each the longest run of amounts and nil marks and the words ahead of it. Column marks and currency signs don't break a run. All of it is one
    projection."""
    parts = F.split(X.normalize_text(F.coalesce("text", F.lit(""))), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")
    kept = F.filter(F.transform(parts, lambda x: F.trim(F.regexp_replace(x, r"[\s\x1f\u1680\u2000-\u200a\u202f\u205f\u3000]+", " "))), lambda x: x != "")
    tokens = lambda x: F.filter(F.split(F.translate(x, "|", " "), " "), lambda t: (t != "") & ~F.lower(t).isin(*CURRENCY))
    # a number of tasks of its own: what follows is dear for its bytes, by which adaptive execution would put small partitions together
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    p = pages.repartition(tasks, "doc_id", "page_no").select(*PAGE, F.transform(kept, lambda x: F.struct(x.alias("line"), tokens(x).alias("tokens"))).alias("_t"))
    p = p.withColumn("_t", F.transform("_t", lambda y: F.struct(y["line"].alias("line"), y["tokens"].alias("tokens"), X.longest_run(y["tokens"], False).alias("run"))))
    ahead = lambda z: F.when(z["run"]["n"] > 0, z["run"]["last"] + 1 - z["run"]["n"]).otherwise(F.size(z["tokens"]))
    parsed = lambda z, i: F.struct(i.alias("place"), z["line"].alias("line"), F.array_join(F.slice(z["tokens"], F.lit(1), ahead(z)), " ").alias("label"), F.slice(z["tokens"], ahead(z) + 1, z["run"]["n"]).alias("cells"))
    return p.select(*PAGE, F.transform("_t", parsed).alias("lines"))


# ---- what a header says: projections over header(array of its lines) ----
def _first_that(lines: Column, test) -> Column:
    return F.get(F.filter(lines, test), F.lit(0))


def _numbers(texts: Column) -> Column:
    return F.transform(texts, lambda x: x.cast("int"))


def _all(pattern: str):
    return lambda x: F.regexp_extract_all(x, F.lit(pattern), F.lit(0))


def header_years(line: Column) -> Column:
    """The years of a line; one that belongs to a date ahead of them is left out."""
    years = _numbers(_all(_YEAR)(line))
    dated = (F.size(years) % 2 == 1) & (F.get(years, F.lit(0)) == F.get(years, F.lit(1))) & F.lower(line).rlike(_MONTH)
    return F.coalesce(F.when(dated, F.slice(years, 2, 99)).otherwise(years), F.array().cast("array<int>"))


def period_names(header: Column) -> Column:
    """The lengths that a header names, in its order; the same one in a row counts once."""
    names = r"\b(" + "|".join(sorted(PERIODS, key=len, reverse=True)) + r")(?=s?\b)"
    months = F.create_map(*[F.lit(x) for k, v in PERIODS.items() for x in (k, v)])
    found = F.transform(F.regexp_extract_all(F.lower(F.regexp_replace(F.array_join(header, " "), r"\s+", " ")), F.lit(names), F.lit(1)), lambda n: F.element_at(months, n))
    return F.filter(found, lambda m, i: (i == 0) | (m != F.get(found, i - 1)))


def range_months(header: Column) -> Column:
    """Months from one date to another, both counted, where a header gives a range: as starts above ends, else within its text."""
    starts = F.filter(F.sequence(F.lit(0), F.size(header)), lambda i: F.lower(F.get(header, i)).rlike(rf"{_DATE}.*to$") & F.get(header, i + 1).rlike(_DATE))
    at = F.get(starts, F.lit(0))
    within = F.regexp_extract_all(F.array_join(header, " "), F.lit(rf"(?i)({_DATE})\s+(?:to|-|–)(?:\s+(?!{_DATE})\S+){{0,4}}\s+({_DATE})"), F.lit(0))
    date = lambda text, last=False: F.split(F.element_at(_all(_DATE)(text), -1 if last else 1), "[./-]")
    a, b = F.when(at.isNotNull(), date(F.get(header, at))).otherwise(date(F.get(within, F.lit(0)))), F.when(at.isNotNull(), date(F.get(header, at + 1))).otherwise(date(F.get(within, F.lit(0)), True))
    part = lambda d, k: F.get(d, F.lit(k)).cast("int")
    months = (part(b, 2) - part(a, 2)) * 12 + part(b, 1) - part(a, 1) + 1
    return F.when((at.isNotNull() | (F.size(within) > 0)) & months.between(1, 24), months)


def with_header(pages: DataFrame) -> DataFrame:
    """pages(kind, header) with years, falling, starts (of the blocks of columns), change, is_foreign, scopes, months, block and counts, the numbers of
    cells of a full row. Where the blocks of columns are periods, block is the one from the start of the year, or the longest below a year."""
    text = lambda c: F.lower(F.array_join(c, "\n"))
    in_text = lambda words: reduce(lambda x, y: x | y, [F.contains(text("header"), F.lit(w)) for w in words])
    of_years = _first_that(C("header"), lambda x: F.size(F.array_distinct(_all(_YEAR)(x))) >= 2)  # the first line with two different ones
    of_scopes = _first_that(C("header"), lambda x: F.lower(x).rlike(r"\b(group|consolidated)") & F.lower(x).rlike(r"\bcompany") & (F.length(x) <= 110))
    d = pages.withColumns({"_years": of_years, "_scopes": of_scopes, "_range": range_months(C("header"))})
    d = d.withColumns({"years": header_years(C("_years")), "_named": period_names(C("header")), "is_foreign": in_text(FOREIGN)})
    marks = r"(?<![a-z])(" + "|".join("".join("\\" + c if not c.isalnum() and c != " " else c for c in w) for w in CHANGE) + r")(?![a-z])"
    d = d.withColumns({"falling": F.coalesce(F.get("years", F.lit(0)) > F.get("years", F.lit(1)), F.lit(False)), "change": text("header").rlike(marks)})
    year = lambda i: F.get("years", i)
    turns = F.filter(F.sequence(F.lit(1), F.greatest(F.size("years"), F.lit(1))), lambda i: F.coalesce(F.when(C("falling"), year(i) > year(i - 1)).otherwise(year(i) < year(i - 1)), F.lit(False)))
    both = C("_scopes")
    first = F.regexp_instr(F.lower(both), F.lit(r"\b(group|consolidated)")) < F.regexp_instr(F.lower(both), F.lit(r"\bcompany"))
    scopes = F.when(both.isNull(), _texts()).when(first, F.array(F.lit("group"), F.lit("company"))).otherwise(F.array(F.lit("company"), F.lit("group")))
    d = d.withColumns({"starts": F.concat(F.array(F.lit(0)), turns), "scopes": scopes})
    kinds, known = F.array_distinct("_named"), F.array_distinct(F.filter("_named", lambda m: m != 0))
    blocks, short = F.size("starts"), F.filter("_named", lambda m: m < 12)
    to_date = F.when(F.array_contains("_named", 0), 0).otherwise(F.array_max(short))
    by_block = (F.size("scopes") == 0) & (F.size(kinds) > 1) & (blocks > 1) & (F.size(short) > 0) & (F.size("_named") == blocks)
    lone = F.get("_named", F.lit(0))
    interim = (
        F.when(F.size(kinds) == 1, lone).when(F.size("scopes") > 0, F.when(F.size(known) == 1, F.get(known, F.lit(0))))
        .when((F.size("_named") > 0) & (blocks == 1), F.when(lone < 12, lone)).when(by_block, to_date)
    )
    is_interim = C("kind") == "interim_statement"
    n = F.size("years")
    return d.withColumns({
        "months": F.when(is_interim, interim).otherwise(F.coalesce("_range", F.lit(12))), "block": F.when(is_interim & by_block, F.array_position("_named", to_date).cast("int") - 1),
        "counts": F.when(n == 0, F.array().cast("array<int>")).when(C("change"), F.array(n, n + blocks)).otherwise(F.array(n)),
    }).drop("_named", "_years", "_scopes", "_range")


def page_unit(header: Column, whole: Column) -> Column:
    """The header's unit, else that of a sentence that states one, if it is a multiple."""
    sentences = F.split(whole, r"[.\n]\s")
    said = F.filter(F.transform(sentences, lambda s: F.regexp_extract(F.lower(s), r"(?s)\b(?:values|amounts|figures)\b.{0,60}", 0)), lambda s: s.rlike(r"\b(rupees?|rs|lkr)\b") & F.coalesce(X.detect_unit(s)["multiplier"] > 1, F.lit(False)))
    return F.coalesce(X.detect_unit(F.array_join(header, " ")), X.detect_unit(F.get(said, F.lit(0))))


def with_pages(pages: DataFrame) -> DataFrame:
    """pages(doc_id, kind, page_no, text) -> one row a page: lines (array of place, line, label, cells, in order) and all that the page as a whole says."""
    p = with_lines(pages)
    amounts = lambda x: F.size(F.filter(x["cells"], lambda c: ~c.rlike("^20[0-9]{2}$")))
    stops = lambda x: (amounts(x) >= 2) & ~x["line"].rlike(_YEAR) & x["line"].rlike("[A-Za-z]{3}")
    text = F.transform("lines", lambda x: x["line"])
    p = p.withColumn("_stop", F.get(F.filter(F.slice("lines", 1, 30), stops), F.lit(0))["place"])
    p = p.withColumns({"header": F.slice(text, F.lit(1), F.coalesce("_stop", F.lit(30))), "_whole": F.array_join(text, "\n"), "_top": F.lower(F.array_join(F.slice(text, 1, 8), "\n"))})
    p = with_header(p).withColumns({"_unit": page_unit(C("header"), C("_whole")), "_lead": X.detect_unit(F.left("_whole", F.lit(2000))), "_low": F.lower("_whole"), "_early": F.lower(F.left("_whole", F.lit(1800)))})
    holds = lambda c, words: reduce(lambda x, y: x | y, [F.contains(C(c), F.lit(w)) for w in words])
    to = F.regexp_extract("_early", r"\b0?([369]) months? to\b", 1)
    flat = F.array_join(text, " ")
    told = F.array(*[F.struct(F.lit(k).alias("rank"), F.regexp_extract(flat, pattern, 0).alias("said"), F.replace(F.regexp_extract(flat, pattern, 1), F.lit(","), F.lit("")).try_cast(AMOUNT).alias("count")) for k, pattern in enumerate(SHARES_TOLD)])
    return p.withColumns({
        "scope": F.when(F.size("scopes") > 0, "group").otherwise("primary"), "unit": C("_unit.unit"), "multiplier": C("_unit.multiplier").cast("long"), "lead_unit": C("_lead.unit"), "lead_multiplier": C("_lead.multiplier").cast("long"),
        "titles": F.array_compact(F.array(*[F.when(holds("_top", t), F.lit(s)) for s, t in PH.TITLES.items()])), "months_to": F.when((to != "") & F.contains("_early", F.lit("unaudited")), to.cast("int")),
        "heading": holds("_low", PH.HEADINGS), "highlights": F.contains("_low", F.lit(PH.HIGHLIGHTS)), "says": F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(s)), F.lit(s)) for s in SAYS])),
        "told": F.filter(told, lambda x: x["said"] != ""),
    }).drop("_stop", "_whole", "_top", "_unit", "_lead", "_low", "_early")


# ---- rows ----
def amount(token: Column) -> Column:
    """The value of a cell; nil marks are null."""
    bare = F.regexp_replace(token, "[*%]+$", "")
    body = F.regexp_replace(bare, "[()]", "")
    plain = F.when(body.rlike(r"^-?[0-9]+,[0-9]{1,2}$"), F.replace(body, F.lit(","), F.lit("."))).otherwise(F.replace(body, F.lit(","), F.lit("")))
    value = plain.try_cast(AMOUNT)
    return F.when(~bare.isin(*NIL), F.when(bare.startswith("("), -value).otherwise(value))


def amounts_only(rows: DataFrame) -> DataFrame:
    """rows(cells, counts, ..) with cells without what stands ahead of the amounts: numbers of the label, a dash, or a note's number. counts are the numbers of
    cells that the header speaks for, empty if it says nothing.

    A dash goes if the header has columns for the rest alone. What looks like a note's number goes by any of these signs: it has fewer decimals than
    all the rest have alike; the header has columns for the rest alone, or more than the odd row has cells; without a header, what follows is over
    200 and three times as large, or the row is odd and the number whole."""
    holds = lambda test: F.coalesce(test, F.lit(False))
    like_note = lambda c: holds(~c.isin(*NIL) & c.rlike(_NOTE))
    decimals = lambda t: F.length(F.regexp_extract(F.regexp_replace(t, "[()*%]", ""), r"\.(.*)$", 1))
    size, most = F.size("cells"), F.array_max("counts")
    # of a row of more cells than a full one and its note the last ones count
    surplus = holds(size > most + 1)
    rows = rows.withColumn("_c", F.when(surplus, F.slice("cells", size - most - like_note(F.get("cells", size - most - 1)).cast("int") + 1, size)).otherwise(C("cells")))
    rows = rows.withColumns({"_n": F.size("_c"), "_lead": F.get("_c", F.lit(0)), "_rest": F.filter(F.slice("_c", F.lit(2), F.greatest(F.size("_c"), F.lit(1))), lambda t: ~t.isin(*NIL))})
    rows = rows.withColumns({"_note": like_note(C("_lead")), "_places": F.array_distinct(F.transform("_rest", decimals)), "_fits": ~F.array_contains("counts", C("_n")) & F.array_contains("counts", C("_n") - 1)})
    odd, silent, n = C("_n") % 2 == 1, F.size("counts") == 0, C("_n")
    finer = (F.size("_places") == 1) & (decimals(C("_lead")) < F.get("_places", F.lit(0)))
    narrow = ~F.array_contains("counts", n) & odd & (n < F.array_min("counts"))
    dwarfed = F.abs(amount(F.get("_rest", F.lit(0)))) > F.greatest(3 * F.substring_index("_lead", ".", 1).try_cast("int"), F.lit(200))
    note = C("_note") & (holds(finer) | holds(~silent & (C("_fits") | narrow)) | holds(silent & dwarfed) | holds(silent & odd & ~F.contains("_lead", F.lit("."))))
    drop = (n >= 2) & (note | holds(C("_lead").isin(*NIL) & ~silent & C("_fits")))
    rows = rows.withColumn("cells", F.when(size < 2, C("cells")).when(drop, F.slice("_c", F.lit(2), F.greatest(n, F.lit(1)))).otherwise(C("_c")))
    return rows.drop("_c", "_n", "_lead", "_rest", "_note", "_places", "_fits")


def logical_rows(pages: DataFrame, keep: list[str], bare: bool = True) -> DataFrame:
    """with_pages()'s rows -> (keep.., counts, place, label, cells, line): rows in order of place. A label that goes on in the next line, which has the amounts, is put
    together with it; so are amounts whose label goes on in few words below. Lines with column marks are rows of tables, which the text has too, and left
    out. Of a run of lines that each want the next, every other one takes it. Without `bare`, rows without amounts are left out.

    All is said of a page's array of lines: no row is sorted or sent anywhere."""
    keep = [c for c in keep if c != "counts"]
    p = pages.select(*keep, "counts", F.filter("lines", lambda x: ~F.contains(x["line"], F.lit("|"))).alias("_own"))

    def wants(x: Column, i: Column) -> Column:
        below = F.get("_own", i + 1)
        low, lower = F.lower(x["label"]), below["label"].rlike(r"^\p{Ll}")
        open_ended = F.substring_index(low, " ", -1).isin(*GOES_ON) | low.rlike(r"[,/&(\-]$")
        heads = reduce(lambda a, b: a | b, [low.endswith(h) for h in HEADS])
        empty, empty_below = F.size(x["cells"]) == 0, F.size(below["cells"]) == 0
        onward = empty & ~empty_below & (x["label"] != "") & (lower | open_ended) & ~heads
        downward = ~empty & empty_below & lower & (F.size(F.split(below["label"], " ")) <= 3)
        return F.when((i + 1 < F.size("_own")) & (onward | downward), "1").otherwise("0")

    # a line of a run takes the next one if that many lines of the run stand ahead of it as make an even number: 1111 becomes 1010
    p = p.withColumn("_takes", F.replace(F.array_join(F.transform("_own", wants), ""), F.lit("11"), F.lit("10")))
    joined = lambda a, b: F.concat_ws(" ", F.nullif(a, F.lit("")), F.nullif(b, F.lit("")))

    def row(x: Column, i: Column) -> Column:
        below, takes = F.get("_own", i + 1), F.substring(C("_takes"), i + 1, F.lit(1)) == "1"
        both = lambda c: F.when(takes, joined(x[c], below[c])).otherwise(x[c]).alias(c)
        return F.struct(x["place"].alias("place"), both("label"), F.when(takes & (F.size(x["cells"]) == 0), below["cells"]).otherwise(x["cells"]).alias("cells"), both("line"))

    taken = lambda i: (i > 0) & (F.substring(C("_takes"), i, F.lit(1)) == "1")
    own = F.filter(F.transform("_own", lambda x, i: F.when(~taken(i), row(x, i))), lambda r: r.isNotNull() & (F.lit(bare) | (F.size(r["cells"]) > 0)))
    # outer: a plain explode makes a filter of the whole expression, as copies of it
    r = p.select(*keep, "counts", F.explode_outer(own).alias("_row")).where("_row is not null").select(*keep, "counts", "_row.*")
    return amounts_only(r).select(*keep, "counts", "place", "label", "cells", "line")


def column_pair(values: Column, years: Column, starts: Column, falling: Column, change: Column, scopes: Column, block: Column, counts: Column) -> Column:
    """struct(current, previous, sure): the two amounts of the wanted block of columns, the group's where the header tells scopes. A row that doesn't agree
    with the header gives its first pair, or its last one where the group stands last."""
    n = F.size(values)
    wanted = F.coalesce(block, F.when(F.size(scopes) > 0, F.array_position(scopes, "group").cast("int") - 1).otherwise(0))
    wide = change & (n == F.size(years) + F.size(starts))
    agrees = F.array_contains(counts, n) & (wanted < F.size(starts))
    first = F.when(agrees, F.get(starts, wanted) + F.when(wide, wanted).otherwise(0)).when(wanted == 0, 0).otherwise(F.greatest(n - 2, F.lit(0)))
    sure = F.when(agrees, CONFIRMED).when(wanted == 0, ASSUMED).otherwise(AMBIGUOUS)
    ordered = falling | (F.size(years) < 2)
    a, b = F.get(values, first), F.get(values, first + 1)
    return F.struct(F.when(ordered, a).otherwise(b).alias("current"), F.when(ordered, b).otherwise(a).alias("previous"), sure.cast("decimal(3,2)").alias("sure"))


def share_rows(pages: DataFrame, keep: list[str]) -> DataFrame:
    """(keep.., rank, place, count, scale, said): counts of shares that a page tells in a sentence (rank 0), as a row of the period's end (1), or as a weighted
    average (2). The amounts of a row may stand one or two lines below its label; only what the row itself says scales them."""
    told = pages.select(*keep, F.explode("told").alias("x")).select(*keep, F.lit(0).alias("rank"), C("x.rank").alias("place"), C("x.count").alias("count"), F.lit(1).cast("long").alias("scale"), C("x.said").alias("said"))
    r = pages.select(*keep, F.explode(F.transform("lines", lambda x, i: F.struct(i.alias("place"), x["line"].alias("line"), F.concat_ws(" ", x["line"], F.get("lines", i + 1)["line"], F.get("lines", i + 2)["line"]).alias("said")))).alias("x")).select(*keep, "x.*")
    low = F.lower("said")
    at_end = low.rlike(SHARES_AT_END) & ~low.rlike(NOT_AT_END)
    average = F.regexp_instr(low, F.lit(SHARES_AVERAGE)).between(1, F.length("line"))
    r = r.where(low.rlike("number of|no\\.? of|shares as at")).withColumn("rank", F.when(at_end, 1).when(average, 2)).where("rank is not null")
    ends = F.when(C("rank") == 1, F.length(F.regexp_extract(low, SHARES_AT_END, 0))).otherwise(F.regexp_instr(low, F.lit(SHARES_AVERAGE)) - 1 + F.length(F.regexp_extract(low, SHARES_AVERAGE, 0)))
    tail = F.substring(C("said"), ends + 1, F.length("said"))
    marks = F.regexp_replace(F.lower(tail), r"(?:rs\.?|lkr) ?'? ?000", "")
    scale = F.when(marks.rlike(r"million|\bmn\b"), 1_000_000).when(marks.rlike("' ?000"), 1000).otherwise(1).cast("long")
    plain = F.regexp_replace(tail, r"\([^0-9)]*' ?000s?\)|' ?000s?", " ")
    values = F.filter(F.transform(F.filter(F.split(plain, " +"), lambda t: t.rlike(CELL)), amount), lambda v: F.coalesce(v != 0, F.lit(False)))
    r = r.withColumns({"scale": scale, "_v": values})
    noted = (C("scale") == 1000) & (F.size("_v") > 1) & (F.abs(F.get("_v", F.lit(0))) <= 200)
    kept = F.when(noted, F.slice("_v", F.lit(2), F.greatest(F.size("_v"), F.lit(1)))).when(C("scale") == 1, F.filter("_v", lambda v: F.abs(v) > 2000)).otherwise(C("_v"))
    r = r.withColumn("count", F.get(kept, F.lit(0))).where("count is not null")
    return told.unionByName(r.select(*keep, "rank", "place", "count", "scale", "said"))
