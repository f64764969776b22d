"""Facts from the page text of financial reports.

Pages become hits: rows whose label means something, each with the columns that the page's header gives for it (page_rows, phrases). A page's
scores are one row a page, a document's statements one row a document; both are made by aggregation and windows over these few rows and
joined to the hits. Then candidates are ranked, and components and identities summed up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import stored
from . import page_rows as PR
from . import phrases as PH
from .ranking import top

C = F.col
STATEMENTS = PH.STATEMENTS
#: The score that a page needs for a statement, and the pages around the income statement on which the others stand.
LEAST_SCORE = {"income": 5, "position": 5, "cash_flow": 4}
AROUND = {"position": (-4, 7), "cash_flow": (-2, 13)}
TITLE_POINTS, MANY_COLUMNS_POINTS, FOREIGN_POINTS = 3, -6, -6
#: Confidences. Columns have their own, from the header.
NO_UNIT, INHERITED, COMPONENTS, SCANNED, OUTSIDE, FLOW, FLOW_NO_UNIT, FROM_NOTE, RELIABLE = "0.62", "0.02", "0.88", "0.82", "0.70", "0.90", "0.72", "0.92", "0.80"
SHARE_CONFIDENCE = ("0.90", "0.90", "0.78")
LARGE = 10**9  # an amount that isn't in thousands, whatever the page says

_AMOUNT = PR.AMOUNT
#: What hits carry of their page.
OF_PAGE = ["doc_id", "kind", "page_no", "scope", "months", "unit", "multiplier", "lead_unit", "lead_multiplier", "is_foreign", "months_to", "heading", "highlights", "says", "titles"]
_HEADER = ["years", "starts", "falling", "change", "scopes", "block", "counts"]
_HEADS = ("attribution", "other_attribution", "per_share_heading")  # rows that are headings, and so have no amounts


def read_pages(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """pages(doc_id, page_no, text) and documents(doc_id, kind) -> page_rows.with_pages()'s rows, stored: folding and cutting the text is what costs."""
    kinds = documents.select(C("doc_id").alias("_doc"), "kind")
    rows = pages.join(kinds, pages.doc_id == kinds["_doc"]).select(C("doc_id").cast("string").alias("doc_id"), "kind", C("page_no").cast("int").alias("page_no"), C("text").cast("string").alias("text"))
    return stored(PR.with_pages(rows))


def page_hits(read: DataFrame) -> DataFrame:
    """read_pages()'s rows -> one row for each page (tag page, with many_columns) and for each meaning of a row's label."""
    rows = PR.logical_rows(read, [*OF_PAGE, *_HEADER]).withColumn("values", F.transform("cells", PR.amount))
    there = F.filter("values", lambda v: v.isNotNull())
    own = X.detect_unit(C("line"))
    rows = rows.withColumns({"pair": PR.column_pair(*[C(c) for c in ("values", "years", "starts", "falling", "change", "scopes", "block", "counts")]), "there": there, "n": F.size("cells"), "own": own})
    facts = {"current": C("pair.current"), "previous": C("pair.previous"), "sure": C("pair.sure"), "first": F.get("there", F.lit(0)), "second": F.get("there", F.lit(1)), "own_unit": C("own.unit"), "own_multiplier": C("own.multiplier").cast("long")}
    shown = stored(rows.select(*OF_PAGE, "place", "label", "line", "n", *[v.alias(k) for k, v in facts.items()]))
    tagged = PH.with_tags(shown, ["doc_id", "page_no", "place"], [c for c in shown.columns if c not in ("doc_id", "page_no", "place")])
    heads = C("tag").isin(*_HEADS)
    tagged = tagged.where(F.when(heads, C("n") == 0).when(C("tag").startswith("row:"), (C("n") >= 2) & C("first").isNotNull()).otherwise(C("n") > 0)).drop("n")
    shares = PR.share_rows(read, OF_PAGE).select(*OF_PAGE, "place", C("said").alias("label"), C("said").alias("line"), F.lit("shares").alias("tag"), C("rank").alias("ord"), C("count").alias("first"), C("scale").alias("own_multiplier"))
    widths = F.sort_array(F.collect_list(F.when((C("n") >= 2) & C("first").isNotNull(), C("n"))))
    middle = shown.groupBy(C("doc_id").alias("_d"), C("page_no").alias("_p")).agg(widths.alias("_w")).select("_d", "_p", F.coalesce(F.get("_w", (F.size("_w") / 2).cast("int")) > 6, F.lit(False)).alias("many_columns"))
    whole = read.select(*OF_PAGE).join(middle, (C("doc_id") == C("_d")) & (C("page_no") == C("_p")), "left").drop("_d", "_p")
    whole = whole.withColumns({"tag": F.lit("page"), "ord": F.lit(0), "place": F.lit(-1), "many_columns": F.coalesce("many_columns", F.lit(False))})
    return tagged.unionByName(shares, allowMissingColumns=True).unionByName(whole, allowMissingColumns=True)


def _doc() -> W:
    return W.partitionBy("doc_id")


def _page() -> W:
    return W.partitionBy("doc_id", "page_no")


def page_scores(hits: DataFrame) -> DataFrame:
    """(doc_id, page_no, score_<statement>.., unit): one row a page. A score is how many of the statement's rows the page has, with points for its title and against
    many columns and foreign money; 0 below LEAST_SCORE."""
    own = F.max(F.when(C("tag") == "page", F.struct("titles", "many_columns", "is_foreign", "unit", "multiplier")))
    rows = [F.count_distinct(F.when(C("tag").startswith(f"row:{s}:"), C("tag"))).alias(f"_rows_{s}") for s in STATEMENTS]
    p = hits.groupBy("doc_id", "page_no").agg(own.alias("_own"), *rows)
    score = lambda s: C(f"_rows_{s}") + F.when(F.array_contains("_own.titles", s), TITLE_POINTS).otherwise(0) + F.when(C("_own.many_columns"), MANY_COLUMNS_POINTS).otherwise(0) + F.when(C("_own.is_foreign"), FOREIGN_POINTS).otherwise(0)
    scores = [F.when(score(s) >= LEAST_SCORE[s], score(s)).otherwise(0).alias(f"score_{s}") for s in STATEMENTS]
    return p.select("doc_id", "page_no", *scores, F.when(C("_own.unit").isNotNull(), F.struct("_own.unit", "_own.multiplier")).alias("unit_of"))


def statements_of(scores: DataFrame) -> DataFrame:
    """(doc_id, <statement>_page.., known_unit, known_multiplier): one row a document. Each page with an income statement is taken with the best pages for the others
    around it; the document's statements are the group of the highest sum, of equal ones the first. Without any income statement, each of the
    others is on its best page. The known unit is the first that one of the statements has."""
    best = lambda s: F.when(C(f"score_{s}") > 0, F.struct(C(f"score_{s}").alias("score"), (-C("page_no")).alias("page")))
    out = scores.withColumns({f"_near_{s}": F.max(best(s)).over(_doc().orderBy("page_no").rangeBetween(lo, hi)) for s, (lo, hi) in AROUND.items()})
    total = C("score_income") + sum((F.coalesce(C(f"_near_{s}.score"), F.lit(0)) for s in AROUND), F.lit(0))
    group = F.when(C("score_income") > 0, F.struct(total.alias("total"), (-C("page_no")).alias("page"), *[C(f"_near_{s}.page").alias(s) for s in AROUND]))
    units = F.map_from_entries(F.collect_list(F.when(C("unit_of").isNotNull() & (C("score_income") + C("score_position") + C("score_cash_flow") > 0), F.struct("page_no", "unit_of"))))  # of pages with a score
    d = out.groupBy("doc_id").agg(F.max(group).alias("_group"), *[F.max(best(s)).alias(f"_any_{s}") for s in AROUND], units.alias("_units"))
    pages = {"income": -C("_group.page")} | {s: -F.when(C("_group").isNotNull(), C(f"_group.{s}")).otherwise(C(f"_any_{s}.page")) for s in AROUND}
    known = F.coalesce(*[F.try_element_at("_units", pages[s]) for s in STATEMENTS])
    return d.select("doc_id", *[v.alias(f"{s}_page") for s, v in pages.items()], known.alias("_known")).select("doc_id", *[f"{s}_page" for s in STATEMENTS], C("_known.unit").alias("known_unit"), C("_known.multiplier").alias("known_multiplier"))


def statement_pages(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """(doc_id, statement, page): where the reader finds the three statements."""
    found = statements_of(page_scores(page_hits(read_pages(pages, documents))))
    places = F.explode(F.array(*[F.struct(F.lit(s).alias("statement"), C(f"{s}_page").alias("page")) for s in STATEMENTS])).alias("found")
    return found.select("doc_id", places).select("doc_id", "found.*").where("page is not null")


def candidate_pages(pages: DataFrame) -> DataFrame:
    """pages(doc_id, page_no, heading, highlights) with scan_order: pages with a heading of a statement, those of highlights behind the others; all
    pages of a document that has none with a heading. Other pages go."""
    some = F.max(F.coalesce(C("heading"), F.lit(False))).over(_doc())
    rows = pages.withColumn("_some", some).where(C("heading") | ~C("_some"))
    return rows.withColumn("scan_order", F.struct((C("highlights") & C("heading")).alias("last"), C("page_no").alias("page_no"))).drop("_some")


def _candidate(hits: DataFrame, metric: Column, value: Column, previous: Column, unit: Column, multiplier: Column, confidence: Column, method: str, tier: int, order: list[Column], scope: Column | None = None, months: Column | None = None, source: Column | None = None) -> DataFrame:
    return hits.select(
        "doc_id", metric.alias("metric"), value.cast(_AMOUNT).alias("printed"), previous.cast(_AMOUNT).alias("printed_before"), unit.alias("unit"), multiplier.cast("long").alias("multiplier"), confidence.cast("decimal(3,2)").alias("confidence"),
        C("page_no").alias("page"), (C("scope") if scope is None else scope).alias("statement_scope"), F.lit(method).alias("extraction_method"), (C("line") if source is None else source).alias("source_text"),
        (C("months") if months is None else months).cast("int").alias("period_months"), F.lit(tier).alias("tier"), F.array(*[F.coalesce(o.cast("int"), F.lit(0)) for o in order]).alias("order"),
    )


def _lit(x: str) -> Column:
    return F.lit(x).cast("decimal(3,2)")


def _tag_of(prefix: str) -> Column:
    return F.when(C("tag").startswith(prefix), F.substring_index("tag", ":", -1))


def _per_share(metric: Column) -> Column:
    return metric.isin(*PH.PER_SHARE)


def _on_statements(hits: DataFrame) -> DataFrame:
    """Rows of the located statements as candidates: metrics by their labels, the owners' profit under its heading, earnings per share under
    theirs, and debt as a sum of its rows."""
    by_place = _page().orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    heading = F.last(F.when(C("tag").isin("attribution", "other_attribution"), F.struct("tag", "place")), ignorenulls=True).over(by_place)
    per_share = F.last(F.when(C("tag") == "per_share_heading", C("place")), ignorenulls=True).over(by_place)
    rows = hits.withColumns({"_heading": heading["tag"], "_above": C("place") - per_share, "metric": _tag_of("metric:")})
    statement = F.create_map(*[F.lit(x) for m, s in PH.STATEMENT_OF.items() for x in (m, s)])
    on = F.coalesce(*[F.when((F.element_at(statement, C("metric")) == s) | C("metric").isNull() & F.lit(False), C(f"{s}_page")) for s in STATEMENTS])
    rows = rows.withColumn("metric", F.when((C("tag") == "owners") & (C("_heading") == "attribution"), "net_profit_attributable").when((C("tag") == "basic") & C("_above").between(1, 4), "eps").otherwise(C("metric")))
    income = C("metric").isin("net_profit_attributable", "eps") & C("tag").isin("owners", "basic")
    rows = rows.where(C("metric").isNotNull() & (C("page_no") == F.when(income, C("income_page")).otherwise(on)) & C("current").isNotNull())
    continuing = F.lower("label").rlike(r"\b(dis)?continu(ing|ed)\b")
    share = _per_share(C("metric"))
    unit, multiplier = F.when(share, "LKR").otherwise(F.coalesce("unit", "known_unit", F.lit("unknown"))), F.when(share, 1).otherwise(F.coalesce("multiplier", "known_multiplier", F.lit(1)))
    sure = F.when(share | C("unit").isNotNull(), C("sure")).when(C("known_unit").isNotNull(), C("sure") - _lit(INHERITED)).otherwise(F.least(C("sure"), _lit(NO_UNIT)))
    # a row under a heading is taken only where no row has the label itself
    return _candidate(rows, C("metric"), C("current"), C("previous"), unit, multiplier, sure, "primary_statement", 1, [C("tag").isin("basic"), C("ord"), continuing, C("place")], source=C("label"))


def _components(rows: DataFrame, parts: Column, metric: str, of: list[str]) -> DataFrame:
    """rows with the sums of the columns `of` over the parts' rows of a document, as one row a document."""
    sums = [F.sum(F.when(parts, F.coalesce(c, F.lit(0).cast(_AMOUNT)))).alias(c) for c in of]
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "label"))), lambda x: x["label"]), " + ").alias("label")
    rest = ["unit", "multiplier", "known_unit", "known_multiplier", "lead_unit", "lead_multiplier", "page_no", "scope", "months"]
    least = F.min(F.struct("place", *rest)).alias("_one")
    out = rows.where(parts).groupBy("doc_id").agg(*sums, F.min("sure").alias("sure"), F.max(F.abs("first")).alias("largest"), F.count_distinct("tag").alias("kinds"), joined, least)
    return out.select("doc_id", *of, "sure", "largest", "kinds", "label", *[C(f"_one.{c}").alias(c) for c in rest], F.lit(metric).alias("metric"))


def _debt_on_statement(hits: DataFrame) -> DataFrame:
    rows = hits.where((C("tag") == "debt") & (C("page_no") == C("position_page")) & (C("current").isNotNull() | C("previous").isNotNull()))
    d = _components(rows, C("tag") == "debt", "total_debt", ["current", "previous"])
    unit, multiplier = F.coalesce("unit", "known_unit", F.lit("unknown")), F.coalesce("multiplier", "known_multiplier", F.lit(1))
    sure = F.least(C("sure"), _lit(COMPONENTS))
    sure = F.when(C("unit").isNotNull(), sure).when(C("known_unit").isNotNull(), sure - _lit(INHERITED)).otherwise(F.least(sure, _lit(NO_UNIT)))
    return _candidate(d, C("metric"), C("current"), C("previous"), unit, multiplier, sure, "component_sum", 1, [F.lit(0)], source=C("label"))


def _elsewhere(hits: DataFrame) -> DataFrame:
    """The first row of a metric's label on the candidate pages, for what no statement gives; of little confidence where the statement was
    found and lacks it."""
    rows = candidate_pages(hits).withColumn("metric", _tag_of("metric:")).where(C("metric").isNotNull() & C("second").isNotNull())
    share = _per_share(C("metric"))
    # what is printed in full isn't scaled by a mark elsewhere on the page
    unit, multiplier = F.coalesce("own_unit", "lead_unit", "unit"), F.coalesce("own_multiplier", "lead_multiplier", "multiplier", F.lit(1))
    multiplier = F.when(share | (F.abs("first") >= LARGE), 1).otherwise(multiplier)
    sure = F.when(share | unit.isNotNull(), _lit(SCANNED)).otherwise(_lit(NO_UNIT))
    statement = F.create_map(*[F.lit(x) for m, s in PH.STATEMENT_OF.items() for x in (m, s)])
    located = F.coalesce(*[F.when((F.element_at(statement, C("metric")) == s) & C(f"{s}_page").isNotNull(), F.lit(True)) for s in STATEMENTS], F.lit(False))
    sure = F.when(located & ~C("metric").isin(*PH.ELSEWHERE), F.least(sure, _lit(OUTSIDE))).otherwise(sure)
    return _candidate(rows, C("metric"), C("first"), C("second"), F.when(share, "LKR").otherwise(F.coalesce(unit, F.lit("unknown"))), multiplier, sure, "label_scan", 2, [C("scan_order.last"), C("scan_order.page_no"), C("place"), C("ord")], scope=F.lit("unknown"))


def _flows(hits: DataFrame) -> DataFrame:
    """Rows of unaudited pages that name the months to a date: the first two amounts to the right of the label, whatever stands to its left."""
    rows = hits.withColumn("metric", _tag_of("flow:")).where((C("kind") == "interim_statement") & C("metric").isNotNull() & C("months_to").isNotNull() & C("second").isNotNull())
    sure = F.when(C("lead_unit").isNotNull(), _lit(FLOW)).otherwise(_lit(FLOW_NO_UNIT))
    return _candidate(rows, C("metric"), C("first"), C("second"), F.coalesce("lead_unit", F.lit("unknown")), F.coalesce("lead_multiplier", F.lit(1)), sure, "interim_same_scope_columns", 3, [C("page_no"), C("place")], scope=F.lit("unknown"), months=C("months_to"))


def _stand_ins(hits: DataFrame) -> DataFrame:
    """For documents without a statement of financial position: debt and cash as sums of rows of the first page that has its headings, and the
    closing row of the retained earnings' note."""
    rows = hits.where(C("position_page").isNull() & C("second").isNotNull())
    says = lambda *words: [F.array_contains("says", w) for w in words]

    def first_page(tags: tuple[str, ...], *words: str) -> DataFrame:
        found = rows.where(C("tag").isin(*tags))
        for test in says(*words):
            found = found.where(test)
        return found.withColumn("_page", F.min("page_no").over(_doc())).where("page_no = _page")

    lone = ("lone_deposits", "lone_bank")
    debt = _components(first_page(("lone_debt",), "current liabilities", "total liabilities"), C("tag") == "lone_debt", "total_debt", ["first", "second"])
    each = top(first_page(lone, "total assets", "current assets"), ["doc_id", "tag"], [C("place").asc()])
    cash = _components(each, C("tag").isin(*lone), "cash", ["first", "second"]).where("kinds = 2")  # both parts or nothing
    note = top(rows.where((C("tag") == "earnings_close") & says("retained earnings")[0]), ["doc_id"], [C("page_no").asc(), C("place").asc()])
    unit, multiplier = F.coalesce("lead_unit", F.lit("unknown")), F.coalesce("lead_multiplier", F.lit(1))
    stated = F.when(C("lead_unit").isNotNull(), _lit(FLOW)).otherwise(_lit(SCANNED))
    made = [
        _candidate(debt, C("metric"), C("first"), C("second"), unit, F.when(C("largest") >= LARGE, 1).otherwise(multiplier), stated, "debt_component_aggregation", 4, [F.lit(0)], scope=F.lit("unknown"), source=C("label")),
        _candidate(cash, C("metric"), C("first"), C("second"), unit, multiplier, _lit(FLOW), "cash_component_aggregation", 4, [F.lit(0)], scope=F.lit("unknown"), source=C("label")),
        _candidate(note, F.lit("retained_earnings"), C("first"), C("second"), unit, multiplier, _lit(FROM_NOTE), "retained_earnings_note", 4, [F.lit(0)], scope=F.lit("unknown")),
    ]
    return made[0].unionByName(made[1]).unionByName(made[2])


def _shares(hits: DataFrame) -> DataFrame:
    rows = hits.where("tag = 'shares'")
    sure = F.element_at(F.array(*[_lit(c) for c in SHARE_CONFIDENCE]), C("ord") + 1)
    months = F.when(C("kind") != "interim_statement", 12)
    return _candidate(rows, F.lit("ordinary_shares_outstanding"), C("first"), F.lit(None), F.lit("shares"), C("own_multiplier"), sure, "ordinary_share_count", 5, [C("ord"), C("page_no"), C("place")], scope=F.lit("unknown"), months=months)


def choose(candidates: DataFrame) -> DataFrame:
    """One candidate for each metric of a document: what a statement has, else a label elsewhere. An interim report's rows right of their label
    take the place of one that isn't reliable, a stand-in that of one with less confidence."""
    kind = F.when(C("tier") <= 2, 0).otherwise(C("tier"))
    one_each = top(candidates.withColumn("_kind", kind), ["doc_id", "metric", "_kind"], [C("tier").asc(), C("order").asc()])
    base = F.max(F.when(C("_kind") == 0, C("confidence"))).over(W.partitionBy("doc_id", "metric"))
    wins = F.when(C("_kind") == 3, base.isNull() | (base < _lit(RELIABLE))).when(C("_kind") == 4, base.isNull() | (base < C("confidence"))).otherwise(True)
    return top(one_each.withColumn("_wins", wins).where("_wins"), ["doc_id", "metric"], [C("_kind").desc()]).drop("_kind", "_wins")


def _with_identities(facts: DataFrame, minority: DataFrame) -> DataFrame:
    """Total liabilities as assets less equity and the owners' equity as equity less minority interests, where a document lacks them."""
    fields = [c for c in facts.columns if c != "doc_id"]
    one = facts.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("metric", F.struct(*fields)))).alias("have")).join(minority, "doc_id", "left")
    have = lambda m: F.try_element_at("have", F.lit(m))
    assets, equity = have("total_assets"), have("total_equity")

    def derived(base: Column, metric: str, value: Column, confidence: Column, text: str) -> Column:
        new = {"metric": F.lit(metric), "value": value.cast("decimal(38,6)"), "previous_value": F.lit(None).cast("decimal(38,6)"), "confidence": confidence.cast("decimal(3,2)"), "extraction_method": F.lit("derived"), "source_text": F.lit(text)}
        return F.struct(*[new.get(c, base[c]).alias(c) for c in fields])

    least = F.least(assets["confidence"], equity["confidence"])
    more = [
        F.when(have("total_liabilities").isNull() & assets.isNotNull() & equity.isNotNull(), derived(assets, "total_liabilities", assets["value"] - equity["value"], least, "assets - equity")),
        F.when(have("ordinary_equity").isNull() & equity.isNotNull(), derived(equity, "ordinary_equity", equity["value"] - F.coalesce("minority", F.lit(0)), equity["confidence"], "equity - minority")),
    ]
    rows = one.select("doc_id", F.explode(F.concat(F.map_values("have"), F.array_compact(F.array(*more)))).alias("fact"))
    return rows.select("doc_id", "fact.*")


def extract_facts(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """pages(doc_id, page_no, text) and documents(doc_id, kind) -> one fact for each metric that a document's pages tell. Hits are stored, as the
    candidates of several kinds are made from them."""
    hits = stored(page_hits(read_pages(pages, documents)).repartition("doc_id"))
    located = stored(statements_of(page_scores(hits)).withColumnRenamed("doc_id", "_of"))
    hits = hits.join(located, C("doc_id") == C("_of")).drop("_of")
    made = _on_statements(hits)
    for more in (_debt_on_statement(hits), _elsewhere(hits), _flows(hits), _stand_ins(hits), _shares(hits)):
        made = made.unionByName(more)
    best = choose(made.where("printed is not null"))
    facts = best.select(
        "doc_id", "metric", (C("printed") * C("multiplier")).cast("decimal(38,6)").alias("value"), (C("printed_before") * C("multiplier")).cast("decimal(38,6)").alias("previous_value"), "unit", "multiplier", "confidence", "page",
        "statement_scope", "extraction_method", "source_text", "period_months",
    )
    less = top(hits.where((C("tag") == "minority") & (C("page_no") == C("position_page")) & C("current").isNotNull()), ["doc_id"], [C("place").asc()])
    return _with_identities(facts, less.select("doc_id", (C("current") * F.coalesce("multiplier", "known_multiplier", F.lit(1))).alias("minority")))


def one_off_lines(pages: DataFrame, most: int = 3) -> DataFrame:
    """(doc_id, page_no, line_no, excerpt): the first lines of each document that name a one-off item and an outcome."""
    lines = pages.select("doc_id", "page_no", F.posexplode(X.clean_lines(X.fold_quotes(F.coalesce("text", F.lit(""))))).alias("line_no", "line"))
    return first_one_offs(lines, most)


def first_one_offs(lines: DataFrame, most: int = 3, phrase: str = X.ONE_OFF_PHRASE, outcome: str = X.ONE_OFF_OUTCOME) -> DataFrame:
    """lines(doc_id, page_no, line_no, line) -> (doc_id, page_no, line_no, excerpt), most of each document at most."""
    hits = lines.where(C("line").rlike(phrase) & C("line").rlike(outcome))
    first = top(hits, ["doc_id"], [C("page_no").asc(), C("line_no").asc()], most)
    return first.select("doc_id", "page_no", "line_no", X.excerpt_around(C("line"), phrase).alias("excerpt"))
