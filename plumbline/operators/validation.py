"""Identities between facts of one document: confidence is taken down where they fail, and each failure is a review row.

The rules work on one wide row per document with columns x and x_conf, rule after rule in a fixed order, as later rules read
what earlier ones changed. What a rule has to say is an event of a metric; a document's events are an array in the rules' order, and
`folded` takes a fact's state (status, notes, confidence, value, multiplier, unit) through those of its metric. `validate_facts` makes the wide
rows of long facts and brings the outcome back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratios as R
from ..functions.text import fact_id
from .ranking import top

C = F.col
CAP, GATE = 0.60, 0.80
#: Tolerances of a count against profit / EPS and against the market, of a scaled count, of book value per share.
NEAR_PROFIT, NEAR_MARKET, NEAR_SCALED, NEAR_BOOK = 0.25, 0.35, 0.05, 0.15
SCALES = (1000.0, 1000000.0)
METRICS = ("revenue", "net_profit", "net_profit_attributable", "eps", "dps", "total_assets", "total_liabilities", "total_equity", "ordinary_equity", "bvps", "ordinary_shares_outstanding")
#: The rules and the metrics that a failure of each is reported for.
RULES = (
    ("accounting_equation", ("total_assets", "total_liabilities", "total_equity")), ("profit_revenue_scale", ("revenue", "net_profit")), ("eps_profit_sign", ("eps",)), ("eps_identity", ("eps",)),
    ("share_count_identity", ("ordinary_shares_outstanding",)), ("bvps_identity", ("bvps",)), ("dps_range", ("dps",)),
)


EVENT = "struct<metric:string,kind:string,rule:string,reason:string,less:double,factor:double,unit:string>"


def _holds(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def _say(*parts: str | Column) -> Column:
    """Text with figures in it; a figure is given with its digits."""
    return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])


def _event(test: Column, metric: str, kind: str, rule: str | None, reason: Column, less: float = 0.0, factor: Column | None = None, unit: Column | None = None) -> Column:
    """An event where the test holds, else null. Kinds: warn takes `less` off the confidence, demote caps it, note only says something, rescale also
    multiplies the value; rule is null for what isn't an issue."""
    none = F.lit(None)
    parts = {"metric": F.lit(metric), "kind": F.lit(kind), "rule": F.lit(rule), "reason": reason, "less": F.lit(less), "factor": none if factor is None else factor, "unit": none if unit is None else unit}
    return F.when(_holds(test), F.struct(*[v.alias(k) for k, v in parts.items()]).cast(EVENT))


def folded(events: Column, state: dict[str, Column]) -> Column:
    """struct(status, notes, confidence, value, multiplier, unit): a fact's state after its events, one after the other."""
    kinds = {"status": "string", "notes": "string", "confidence": "double", "value": "double", "multiplier": "double", "unit": "string"}
    start = F.struct(*[state[k].cast(t).alias(k) for k, t in kinds.items()])

    def step(acc: Column, e: Column) -> Column:
        lowered = F.when(e["kind"] == "warn", F.greatest(F.lit(0.0), acc["confidence"] - e["less"])).when(e["kind"] == "demote", F.least(acc["confidence"], F.lit(CAP))).otherwise(acc["confidence"])
        return F.struct(
            F.when(e["kind"].isin("warn", "demote"), "review").otherwise(acc["status"]).alias("status"), F.concat_ws("; ", F.nullif(acc["notes"], F.lit("")), e["reason"]).alias("notes"), lowered.alias("confidence"),
            (acc["value"] * F.coalesce(e["factor"], F.lit(1.0))).alias("value"), (acc["multiplier"] * F.coalesce(e["factor"], F.lit(1.0))).alias("multiplier"), F.coalesce(e["unit"], acc["unit"]).alias("unit"),
        )

    return F.aggregate(events, start, step)


def validate(wide: DataFrame) -> DataFrame:
    """wide(id.., x and x_conf for METRICS; market_shares, null where an issuer has several share classes; optional bvps_printed,
    whether book value per share stands on the statement itself, and reconciled, whether the document's counts are compared)
    -> the same with events (in order), rules array<string>, changed confidences, and shares rescaled by shares_factor where a printed scale was missed.

    A count of shares is right if it is near any of its references: profit / EPS, as long as EPS is reliable, or the market's."""
    absent = {f"{m}{x}": F.lit(None).cast("double") for m in METRICS for x in ("", "_conf")} | {"market_shares": F.lit(None).cast("double"), "bvps_printed": F.lit(False), "reconciled": F.lit(True)}
    made = [c for c in absent if c not in wide.columns]
    d = wide.withColumns({c: absent[c] for c in made}) if made else wide
    a, e = C("total_assets"), C("total_equity")
    profit, eps, shares = F.coalesce("net_profit_attributable", "net_profit"), C("eps"), C("ordinary_shares_outstanding")
    market = F.nullif(C("market_shares").cast("double"), F.lit(0.0))
    d = d.withColumns({
        "_low": reduce(lambda x, y: x | y, [_holds(C(f"{m}_conf") < GATE) for m in METRICS]),
        "accounting_equation": _holds((a != 0) & (F.abs(a - C("total_liabilities") - e) > F.greatest(F.abs(a) * 0.05, F.lit(1.0)))),
        "profit_revenue_scale": _holds((C("revenue") != 0) & (F.abs("net_profit") > 2 * F.abs("revenue"))),
        "eps_profit_sign": _holds((eps != 0) & (profit != 0) & ((eps > 0) != (profit > 0))),
        "_market": market,
    })
    ratio = F.abs(F.try_divide(eps, F.try_divide(profit, C("_market"))))
    d = d.withColumn("eps_identity", ~C("eps_profit_sign") & _holds((eps != 0) & ~ratio.between(0.33, 3.0)))
    usable = _holds(eps.isNotNull() & (C("eps_conf") >= GATE)) & ~C("eps_profit_sign") & ~C("eps_identity")
    implied = F.try_divide(profit, eps)
    d = d.withColumns({"_usable": usable, "_implied": F.when(usable & C("reconciled") & (implied > 0), implied), "_reference": F.when(C("reconciled"), C("_market"))})
    references = ((C("_implied"), NEAR_PROFIT), (C("_reference"), NEAR_MARKET))
    matched = reduce(lambda x, y: x | y, [R.near(shares, r, t) for r, t in references])
    off = _holds(shares != 0) & (C("_implied").isNotNull() | C("_reference").isNotNull()) & ~matched
    fits = lambda k: R.near(shares * k, C("_implied"), NEAR_SCALED) | R.near(shares * k, C("_reference"), NEAR_SCALED)
    d = d.withColumn("shares_factor", F.coalesce(*[F.when(off & fits(k), k) for k in SCALES]))
    by_profit = R.near(shares * F.coalesce("shares_factor", F.lit(1.0)), C("_implied"), F.when(C("shares_factor").isNull(), NEAR_PROFIT).otherwise(NEAR_SCALED))
    d = d.withColumns({"_printed_count": shares, "_agrees": F.when(by_profit, "profit / EPS").otherwise("market value / price"), "_matched": _holds(shares != 0) & matched})
    d = d.withColumns({"share_count_identity": off & C("shares_factor").isNull(), "ordinary_shares_outstanding": shares * F.coalesce("shares_factor", F.lit(1.0))})
    count = F.when(_holds(C("ordinary_shares_outstanding_conf") >= GATE) & ~C("share_count_identity"), C("ordinary_shares_outstanding"))
    expected = F.when(_holds(C("ordinary_equity_conf") >= GATE) & C("reconciled"), F.try_divide(C("ordinary_equity"), F.coalesce(count, C("_market"))))
    d = d.withColumn("_expected", expected)
    expected = C("_expected")
    d = d.withColumn("bvps_identity", _holds((expected > 0) & C("bvps").isNotNull()) & ~R.near(C("bvps"), expected, NEAR_BOOK))
    d = d.withColumn("dps_range", _holds(C("dps") < 0) | (C("_usable") & _holds(C("dps") > F.greatest(5 * F.abs(eps), F.lit(1.0)))))
    d = d.withColumn("events", F.array_compact(F.array(*_events())))
    lowered = lambda m: folded(F.filter("events", lambda e: e["metric"] == m), {k: F.lit(None) for k in ("status", "notes", "value", "multiplier", "unit")} | {"confidence": C(f"{m}_conf")})["confidence"]
    d = d.withColumns({f"{m}_conf": lowered(m) for m in dict.fromkeys(m for _, of in RULES for m in of)})
    names = F.array_compact(F.array(F.when(C("_low"), F.lit("low_confidence")), *[F.when(C(r), F.lit(r)) for r, _ in RULES]))
    return d.withColumn("rules", names).drop("_low", "_market", "_usable", "_implied", "_reference", "_printed_count", "_agrees", "_matched", "_expected", *[r for r, _ in RULES], *made)


def _events() -> list[Column]:
    """What the rules say of a wide row, in their order."""
    figure = lambda x, digits=2: F.format_number(x, digits)
    profit, eps = F.coalesce("net_profit_attributable", "net_profit"), C("eps")
    off_by = F.abs(C("total_assets") - C("total_liabilities") - C("total_equity"))
    per_share = F.try_divide(profit, C("_market"))
    known = F.concat_ws("; ", _say("profit / EPS = ", figure(C("_implied"), 0)), _say("market value / price = ", figure(C("_reference"), 0)))
    book = _say("book value per share ", figure(C("bvps")), " differs by more than 15% from equity / shares (", figure(C("_expected")), "); ")
    scale = F.format_number("shares_factor", 0)
    shares = "ordinary_shares_outstanding"
    return [
        *[_event(C("accounting_equation"), m, "warn", "accounting_equation", _say("total assets differ from liabilities and equity by ", figure(off_by), ", more than 5%"), 0.15) for m in RULES[0][1]],
        *[_event(C("profit_revenue_scale"), m, "warn", "profit_revenue_scale", F.lit("net profit is more than twice revenue in size"), 0.12) for m in RULES[1][1]],
        _event(C("eps_profit_sign"), "eps", "demote", "eps_profit_sign", _say("EPS ", figure(eps), " and profit ", figure(profit), " differ in sign")),
        _event(C("eps_identity"), "eps", "demote", "eps_identity", _say("EPS ", figure(eps), " is ", figure(F.abs(F.try_divide(eps, per_share))), " times the profit for each share that the market counts (", figure(per_share), ")")),
        _event(C("_matched"), shares, "note", None, _say("count agrees with ", C("_agrees"))),
        _event(C("shares_factor").isNotNull(), shares, "rescale", None, _say("count was in units of ", scale, ": scaled it is within 5% of ", C("_agrees")), 0.0, C("shares_factor"), _say("shares x ", scale, " (inferred)")),
        _event(C("share_count_identity"), shares, "demote", "share_count_identity", _say("count ", figure(C("_printed_count"), 0), " agrees with none of ", known)),
        # what is printed on the statement itself stands, and is only noted
        _event(C("bvps_identity") & C("bvps_printed"), "bvps", "note", "bvps_identity", _say(book, "the one on the statement stands")),
        _event(C("bvps_identity") & ~C("bvps_printed"), "bvps", "demote", "bvps_identity", _say(book, "the calculated one is used")),
        _event(C("dps_range"), "dps", "demote", "dps_range", F.when(C("dps") < 0, "dividend per share is negative").otherwise(_say("dividend per share ", figure(C("dps")), " is over five times EPS ", figure(eps)))),
    ]


def selected_facts(facts: DataFrame) -> DataFrame:
    """The fact of each document and metric that the rules read: the one of most confidence, the first of ties; whether it has a value
    isn't asked."""
    return top(facts, ["doc_id", "metric"], [C("confidence").desc(), C("ord").asc()])


def validate_facts(facts: DataFrame, context: DataFrame) -> tuple[DataFrame, DataFrame]:
    """facts(doc_id, metric, value, confidence, ord, ..), context(doc_id, market_shares, reconciled) -> (facts with validation_status, validation_notes,
    multiplier, original_unit, changed confidences and rescaled counts; issues(doc_id, metric, ord, rule, reason)). Every fact below the gate is an
    issue; the other rules read the selected ones."""
    chosen = selected_facts(facts.where(C("metric").isin(*METRICS)))
    pick = lambda m, c: F.max(F.when(C("metric") == m, C(c)))
    printed = pick("bvps", "extraction_method").startswith("primary_") if "extraction_method" in facts.columns else F.lit(False)
    both = [pick(m, c).cast("double").alias(m + x) for m in METRICS for c, x in (("value", ""), ("confidence", "_conf"))]
    wide = chosen.groupBy("doc_id").agg(*both, *[pick(m, "ord").alias(f"{m}_ord") for m in METRICS], F.coalesce(printed, F.lit(False)).alias("bvps_printed"))
    wide = wide.join(context.select(C("doc_id").alias("_doc"), "market_shares", "reconciled"), C("doc_id") == C("_doc"), "left").drop("_doc")
    done = validate(wide.withColumn("reconciled", F.coalesce("reconciled", F.lit(False))))
    places = F.create_map(*[x for m in METRICS for x in (F.lit(m), C(f"{m}_ord"))])
    said = done.select(C("doc_id").alias("_doc"), places.alias("_places"), F.posexplode_outer("events").alias("_k", "_e"))  # outer: else a filter would be pushed through all the rules, as copies of them
    said = said.select("_doc", C("_e.metric").alias("_metric"), F.element_at("_places", C("_e.metric")).alias("_ord"), F.struct("_k", "_e").alias("_x"))
    said = said.groupBy("_doc", "_metric", "_ord").agg(F.transform(F.sort_array(F.collect_list("_x")), lambda x: x["_e"]).alias("_events"))  # a few at most
    same = (C("doc_id") == C("_doc")) & (C("metric") == C("_metric")) & (C("ord") == C("_ord"))
    conf = C("confidence").cast("double")
    low = F.array_compact(F.array(_event(conf < GATE, "", "warn", "low_confidence", _say("read with a confidence of ", F.format_number(conf, 2), ", below 0.80"))))
    put = facts.join(said, same, "left").withColumn("_events", F.concat(low, F.coalesce("_events", F.array().cast(f"array<{EVENT}>"))))
    own = lambda name, kind: C(name) if name in facts.columns else F.lit(None).cast(kind)
    start = {"status": F.coalesce(own("validation_status", "string"), F.lit("passed")), "notes": F.coalesce(own("validation_notes", "string"), F.lit("")), "confidence": conf, "value": C("value"), "multiplier": F.coalesce(own("multiplier", "double").cast("double"), F.lit(1.0)), "unit": own("original_unit", "string")}
    put = put.withColumn("_s", folded(C("_events"), start))
    kinds = dict(facts.dtypes)
    changed = F.exists("_events", lambda e: e["factor"].isNotNull())
    new = {"confidence": C("_s.confidence").cast(kinds["confidence"]), "value": F.when(changed, C("_s.value").cast(kinds["value"])).otherwise(C("value")), "validation_status": C("_s.status"), "validation_notes": C("_s.notes"), "multiplier": C("_s.multiplier").cast(kinds.get("multiplier", "double")), "original_unit": C("_s.unit")}
    out = put.select(*[new[c].alias(c) if c in new else C(c) for c in facts.columns], *[x.alias(c) for c, x in new.items() if c not in facts.columns])
    issues = put.select("doc_id", "metric", "ord", F.explode_outer("_events").alias("_e")).where("_e.rule is not null")
    return out, issues.select("doc_id", "metric", "ord", C("_e.rule").alias("rule"), C("_e.reason").alias("reason"))


def derive_identities(df: DataFrame) -> DataFrame:
    """Fills total_liabilities, ordinary_equity and total_equity from each other and minority_interest, twice, as the second pass may use
    what the first has found."""
    for _ in range(2):
        df = df.withColumn("total_liabilities", F.coalesce("total_liabilities", C("total_assets") - C("total_equity")))
        df = df.withColumn("ordinary_equity", F.coalesce("ordinary_equity", C("total_equity") - F.coalesce("minority_interest", F.lit(0.0))))
        df = df.withColumn("total_equity", F.coalesce("total_equity", F.when(C("minority_interest").isNull(), C("ordinary_equity")).otherwise(C("ordinary_equity") + C("minority_interest"))))
    return df


def with_identities(facts: DataFrame) -> DataFrame:
    """facts(doc_id, metric, value, confidence, ord, ..) and those that follow from the others of their document, with the least confidence of
    what they follow from."""
    names = ("total_assets", "total_liabilities", "total_equity", "ordinary_equity", "minority_interest")
    chosen = selected_facts(facts.where(C("metric").isin(*names) & C("value").isNotNull()))
    wide = chosen.groupBy(*[c for c in ("doc_id", "ticker") if c in facts.columns]).agg(*[F.max(F.when(C("metric") == m, C("value").cast("double"))).alias(m) for m in names], F.min("confidence").alias("confidence"), F.max("ord").alias("ord"))
    filled = derive_identities(wide.withColumns({f"_{m}": C(m) for m in names}))
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.when(C(f"_{m}").isNull(), C(m)).alias("value")) for m in names[1:4]])).alias("x")
    rows = filled.select(*[c for c in ("doc_id", "ticker", "confidence", "ord") if c in filled.columns], each).select("*", "x.*").drop("x").where("value is not null")
    kinds = dict(facts.dtypes)
    rows = rows.select(*[C(c).cast(kinds[c]).alias(c) for c in rows.columns])
    if "extraction_method" in facts.columns:
        rows = rows.withColumn("extraction_method", F.lit("derived"))
    if "fact_id" in facts.columns:
        rows = rows.withColumn("fact_id", fact_id(C("doc_id"), F.lit("derived"), C("metric")))
    return facts.unionByName(rows, allowMissingColumns=True)


def cross_period_scale(annual: DataFrame, interim: DataFrame, factor: float = 20.0) -> DataFrame:
    """Metrics whose interim amount is more than `factor` times off the annual one."""
    i = interim.select("ticker", "metric", C("value").alias("interim_value"))
    j = annual.join(i, ["ticker", "metric"])
    q = F.abs(F.try_divide(C("interim_value"), C("value")))
    return j.where((q > factor) | (q < 1 / factor)).select("ticker", "metric", "value", "interim_value")


def market_fact_record(implied: DataFrame, latest: DataFrame) -> DataFrame:
    """implied(ticker, value, confidence) and latest(ticker, doc_id) -> facts of the latest annual report, in the shape of extracted ones."""
    rows = implied.join(latest.select(C("ticker").alias("_t"), "doc_id"), C("ticker") == C("_t")).drop("_t")
    fixed = {"metric": "ordinary_shares_outstanding", "unit": "shares", "original_unit": "shares", "statement_scope": "market", "extraction_method": "cse_market_data", "validation_status": "passed", "validation_notes": "market value / price of the listed class", "source_text": "market value / price"}
    rows = rows.withColumns({k: F.lit(v) for k, v in fixed.items()} | {"multiplier": F.lit(1.0), "original_value": C("value"), "previous_value": F.lit(None).cast("double"), "page": F.lit(None).cast("int"), "ord": F.lit(1 << 41).cast("long")})
    return rows.withColumn("fact_id", fact_id(C("doc_id"), F.lit("market"), C("metric")))


def market_implied_shares(issuers: DataFrame, reported: DataFrame, classes: DataFrame) -> DataFrame:
    """(ticker, value, confidence) from market value and price, where no usable count is reported and the issuer has one share class."""
    from ..functions.ratios import implied_shares

    have = reported.where("confidence >= 0.8 and value is not null").select("ticker").distinct()
    one = classes.where("share_classes = 1").select("ticker")
    out = issuers.join(have, "ticker", "left_anti").join(one, "ticker", "left_semi")
    return out.select("ticker", implied_shares(C("market_cap"), C("price")).alias("value"), F.lit(0.85).alias("confidence")).where("value is not null")
