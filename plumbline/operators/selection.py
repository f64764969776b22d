"""Exact order statistics of groups of any size.

Ranks are found by narrowing: each round cuts the values of a group at pivots, counts what lies between them, and keeps only the stretch that
holds the wanted ranks, until a group has few different values left, or a single one. Pivots come from mergeable sketches, which bound how many
values lie between two of them, so a round keeps about one in PIVOTS values however these are distributed; counts are exact, so the
result doesn't depend on the sketches. No task holds a group: sketches and counts are aggregated before the shuffle, and values that are equal count
as one from the first narrowing on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

C = F.col
PIVOTS = 128  # stretches that a round cuts a group's values into
FEW = 10_000  # different values of a group that are ranked in a window
MAX_ROUNDS = 40


def _same(by: list[str]) -> Column:
    """Equality of groups, null being a group."""
    return reduce(Column.__and__, [C(b).eqNullSafe(C(f"_of_{b}")) for b in by])


def _renamed(df: DataFrame, by: list[str]) -> DataFrame:
    return df.withColumnsRenamed({b: f"_of_{b}" for b in by})


def _narrowed(values: DataFrame, state: DataFrame, by: list[str], pivots: int) -> DataFrame:
    """One more round: for each group the stretch between pivots that holds both of its ranks. values(by, value, weight, _x), state(by, ranks
    k1 <= k2 from 0, below: the weight of what is smaller than all values) -> (by, k1, k2, below, low, high)"""
    grid = F.percentile_approx("_x", F.array(*[F.lit(i / pivots) for i in range(1, pivots)]), 8 * pivots)
    cuts = _renamed(values.groupBy(*by).agg(grid.alias("_cuts")), by)
    at = F.aggregate("_cuts", F.lit(0), lambda n, p: n + (C("_x") > p).cast("int"))  # pivots below the value
    placed = values.join(cuts, _same(by)).select(*by, "value", "weight", at.alias("_at"))
    counted = placed.groupBy(*by, "_at").agg(F.sum("weight").alias("_w"), F.min("value").alias("_low"), F.max("value").alias("_high"))
    # at most `pivots` rows a group from here on
    upto = F.sum("_w").over(W.partitionBy(*by).orderBy("_at"))
    held = counted.withColumn("_upto", upto).join(_renamed(state, by), _same(by)).withColumn("_before", C("below") + C("_upto") - C("_w"))
    mine = held.where((C("_before") <= C("k2")) & (C("_before") + C("_w") > C("k1")))
    return mine.groupBy(*by).agg(F.first("k1").alias("k1"), F.first("k2").alias("k2"), F.min("_before").alias("below"), F.min("_low").alias("low"), F.max("_high").alias("high"))


def _place(value: Column, low: Column, kind: str) -> Column:
    """A double in the order of value: sketches hold doubles, so whole numbers and decimals are measured from the group's lowest value."""
    return value if kind in ("double", "float") else (value.cast("decimal(38,6)") - low.cast("decimal(38,6)")).cast("double")


def order_statistics(rows: DataFrame, by: list[str], value: str, lower: Column, upper: Column, few: int = FEW, pivots: int = PIVOTS) -> DataFrame:
    """rows -> (by, n, first, second): the number of values that aren't null and those of the ranks `lower` <= `upper`, expressions of n that
    count from 0. A group without values has n 0 and nulls, NaN is larger than any other value, and no rows give no groups. `few` is 2 at least and pivots 4,
    as the two ranks may lie on both sides of a pivot."""
    if not by:
        return order_statistics(rows.withColumn("_all", F.lit(0)), ["_all"], value, lower, upper, few, pivots).drop("_all")
    rows = materialize(rows.select(*by, C(value).alias("value")))
    kind = dict(rows.dtypes)["value"]
    groups = materialize(rows.groupBy(*by).agg(F.count("value").alias("n"), F.min("value").alias("low")).withColumns({"k1": lower.cast("long"), "k2": upper.cast("long"), "below": F.lit(0).cast("long")}))
    values = rows.where("value is not null").withColumn("weight", F.lit(1).cast("long"))
    state, parts = groups.where("n > 0").select(*by, "k1", "k2", "below", "low", C("n").alias("_left")), []
    for _ in range(MAX_ROUNDS):
        large = state.where(C("_left") > few)
        if large.isEmpty():
            break
        parts.append((values, state.where(C("_left") <= few)))
        mine = values.join(_renamed(large.select(*by, C("low").alias("_base")), by), _same(by)).select(*by, "value", "weight", _place(C("value"), C("_base"), kind).alias("_x"))
        new = materialize(_narrowed(mine, large.drop("_left", "low"), by, pivots))
        bounds = _renamed(new.select(*by, "low", "high"), by)
        values = mine.join(bounds, _same(by)).where((C("value") >= C("low")) & (C("value") <= C("high")))
        values = materialize(values.groupBy(*by, "value").agg(F.sum("weight").alias("weight")))
        left = _renamed(values.groupBy(*by).agg(F.count("*").alias("_left")), by)
        state = materialize(new.join(left, _same(by)).select(*by, "k1", "k2", "below", "low", "_left"))
    else:
        raise RuntimeError(f"ranks were not found in {MAX_ROUNDS} rounds")
    parts.append((values, state))
    found = None
    for own, of in parts:
        ranked = own.join(_renamed(of.drop("_left", "low"), by), _same(by)).groupBy(*by, "value", "k1", "k2", "below").agg(F.sum("weight").alias("weight"))
        upto = C("below") + F.sum("weight").over(W.partitionBy(*by).orderBy("value"))  # at most `few` rows a group
        ranked = ranked.withColumn("_upto", upto).withColumn("_before", C("_upto") - C("weight"))
        has = lambda k: (C("_before") <= C(k)) & (C("_upto") > C(k))
        part = ranked.where(has("k1") | has("k2")).groupBy(*by).agg(F.max(F.when(has("k1"), C("value"))).alias("first"), F.max(F.when(has("k2"), C("value"))).alias("second"))
        found = part if found is None else found.unionByName(part)
    found = _renamed(found, by)
    return groups.select(*by, "n").join(found, _same(by), "left").select(*by, "n", "first", "second")


def exact_medians(rows: DataFrame, by: list[str], value: str, few: int = FEW, pivots: int = PIVOTS) -> DataFrame:
    """(by, median, observations): the median of the values that aren't null, the mean of the middle two of an even number."""
    found = order_statistics(rows, by, value, F.floor((C("n") - 1) / 2), F.floor(C("n") / 2), few, pivots)
    middle = F.when(C("first") == C("second"), C("first").cast("double")).otherwise(C("first").cast("double") * 0.5 + C("second").cast("double") * 0.5)
    return found.select(*by, middle.alias("median"), C("n").alias("observations"))


def exact_upper_medians(rows: DataFrame, by: list[str], value: str, few: int = FEW, pivots: int = PIVOTS) -> DataFrame:
    """(by, median, observations): the middle value, the upper one of two."""
    found = order_statistics(rows, by, value, F.floor(C("n") / 2), F.floor(C("n") / 2), few, pivots)
    return found.select(*by, C("second").alias("median"), C("n").alias("observations"))
