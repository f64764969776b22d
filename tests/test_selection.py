import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import selection as SL


def groups_of(rng):
    """Groups with ties, nulls, even and odd counts, one value, none, and far outliers."""
    made = {"even": [rng.gauss(0, 1) for _ in range(400)], "odd": [rng.gauss(0, 1) for _ in range(401)], "ties": [float(rng.randrange(3)) for _ in range(500)], "one": [7.5], "two": [1.0, 2.0], "none": [None] * 5,
            "hot": [5.0] * 600 + [rng.random() for _ in range(600)], "half": [1.0] * 300 + [2.0] * 300, "wide": [10.0 ** rng.randrange(-300, 300) for _ in range(501)], "nulls": [None if rng.random() < 0.4 else rng.random() for _ in range(333)], None: [float(i) for i in range(90)]}
    rows = [(g, v) for g, vs in made.items() for v in vs]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("few,pivots", [(10_000, 128), (40, 8), (2, 16)])
def test_medians_equal_the_built_in_ones(spark, few, pivots):
    rows = spark.createDataFrame(groups_of(random.Random(few)), "g string, v double").repartition(7)
    want = {r.g: (r.m, r.n) for r in rows.groupBy("g").agg(F.median("v").alias("m"), F.count("v").alias("n")).collect()}
    assert {r.g: (r["median"], r.observations) for r in SL.exact_medians(rows, ["g"], "v", few, pivots).collect()} == want
    whole = rows.agg(F.median("v").alias("m"), F.count("v").alias("n")).first()
    assert [tuple(r) for r in SL.exact_medians(rows, [], "v", few, pivots).collect()] == [(whole.m, whole.n)]


@pytest.mark.parametrize("few", [10_000, 30])
def test_upper_medians_keep_their_type(spark, few):
    rng = random.Random(4)
    rows = [(i % 5, j % 2, (1 << 60) + rng.randrange(50)) for i in range(5) for j in range(200 + i)]
    table = spark.createDataFrame(rows, "a int, b int, v long")
    want = {}
    for a, b, v in rows:
        want.setdefault((a, b), []).append(v)
    got = SL.exact_upper_medians(table, ["a", "b"], "v", few, 8)
    assert dict(got.dtypes)["median"] == "bigint"
    assert {(r.a, r.b): (r["median"], r.observations) for r in got.collect()} == {k: (sorted(v)[len(v) // 2], len(v)) for k, v in want.items()}


def test_any_rank(spark):
    rng = random.Random(9)
    values = [rng.randrange(1000) for _ in range(3000)]
    table = spark.createDataFrame([("x", v) for v in values], "g string, v int")
    for q in (0.0, 0.01, 0.25, 0.9, 1.0):
        k = F.floor((F.col("n") - 1) * F.lit(q))
        r = SL.order_statistics(table, ["g"], "v", k, k, 50, 16).first()
        assert r.first == r.second == sorted(values)[int((len(values) - 1) * q)]


def test_a_large_group_is_spread(spark):
    """Two million values in one group: no window gets more than `few` of them, and the exchanges carry only what is left."""
    table = spark.range(2_000_000).select(F.lit("g").alias("g"), (F.xxhash64("id") % 1_000_003).alias("v"))
    seen = []
    original = SL._narrowed

    def watched(values, state, by, pivots):
        seen.append(values.count())
        return original(values, state, by, pivots)

    SL._narrowed = watched
    try:
        got = SL.exact_medians(table, ["g"], "v", few=1000).first()
    finally:
        SL._narrowed = original
    assert got["median"] == table.agg(F.median("v")).first()[0] and got.observations == 2_000_000
    assert seen[0] == 2_000_000 and all(n < 60_000 for n in seen[1:]) and len(seen) == 2


def test_no_rows(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert SL.exact_medians(empty, ["g"], "v").count() == 0 == SL.exact_medians(empty, [], "v").count()
