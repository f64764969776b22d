import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import liquidity as L
from plumbline.streaming import daily, versions

D = dt.date
SNAPSHOT = "trading_date date, ticker string, share_volume double, ord long"


def rows(spark, *r):
    return spark.createDataFrame(list(r), SNAPSHOT)


def held(spark, path, **how):
    return sorted(tuple(r) for r in versions.read(spark, path, SNAPSHOT, **how).collect())


def test_a_failed_batch_is_replayed_once(spark, tmp_path):
    path = str(tmp_path / "t")
    one = rows(spark, (D(2026, 1, 1), "A", 1.0, 1), (D(2026, 1, 1), "B", 5.0, 2), (D(2026, 1, 2), "A", 9.0, 3))
    assert held(spark, path) == [] and versions.merge(one, path, "s", 0)
    two = rows(spark, (D(2026, 1, 2), "A", 2.0, 4), (D(2026, 1, 3), "A", 3.0, 5), (D(2026, 1, 3), "A", 4.0, 6))

    def fail():
        raise OSError("lost")

    before = held(spark, path)
    with pytest.raises(OSError):
        versions.merge(two, path, "s", 1, before_publish=fail)
    assert held(spark, path) == before  # what was written isn't seen
    assert versions.merge(two, path, "s", 1) and not versions.merge(two, path, "s", 1)
    after = [(D(2026, 1, 1), "A", 1.0, 1), (D(2026, 1, 1), "B", 5.0, 2), (D(2026, 1, 2), "A", 2.0, 4), (D(2026, 1, 3), "A", 4.0, 6)]
    assert held(spark, path) == after and held(spark, path, dates=["2026-01-03"]) == after[3:]
    assert versions.current(spark, path)["version"] == 2 and versions.current(spark, path)["batches"] == {"s": 1}
    # the folders of dates that a batch doesn't bring stay
    assert versions.current(spark, path)["dates"]["2026-01-01"] != versions.current(spark, path)["dates"]["2026-01-02"]
    assert versions.merge(rows(spark).where("false"), path, "s", 2) and held(spark, path) == after
    versions.compact(spark, path, SNAPSHOT)
    assert len(set(versions.current(spark, path)["dates"].values())) == 1 and held(spark, path) == after
    assert versions.vacuum(spark, path) == 3 and held(spark, path) == after and not versions.merge(two, path, "s", 1)


def test_writers_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.merge(rows(spark, (D(2026, 1, 1), "A", 1.0, 1)), path, "s", 0)
    other = rows(spark, (D(2026, 1, 1), "B", 2.0, 2), (D(2026, 1, 2), "B", 3.0, 3))
    busy = []

    def meanwhile():
        if not busy:
            busy.append(versions.merge(other, path, "other", 7))

    assert versions.merge(rows(spark, (D(2026, 1, 1), "A", 4.0, 4)), path, "s", 1, before_publish=meanwhile)
    assert held(spark, path) == [(D(2026, 1, 1), "A", 4.0, 4), (D(2026, 1, 1), "B", 2.0, 2), (D(2026, 1, 2), "B", 3.0, 3)]
    assert versions.current(spark, path)["batches"] == {"s": 1, "other": 7}
    with pytest.raises(versions.Conflict):
        versions.publish(spark, path, versions.current(spark, path))
    assert not [f for f in (tmp_path / "t" / "_versions").iterdir() if not f.name.startswith("0") and not f.name.endswith(".crc")]


def plain(snapshots, lookback):
    """Batch: the last of each day, then the latest days that have a volume."""
    return L.summaries(L.upsert(snapshots.where("false"), snapshots), lookback)


@pytest.mark.parametrize("files", [1, 5])
def test_summaries_of_a_stream_equal_those_of_a_batch(spark, tmp_path, files):
    rng = random.Random(files)
    made = [(D(2026, 1, 1) + dt.timedelta(rng.randrange(12)), rng.choice("ABC"), None if rng.random() < 0.1 else float(rng.randrange(100)), i) for i in range(300)]
    made += [(D(2026, 1, 1) + dt.timedelta(i), "quiet", None, 900 + i) for i in range(3)]
    for k in range(files):
        spark.createDataFrame(made[k::files], SNAPSHOT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for lookback in (4, 20):
        got = daily.latest_days_available_now(spark, str(tmp_path / "in"), lambda s: s, lookback, files_a_batch=1)
        want = plain(spark.createDataFrame(made, SNAPSHOT), lookback).select(*got.columns)
        show = lambda df: sorted((r.ticker, round(r.average_volume, 9), r.median_volume, r.liquidity_days, r.first_date, r.last_date) for r in df.collect())
        assert show(got) == show(want)


def test_late_rows_and_emptied_days(spark, tmp_path):
    day = lambda k: D(2026, 2, 1) + dt.timedelta(k)
    for batch in ([(day(k), "A", 10.0 + k, k) for k in range(5)], [(day(1), "A", 99.0, 50), (day(4), "A", 1.0, 2)], [(day(4), "A", None, 60)], [(day(4), "A", 7.0, 59)]):
        spark.createDataFrame(batch, SNAPSHOT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    updates = daily.updates_available_now(spark, str(tmp_path / "in"), lambda s: daily.latest_days(s, 4), files_a_batch=1)
    last = updates.groupBy("ticker").agg(F.max_by(F.struct("average_volume", "first_date", "last_date"), "batch").alias("x")).first().x
    # an older row of day 4 changes nothing, a null takes it out, and day 0 stands in
    assert tuple(last) == ((10 + 99 + 12 + 13) / 4, day(0), day(3))
    assert updates.where("batch >= 0").count() <= 4


def test_state_ends(spark, tmp_path):
    """A ticker that brings nothing while the stream's days go on for the time to live starts anew."""
    day = lambda k: D(2026, 2, 1) + dt.timedelta(k)
    for batch in ([(day(0), "A", 10.0, 0), (day(0), "B", 10.0, 1)], [(day(9), "B", 30.0, 2)], [(day(10), "B", 30.0, 3)], [(day(11), "A", 50.0, 4), (day(11), "B", 30.0, 5)]):
        spark.createDataFrame(batch, SNAPSHOT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    updates = daily.updates_available_now(spark, str(tmp_path / "in"), lambda s: daily.latest_days(s, 20, "5 days"), files_a_batch=1)
    last = {r.ticker: r.x for r in updates.groupBy("ticker").agg(F.max_by(F.struct("average_volume", "liquidity_days"), "batch").alias("x")).collect()}
    assert tuple(last["A"]) == (50.0, 1) and tuple(last["B"]) == (25.0, 4)
