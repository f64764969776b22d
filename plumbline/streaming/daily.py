"""Daily aggregates of a stream of trades, with the semantics of the batch upsert."""

from __future__ import annotations

import datetime as dt
import statistics
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..session import checkpoint_folder
from . import versions


def daily_counts(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Trades per ticker and day of a stream (ts, user_id). In update or append mode, the state of a day goes once the watermark has passed its end;
    events that are later than `late` allows for are dropped then."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return e.groupBy(F.window("ts", "1 day").alias("w"), F.col("user_id")).agg(F.count("*").alias("trade_count")).select(F.col("user_id").alias("ticker"), F.to_date("w.start").alias("trading_date"), "trade_count")


def merged_counts(updates: DataFrame) -> DataFrame:
    """updates(batch, ticker, trading_date, trade_count) -> the last count of each ticker and day."""
    return updates.groupBy("ticker", "trading_date").agg(F.max_by("trade_count", "batch").alias("trade_count"))


def updates_available_now(spark: SparkSession, path: str, transform: Callable[[DataFrame], DataFrame], files_a_batch: int | None = None) -> DataFrame:
    """Reads what is there as a stream and returns what transform() emits in update mode, with the number of its batch. Each micro-batch writes to a folder of its
    own, so a repeated batch changes nothing."""
    folder = f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"
    # a file of the source is matched by its name in its folder, so that a table may be one file or a folder of files
    parent, _, name = path.rpartition("/")
    schema = spark.read.parquet(path).schema
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    single = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop).isFile()
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else reader
    source = reader.option("pathGlobFilter", name).parquet(parent) if single else reader.parquet(path)
    made = transform(source)

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    spark.createDataFrame([], made.schema).write.parquet(f"{folder}/out/batch=-1")  # a source without rows has no batch
    made.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def daily_counts_available_now(spark: SparkSession, path: str) -> DataFrame:
    """The counts of each ticker and day; of what several batches say of a day the last."""
    return merged_counts(updates_available_now(spark, path, daily_counts))


def upsert_stream(source: DataFrame, path: str, checkpoint: str, stream: str | None = None):
    """Snapshots into a versioned table: in a batch the last of a date and ticker wins over what the table has. A batch that is replayed after a failure
    goes in once. `stream` names the stream in the table's versions, by its checkpoint if it isn't given."""
    name = stream or checkpoint

    def put(batch: DataFrame, number: int) -> None:
        versions.merge(batch, path, name, number)

    return source.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)


# ---- a summary of the latest days, as it changes ----
SUMMARY = "ticker string, average_volume double, median_volume double, liquidity_days long, first_date date, last_date date"
_STATE = "days array<int>, ords array<long>, volumes array<double>"
_DAY_0 = dt.date(1970, 1, 1)


def latest_days(snapshots: DataFrame, lookback: int = 20, time_to_live: str = "90 days") -> DataFrame:
    """snapshots(trading_date, ticker, share_volume, ord), a stream -> the summary of each ticker's latest `lookback` days that have a volume, emitted as it changes, for
    update mode. Of a day the row of the highest ord counts, whenever it arrives; a null volume takes the day out. The state of a ticker is at most
    twice `lookback` days, so what is later than that changes nothing, and it ends when the stream's days are time_to_live past its last one; rows
    that are as late as that are dropped."""
    kept = 2 * lookback

    def advance(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        days = {d: (o, v) for d, o, v in zip(*state.get, strict=True)} if state.exists else {}
        before = _summary(key[0], days, lookback)
        for part in parts:
            for d, o, v in zip(part["day"].tolist(), part["ord"].tolist(), part["share_volume"].tolist(), strict=True):
                if d not in days or o >= days[d][0]:
                    days[d] = (o, v)
        days = dict(sorted(days.items())[-kept:])
        state.update((list(days), [o for o, _ in days.values()], [v for _, v in days.values()]))
        # the watermark is time_to_live behind the stream's days
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), max(days) * 86_400_000) + 1)
        after = _summary(key[0], days, lookback)
        if after is not None and after != before:
            yield pd.DataFrame([after], columns=["ticker", "average_volume", "median_volume", "liquidity_days", "first_date", "last_date"])

    rows = snapshots.select("ticker", F.datediff("trading_date", F.lit(_DAY_0)).alias("day"), F.col("ord").cast("long").alias("ord"), F.coalesce(F.col("share_volume").cast("double"), F.lit(float("nan"))).alias("share_volume"), F.col("trading_date").cast("timestamp").alias("at"))
    return rows.withWatermark("at", time_to_live).groupBy("ticker").applyInPandasWithState(advance, SUMMARY, _STATE, "update", GroupStateTimeout.EventTimeTimeout)


def _summary(ticker: str, days: dict, lookback: int) -> tuple | None:
    have = [(d, v) for d, (_, v) in sorted(days.items()) if v == v][-lookback:]
    if not have:
        return None
    volumes = [v for _, v in have]
    return ticker, sum(volumes) / len(volumes), statistics.median(volumes), len(volumes), _DAY_0 + dt.timedelta(have[0][0]), _DAY_0 + dt.timedelta(have[-1][0])


def latest_days_available_now(spark: SparkSession, path: str, snapshots: Callable[[DataFrame], DataFrame], lookback: int = 20, files_a_batch: int | None = None) -> DataFrame:
    """latest_days() over what is there: the last summary of each ticker."""
    updates = updates_available_now(spark, path, lambda source: latest_days(snapshots(source), lookback), files_a_batch)
    names = [c for c in updates.columns if c not in ("batch", "ticker")]
    return updates.groupBy("ticker").agg(F.max_by(F.struct(*names), "batch").alias("x")).select("ticker", "x.*")
