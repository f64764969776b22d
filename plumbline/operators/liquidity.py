"""Daily snapshots: last-write-wins upsert, and summaries of the latest days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import top

C = F.col


def upsert(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row per date and ticker, the last to arrive; a later null replaces an earlier value. Both need `ord`."""
    return top(existing.unionByName(incoming), ["trading_date", "ticker"], [C("ord").desc()])


def summaries(daily: DataFrame, lookback: int = 20) -> DataFrame:
    """(ticker, average_volume, median_volume, liquidity_days, first_date, last_date) over the latest days that have a volume."""
    rows = top(daily.where("share_volume is not null"), ["ticker"], [C("trading_date").desc()], lookback)
    return rows.groupBy("ticker").agg(F.avg("share_volume").alias("average_volume"), F.median("share_volume").alias("median_volume"), F.count("*").alias("liquidity_days"), F.min("trading_date").alias("first_date"), F.max("trading_date").alias("last_date"))


def trading_date(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("trading_date"))


def price(last: str, close: str):
    """The last traded price, or the closing one where it is zero or missing."""
    return F.coalesce(F.nullif(last, F.lit(0)), C(close))


def write_snapshot(df: DataFrame, path: str) -> None:
    """One folder per trading date; dates that df has are replaced, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("trading_date").parquet(path)
