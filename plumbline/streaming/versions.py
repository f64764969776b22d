"""A table of daily snapshots that changes by versions.

Data folders are written once and never changed. A version is one small file that names, for each date, the folder that holds it, and the last batch of
each stream that went in; it appears by a rename that fails where another writer was faster, who is then followed. So a failure before the rename
leaves the table as it was, a batch that is replayed after it is recognised, and readers of a version aren't disturbed.
A version grows with the number of dates, not of rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.liquidity import upsert

DATE, FOLDER = "trading_date", "_date"
EMPTY = {"version": 0, "dates": {}, "batches": {}}


class Conflict(RuntimeError):
    """Another writer has made the version that was to be made."""


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, path: str) -> dict:
    """The latest version of the table; EMPTY where there's none."""
    jvm, place, fs = _files(spark, f"{path}/_versions")
    if not fs.exists(place):
        return EMPTY
    names = sorted(s.getPath().getName() for s in fs.listStatus(place) if s.getPath().getName().endswith(".json"))
    if not names:
        return EMPTY
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(place, names[-1]))
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, version: dict) -> None:
    """Make a version appear, whole or not at all; raises Conflict where its number is taken."""
    jvm, place, fs = _files(spark, f"{path}/_versions")
    fs.mkdirs(place)
    made = jvm.org.apache.hadoop.fs.Path(place, f".{uuid.uuid4().hex}")
    out = fs.create(made)
    out.write(bytearray(json.dumps(version, sort_keys=True).encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    target = jvm.org.apache.hadoop.fs.Path(place, f"{version['version']:020d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(made), fs.makeQualified(target), options)
    except Exception as e:
        fs.delete(made, False)
        if "FileAlreadyExistsException" in str(e):
            raise Conflict(f"version {version['version']} of {path}") from None
        raise


def read(spark: SparkSession, path: str, schema, version: dict | None = None, dates: list[str] | None = None) -> DataFrame:
    """The rows of a version, of some dates only if they are given."""
    version = current(spark, path) if version is None else version
    folders = [f"{path}/{folder}/{FOLDER}={d}" for d, folder in sorted(version["dates"].items()) if dates is None or d in dates]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _written(rows: DataFrame, path: str) -> str:
    """rows as a new data folder, one part of it for each date."""
    folder = f"data-{uuid.uuid4().hex}"
    dealt = rows.withColumn(FOLDER, F.date_format(DATE, "yyyy-MM-dd")).repartition(FOLDER)
    dealt.write.partitionBy(FOLDER).parquet(f"{path}/{folder}")
    return folder


def merge(batch: DataFrame, path: str, stream: str, number: int, before_publish: Callable[[], None] | None = None, tries: int = 10) -> bool:
    """Put a batch of snapshots into the table: of a date and ticker the last row, by `ord`, counts. Only the dates that the batch brings are read and written
    again. False if the batch is in already. before_publish is called between writing and publishing, for tests."""
    spark = batch.sparkSession
    for _ in range(tries):
        version = current(spark, path)
        if version["batches"].get(stream, -1) >= number:
            return False
        dates = [r[0] for r in batch.select(F.date_format(DATE, "yyyy-MM-dd")).distinct().collect()]
        changed = {}
        if dates:
            folder = _written(upsert(read(spark, path, batch.schema, version, dates), batch), path)
            changed = dict.fromkeys(dates, folder)
        if before_publish:
            before_publish()
        try:
            publish(spark, path, {"version": version["version"] + 1, "dates": version["dates"] | changed, "batches": version["batches"] | {stream: number}})
            return True
        except Conflict:
            continue  # on the version that the other writer made
    raise Conflict(f"{path}: {tries} versions were made by others meanwhile")


def compact(spark: SparkSession, path: str, schema) -> None:
    """All dates into one data folder with a file a date, as a new version."""
    version = current(spark, path)
    if version["dates"]:
        folder = _written(read(spark, path, schema, version), path)
        publish(spark, path, version | {"version": version["version"] + 1, "dates": dict.fromkeys(version["dates"], folder)})


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete data folders and versions that the latest one doesn't need; only while nobody writes or reads older versions. Returns how many folders went."""
    version = current(spark, path)
    jvm, place, fs = _files(spark, path)
    if not fs.exists(place):
        return 0
    needed, gone = set(version["dates"].values()), 0
    for s in fs.listStatus(place):
        name = s.getPath().getName()
        if name.startswith("data-") and name not in needed:
            fs.delete(s.getPath(), True)
            gone += 1
    for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(place, "_versions")):
        if s.getPath().getName() != f"{version['version']:020d}.json":
            fs.delete(s.getPath(), False)
    return gone
