"""The session settings that the engine is written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "plumbline", **more: str) -> SparkSession:
    """A session with SETTINGS and whatever else is given; the master comes from the environment."""
    builder = SparkSession.builder.appName(name)
    for k, v in (SETTINGS | more).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where none is named, a local session gets a temporary one; on a cluster,
    whose executors couldn't read that, it raises."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="plumbline-ckpt-"))
    return sc._jsc.sc().getCheckpointDir().get()


def materialize(df: DataFrame) -> DataFrame:
    """df, computed once and kept by a reliable checkpoint."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """df, computed once and kept as a Parquet table in the checkpoint folder: for tables of which each reader needs only some columns."""
    path = f"{checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
