"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word pattern of the contracts: everything but space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
#: Text that is turned into Python objects at a time.
SLICE_BYTES = 4 << 20


def words_of(text: str) -> list[str]:
    """The matches of WORD: bytes.split() cuts at exactly the separators that WORD leaves out."""
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder that the cluster names in spark.checkpoint.dir. Where none is named, a local session gets a temporary one;
    on a cluster, whose executors couldn't read that, it raises."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="plumbline-ckpt-"))


#: Spark's setting by which the shuffle files of a query go as soon as it has ended.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so a lost executor doesn't make earlier stages run again. What was shuffled on the way
    is in the checkpoint and no longer needed: its files go at once, so the disk holds one step's shuffles at a time."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(RELEASE)
    spark.conf.set(RELEASE, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # select: the setting is read where a DataFrame is made
    finally:
        spark.conf.set(RELEASE, before)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that an operator reads, null texts as empty; further columns, whatever their names, stay out of the plan."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def slices(batches: Iterable[pa.RecordBatch], text: int = 1) -> Iterator[pa.RecordBatch]:
    """Batches in parts of about SLICE_BYTES of text; a longer text is a part of its own."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False)) if batch.num_rows else []
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            n = max(1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")) - at)
            yield batch.slice(at, n)
            at += n


def text_slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of (doc_id, text) batches in short slices: a batch of long texts isn't turned into Python strings at once."""
    for batch in slices(batches):
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield part.column(0).to_pylist(), part.column(1).to_pylist()


class BoundedCache(dict):
    """A dict that is emptied when it holds `limit` entries; for per-worker memos over an open vocabulary."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit = limit

    def room_for(self, n: int) -> None:
        if len(self) + n > self.limit:
            self.clear()


def keep_one_of_each(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """docs without the rows that aren't the keeper of their component. placed(doc_id, text_key, component_id) has a row for each
    of docs with an id, text_key being xxhash64 of the text. The keeper has the component's smallest doc_id, and of rows of that
    id the smallest text_key; of rows equal in both, any one stays. Rows of a null id stay."""
    keepers = placed.where("doc_id = component_id").groupBy("component_id").agg(F.min("text_key").alias("keeper")).withColumnRenamed("component_id", "_component")
    judged = placed.join(keepers, placed.component_id == keepers["_component"])
    doomed = judged.where("doc_id <> component_id or text_key <> keeper").select(F.col("doc_id").alias("_gone"), F.col("text_key").alias("_gone_text")).distinct()
    text_key = F.xxhash64(F.coalesce(docs.text.cast("string"), F.lit("")))
    kept = docs.join(doomed, (docs.doc_id == doomed["_gone"]) & (text_key == doomed["_gone_text"]), "left_anti")
    copies = placed.groupBy("doc_id", "text_key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("_again"), F.col("text_key").alias("_again_text"))
    if copies.isEmpty():
        return kept
    # only rows that repeat both id and text are brought together, after a partial aggregation
    at = (kept.doc_id == copies["_again"]) & (F.xxhash64(F.coalesce(kept.text.cast("string"), F.lit(""))) == copies["_again_text"])
    repeated = kept.select(F.struct(*kept.columns).alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_text"))
    repeated = repeated.join(copies, (F.col("_id") == F.col("_again")) & (F.col("_text") == F.col("_again_text")), "left_semi")
    one = repeated.groupBy("_id", "_text").agg(F.first("_row").alias("_row")).select("_row.*")
    return kept.join(copies, at, "left_anti").unionByName(one)
