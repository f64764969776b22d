"""The corpus pipeline: quality rules, near copies by shingle similarity, repeated passages, personal data, packing.

Each stage is written as Parquet and read again as the next one's input, so a lost executor never makes an earlier stage run
again. Counted as part of plumbline.llm.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import near_copies, packing, pii, quality, substring
from plumbline.llm.common import ensure_checkpoint_dir
from plumbline.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of the smallest id: candidates by SimHash fingerprints of 5-word shingles and by min-hash bands,
    verified by a similarity of 0.8."""
    return near_copies.drop_near_copies(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go from the later ones."""
    return substring.remove_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in training sequences."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("near-duplicates", near_duplicates), ("repeated passages", repeated_passages), ("personal data", personal_data), ("packing", packed)]

#: SQL can't express the packing stage (nor the tokenizer it needs). tests/llm compares what the stages call with brute-force versions, near
#: copies in the stage itself, and checks that run() is the stages in turn.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents, by way of Parquet in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
