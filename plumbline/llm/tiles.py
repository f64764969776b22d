"""Bounded groups for exact comparisons within buckets.

A bucket of more than `tile_rows` rows is cut into tiles by a hash of the row's id, and every pair of tiles becomes
a group of its own, so no task holds more than two tiles at once and a hot bucket is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tile_pairs(rows: DataFrame, key: str, row_id: str, tile_rows: int) -> DataFrame:
    """Adds _group (long: bucket and pair of tiles) and _side (0, 1; both tiles of a pair of one tile are 0). Rows of
    small buckets appear once, rows of a bucket of t tiles t times."""
    sizes = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > tile_rows)
    sizes = sizes.select(F.col(key).alias("_k"), F.ceil(F.col("_n") / tile_rows).cast("int").alias("_t"))
    out = rows.join(sizes, rows[key] == sizes["_k"], "left").drop("_k")
    out = out.withColumn("_tile", F.when(F.col("_t").isNull(), 0).otherwise(F.pmod(F.xxhash64(row_id, F.lit(7)), F.col("_t"))).cast("int"))
    out = out.withColumn("_other", F.explode(F.when(F.col("_t").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_t") - 1))))
    a, b = F.least("_tile", "_other"), F.greatest("_tile", "_other")
    group = F.when(F.col("_t").isNull(), F.xxhash64(key)).otherwise(F.xxhash64(key, a, b))
    return out.select(*rows.columns, group.alias("_group"), (F.col("_tile") > F.col("_other")).cast("int").alias("_side"))


def run_groups(rows: DataFrame, columns: list[str], work: Callable, schema: str) -> DataFrame:
    """Bring each _group together, sorted, and call work(list of column arrays) for each; it returns a RecordBatch or None.
    `columns` are handed over in that order after _group. A group spans Arrow batches only by being carried over."""
    dealt = rows.select("_group", *columns).repartition("_group").sortWithinPartitions("_group")

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table] = []

        def ended(table: pa.Table, last: bool):
            groups = table.column(0).to_numpy()
            if not len(groups):
                return None
            cuts = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist(), len(groups)]
            whole = cuts if last else cuts[:-1]
            for lo, hi in zip(whole[:-1], whole[1:], strict=True):
                if hi - lo > 1 and (made := work(table.slice(lo, hi - lo).select(columns))) is not None:
                    yield made
            return None if last else table.slice(whole[-1])

        last_group = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            first, final = table.column(0)[0].as_py(), table.column(0)[-1].as_py()
            kept.append(table)
            if first == final == last_group:
                continue  # the open group goes on
            rest = yield from ended(pa.concat_tables(kept).combine_chunks(), False)
            kept, last_group = [rest] if rest is not None else [], final
        if kept:
            yield from ended(pa.concat_tables(kept).combine_chunks(), True)

    return dealt.mapInArrow(each, schema)


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of 0..n-1 reaches by the pairs (i, j)."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if np.array_equal(low, root):
            return root
        root = low
