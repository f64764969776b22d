"""SimHash near-duplicates (operator 8).

Fingerprints are made per Arrow batch; equal fingerprints are one node from then on, so thousands of copies cost one
row. Distinct fingerprints within the radius are found exactly: with b blocks of bits and a radius r, two of them
agree in at least b - r whole blocks, so comparing within every bucket of b - r blocks misses none. Buckets are
compared in tiles with numpy exclusive-or and bit counts; tile pairs whose population counts differ beyond the
radius are skipped (a difference in population count is a lower bound of the distance).

Defined cases: null text counts as empty; fewer words than a shingle make one shingle of the whole sequence; no word
makes fingerprint zero, which links like any other; repeated rows each get a row; a null id is kept and never
chosen as a component id unless its component has no other; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, keep_one_of_each, materialize
from .graph import connected_components
from .tiles import local_roots, run_groups, tile_pairs

SEED = 42


def fingerprint(text: str, shingle: int = 4) -> int:
    """64 bits, each set if it is set in over half the XXH64 values of the word shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only ASCII letters and separators count
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    k = min(shingle, n)
    counts, total, step = np.zeros(64, np.int64), n - k + 1, 1 << 16
    digest = xxhash.xxh64_intdigest
    lo, hi = starts[:total].tolist(), (ends[k - 1 :] - 1).tolist()
    for at in range(0, total, step):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(lo[at : at + step], hi[at : at + step], strict=True)], dtype=np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > total).tolist())


def fingerprint_of(h: np.ndarray) -> int:
    """The fingerprint of hashes: a bit is set if it is in over half of them."""
    counts = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(h)).tolist())


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp): one row per document, fp the fingerprint as a signed long, text_key a hash of the text."""

    def each(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                fps = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(fps.view(np.int64))], ["doc_id", "text_key", "fp"])

    texts = id_and_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    return texts.mapInArrow(each, "doc_id long, text_key long, fp long")


def block_scheme(n: int, radius: int, pair_cost: float = 1e-3) -> tuple[int, int]:
    """(blocks, agreeing blocks) that makes the fewest copies and comparisons for n fingerprints; every choice is exact."""
    choices = [(radius + k, k) for k in range(1, 5) if radius + k <= 16]
    return min(choices, key=lambda c: comb(*c) * n * (1 + pair_cost * n / 2 ** (64 * c[1] // c[0])))


def _block_keys(fp, blocks: int, agree: int):
    edges = [64 * i // blocks for i in range(blocks + 1)]
    part = [F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
    return F.array(*[F.xxhash64(F.lit(i), *[part[b] for b in chosen]) for i, chosen in enumerate(combinations(range(blocks), agree))])


def _close_pairs(fp: np.ndarray, radius: int, tile: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all pairs of the array within the radius."""
    bits = np.bitwise_count(fp)
    order = np.argsort(bits, kind="stable")
    fp, bits = fp[order], bits[order].astype(np.int64)
    found_i, found_j = [], []
    for a in range(0, len(fp), tile):
        for b in range(a, len(fp), tile):
            if bits[b] - bits[min(a + tile, len(fp)) - 1] > radius:
                break  # sorted by population count: all later tiles are further off
            i, j = np.nonzero(np.bitwise_count(fp[a : a + tile, None] ^ fp[None, b : b + tile]) <= radius)
            keep = i + a < j + b
            found_i.append(order[i[keep] + a])
            found_j.append(order[j[keep] + b])
    return np.concatenate(found_i), np.concatenate(found_j)


def fingerprint_links(fps: DataFrame, radius: int = 4, tile_rows: int = 2048) -> DataFrame:
    """fps(fp), distinct -> edges (a, b) that connect exactly the fingerprints within the radius, as spanning stars."""
    blocks, agree = block_scheme(fps.count(), radius)
    keyed = fps.select("fp", F.explode(_block_keys(F.col("fp"), blocks, agree)).alias("key"))

    def work(table: pa.Table):
        fp = table.column(0).to_numpy()
        i, j = _close_pairs(fp.view(np.uint64), radius)
        if not len(i):
            return None
        root = local_roots(len(fp), i, j)
        child = np.flatnonzero(root != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[child]), pa.array(fp[root[child]])], ["a", "b"])

    return run_groups(tile_pairs(keyed, "key", "fp", tile_rows), ["fp"], work, "a long, b long")


def simhash_components(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id, text_key): one row per document; see the module for the defined cases. text_key is a
    hash of the text, which tells rows of one id apart."""
    rows = materialize(fingerprints(docs, shingle, id_col, text_col))
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(fingerprint_links(nodes.select("fp"), radius))
    nodes = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = nodes.groupBy("root").agg(F.min("first_id").alias("component_id")).withColumnRenamed("root", "named_root")
    nodes = nodes.join(named, nodes.root == named.named_root).select(F.col("fp").alias("node_fp"), "component_id")
    # unsigned hexadecimal of 16 digits
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(nodes, rows.fp == nodes.node_fp).select("doc_id", shown, "component_id", "text_key")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """docs without the documents that aren't the smallest doc_id of their component; of rows that repeat that id one stays.
    Rows with a null doc_id stay: they can't be named as a group's keeper."""
    texts = id_and_text(docs).where("doc_id is not null")
    placed = simhash_components(texts, shingle, radius).select("doc_id", "text_key", "component_id")
    return keep_one_of_each(docs, materialize(placed))
