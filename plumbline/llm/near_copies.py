"""Near copies by the similarity of word shingles: SimHash near-dedup (operator 8) with a similarity, the corpus pipeline's stage.

Two documents are near copies if the sets of their 5-word shingles have a Jaccard similarity of 0.8 at least. Documents of
equal sets are one node from then on. Candidates are, first, nodes whose SimHash fingerprints of 5-word shingles differ in 4 bits at
most, by simhash's exact comparison of tiles. Two sets of similarity 0.8 differ in about 10 of 64 bits, a distance that
unrelated texts of a large corpus have too, so nodes that agree in one of 20 bands of 5 min-hashes are candidates as well, which
a pair of similarity s does with probability 1 - (1 - s^5)^20: 0.9996 at 0.8. Candidates are joined to components first, so that each
node's set travels once and not once a band, and all pairs of such a component are then compared by their exact sets:

1. within tiles of bounded size;
2. between tiles, one node for each group of step 1. A large group of near copies is one group after that;
3. between all tiles of those components that still have more than one group. No pair of them goes uncompared.

Sets hold 32 bits of each shingle's hash.

Defined cases: null text counts as empty; fewer words than a shingle make one shingle of the whole sequence; documents
without a word are copies of each other; rows of a null id are kept and not compared; further columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, keep_one_of_each, materialize
from .graph import connected_components
from .simhash import fingerprint_links, fingerprint_of
from .substring import _mixed, shingle_hashes
from .tiles import run_groups, tile_pairs

SHINGLE, SIMILARITY, RADIUS, BANDS, ROWS, TILE_ROWS = 5, 0.8, 4, 20, 5, 256
_STEPS = np.random.default_rng(20).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of the word shingles, sorted."""
    h = np.unique(shingle_hashes(text, shingle))
    if len(h):
        return h
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)] if words else [], np.uint64)


def _set_id(h: np.ndarray) -> int:
    return int(np.array([xxhash.xxh64_intdigest(h.tobytes())], np.uint64).view(np.int64)[0])


def band_keys(h: np.ndarray) -> np.ndarray:
    """One key for each band of min-hashes."""
    if not len(h):
        return np.arange(BANDS, dtype=np.int64)
    low = np.empty(BANDS * ROWS, np.uint64)
    for k, step in enumerate(_STEPS):
        g = h * step
        g ^= g >> np.uint64(32)
        g *= np.uint64(0xBF58476D1CE4E5B9)
        low[k] = g.min()
    key = np.arange(BANDS, dtype=np.uint64)
    for row in low.reshape(BANDS, ROWS).T:
        key = _mixed(key ^ row, 4)
    return key.view(np.int64)


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, node, fp, bands): node names the document's set of shingles, fp is its fingerprint."""

    def each(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t) for t in part.column(1).to_pylist()]
                bands = pa.array([band_keys(h) for h in sets], pa.list_(pa.int64()))
                fps = np.array([fingerprint_of(h) for h in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([_set_id(h) for h in sets], pa.int64()), pa.array(fps), bands], ["doc_id", "text_key", "node", "fp", "bands"])

    texts = id_and_text(docs).where("doc_id is not null").withColumn("text_key", F.xxhash64("text"))
    return texts.mapInArrow(each, "doc_id long, text_key long, node long, fp long, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted(node, root, first_id) -> (node, root, shingles)."""

    def each(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [(i, shingle_set(t)) for i, t in enumerate(part.column(2).to_pylist())]
                # rows that repeat an id may differ in text
                node = part.column(0).to_pylist()
                own = [(i, h) for i, h in sets if _set_id(h) == node[i]]
                if own:
                    keep = pa.array([i for i, _ in own])
                    shingles = pa.array([np.unique(h.astype(np.uint32)).tobytes() for _, h in own], pa.binary())
                    yield pa.RecordBatch.from_arrays([part.column(0).take(keep), part.column(1).take(keep), shingles], ["node", "root", "shingles"])

    texts = id_and_text(docs).join(wanted, F.col("doc_id") == F.col("first_id")).select("node", "root", "text")
    return texts.mapInArrow(each, "node long, root long, shingles binary").dropDuplicates(["node"])


def similar_groups(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each set the first of those it is joined with by a chain of pairs of that similarity. A set found is compared with those
    not yet found only, which leaves the groups as they are and makes a group of copies cost its length."""
    n, size = len(sets), np.array([len(s) for s in sets])
    root = np.full(n, -1)
    values, code = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.concatenate(([0], np.cumsum(size)))
    owner = np.repeat(np.arange(n), size)

    def postings(alive: np.ndarray):
        keep = alive[owner]
        c, o = code[keep], owner[keep]
        order = np.argsort(c, kind="stable")
        return o[order], np.concatenate(([0], np.cumsum(np.bincount(c, minlength=len(values)))))

    lists, starts = postings(np.ones(n, bool))
    left = indexed = n
    for seed in range(n):
        if root[seed] >= 0:
            continue
        root[seed], queue = seed, [seed]
        left -= 1
        while queue and left:
            q = queue.pop()
            if 2 * left < indexed:
                lists, starts = postings(root < 0)
                indexed = left
            mine = code[begin[q] : begin[q + 1]]
            lo, many = starts[mine], starts[mine + 1] - starts[mine]
            at = np.repeat(lo - np.concatenate(([0], np.cumsum(many)[:-1])), many) + np.arange(many.sum())
            both = np.bincount(lists[at], minlength=n)
            new = np.flatnonzero((root < 0) & (both >= similarity * (size + size[q] - both) - 1e-9) & (both > 0))
            root[new] = seed
            queue += new.tolist()
            left -= len(new)
    return root


def _links(rows: DataFrame, similarity: float) -> DataFrame:
    """rows(_group, node, shingles) -> edges (a, b)."""

    def work(table: pa.Table):
        node = table.column(0).to_numpy()
        root = similar_groups([np.frombuffer(s, np.uint32) for s in table.column(1).to_pylist()], similarity)
        child = np.flatnonzero(root != np.arange(len(node)))
        return pa.RecordBatch.from_arrays([pa.array(node[child]), pa.array(node[root[child]])], ["a", "b"]) if len(child) else None

    return run_groups(rows, ["node", "shingles"], work, "a long, b long")


def _by_fingerprint(nodes: DataFrame) -> DataFrame:
    """nodes(node, fp) -> edges (a, b) between nodes of equal fingerprints and of those within the radius."""
    heads = materialize(nodes.groupBy("fp").agg(F.min("node").alias("head")))
    own = heads.select(F.col("fp").alias("_fp"), "head")
    equal = nodes.join(own, nodes.fp == own["_fp"]).where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    links = fingerprint_links(heads.select("fp"), RADIUS)
    one, two = heads.select(F.col("fp").alias("_a"), F.col("head").alias("_head_a")), heads.select(F.col("fp").alias("_b"), F.col("head").alias("_head_b"))
    near = links.join(one, links.a == one["_a"]).join(two, links.b == two["_b"]).select(F.col("_head_a").alias("a"), F.col("_head_b").alias("b"))
    return equal.unionByName(near)


def _grouped(sets: DataFrame, edges: DataFrame) -> DataFrame:
    """sets with `part`, the smallest node of the group that the edges make."""
    parts = connected_components(edges).select(F.col("node").alias("_node"), F.col("root").alias("_part"))
    return sets.join(parts, sets.node == parts["_node"], "left").select(*sets.columns, F.coalesce("_part", "node").alias("part"))


def near_copy_components(docs: DataFrame, similarity: float = SIMILARITY, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, text_key, component_id) of the rows that have an id: the smallest doc_id that a chain of near copies joins each with.
    text_key is a hash of the text, which tells rows of one id apart."""
    rows = materialize(_rows(docs))
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    heads = keyed.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("_key"), "head")
    candidates = keyed.join(heads, keyed.key == heads["_key"]).where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    candidates = candidates.unionByName(_by_fingerprint(nodes.select("node", "fp")))
    found = connected_components(candidates)
    wanted = found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())
    firsts = nodes.select(F.col("node").alias("_node"), "first_id")
    sets = materialize(_sets(docs, wanted.join(firsts, wanted.node == firsts["_node"]).select("node", "root", "first_id")))

    sizes = sets.groupBy("root").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("_t")).withColumnRenamed("root", "_root")
    tiled = sets.join(sizes, sets.root == sizes["_root"]).withColumn("_group", F.xxhash64("root", F.pmod(F.xxhash64("node", F.lit(7)), F.col("_t"))))
    edges = materialize(_links(tiled, similarity))
    one_each = _grouped(sets, edges).where("node = part").select("node", "root", "shingles")
    edges = materialize(edges.unionByName(_links(tile_pairs(one_each, "root", "node", tile_rows), similarity)))
    parts = materialize(_grouped(sets.select("node", "root"), edges))
    # components of one tile were compared whole in step 1
    open_roots = parts.groupBy("root").agg(F.count_distinct("part").alias("_parts"), F.count("*").alias("_n")).where(f"_parts > 1 and _n > {tile_rows}").select(F.col("root").alias("_open"))
    rest = sets.join(open_roots, sets.root == open_roots["_open"], "left_semi")
    edges = edges.unionByName(_links(tile_pairs(rest, "root", "node", tile_rows), similarity))

    named = connected_components(edges).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    placed = nodes.select("node", "first_id").join(named, F.col("node") == F.col("_node"), "left").select("node", "first_id", F.coalesce("_root", "node").alias("part"))
    least = placed.groupBy("part").agg(F.min("first_id").alias("component_id")).withColumnRenamed("part", "_part")
    placed = placed.join(least, placed.part == least["_part"]).select(F.col("node").alias("_of"), "component_id")
    return rows.join(placed, rows.node == placed["_of"]).select("doc_id", "text_key", "component_id")


def drop_near_copies(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs without the documents that aren't the smallest doc_id of their component; of rows that repeat that id one stays. Rows with a
    null doc_id stay."""
    return keep_one_of_each(docs, materialize(near_copy_components(docs, similarity)))
