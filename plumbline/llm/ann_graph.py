"""Approximate nearest neighbours by largest inner product (operator 11): a robust-pruned directed graph for each shard.

Vectors of a shard get one more component that makes all of them equally long, so that largest inner product and smallest distance are the
same order. The graph is grown in batches: a greedy beam search over the graph so far proposes neighbours of each new vector; pruning keeps the nearest
one and drops those that are closer to it, by the relaxed distance, than to the vector, and so on, so the edges that are kept are diverse. A second pass
over all vectors searches the whole graph: without it, vectors of very different length are found too seldom (0.94 of the nearest 20 instead of 0.99).
Edges go back as well, and a node with too many is pruned again. All searches and prunings of a batch run in step as arrays.

Shards are cells of k-means, fitted on a bounded sample, cut by a hash beyond `shard_rows`. A beam search queries each shard of the cells
nearest to the query. How many cells these are is measured on the sample: as few as hold `coverage` of the neighbours of sampled queries there, all of
them for vectors without clusters. Sampled neighbours are farther away than those among all rows, so this errs to the safe side.
Equal vectors are one node of a graph with its least members listed, and equal queries are searched once; scores are computed again
in double precision from the original vectors.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part; only vectors of the query's length are its
candidates; rows that repeat an id are queries and candidates of their own, only a query's own row isn't its candidate; a null
id is no query, as a candidate it comes last among ties; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

DEGREE, BEAM, SEARCH_BEAM, EXPAND, RELAX = 32, 96, 128, 4, 1.2
SHARD_ROWS = 8192
EXACT_ROWS = 256  # shards of no more rows are compared whole
SAMPLE_ROWS, SAMPLE_QUERIES, CELLS = 20_000, 256, 2_000
QUERY_BLOCK = 10_000  # queries that a task has at a time
STEP_ROWS = 256  # searches that run in step
STARTS = 32


def augmented(v: np.ndarray) -> np.ndarray:
    """Rows of equal length 1, by which distances are in the order of inner products with any query."""
    x = v / np.abs(v).max()
    squares = np.einsum("ij,ij->i", x, x)
    top = squares.max()
    return np.concatenate((x, np.sqrt(np.maximum(0, top - squares))[:, None]), axis=1) / np.sqrt(top)


def beam_search(x: np.ndarray, links: np.ndarray, q: np.ndarray, starts: np.ndarray, beam: int = BEAM, expand: int = EXPAND) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, products) of each query, best first: in each step a query opens the `expand` best nodes of its beam that are still closed. Missing: -1."""
    n, rows = len(x), len(q)
    seen = np.zeros((rows, n + 1), bool)
    seen[:, n] = True
    seen[:, starts] = True
    ids = np.full((rows, max(beam, len(starts))), n)
    score = np.full(ids.shape, -np.inf)
    ids[:, : len(starts)], score[:, : len(starts)] = starts, q @ x[starts].T
    order = np.argsort(-score, axis=1, kind="stable")
    ids, score = np.take_along_axis(ids, order, 1)[:, :beam], np.take_along_axis(score, order, 1)[:, :beam]
    closed = ids < n
    while True:
        act = np.flatnonzero(closed.any(axis=1))
        if not len(act):
            break
        here = closed[act]
        pick = np.argsort(~here, axis=1, kind="stable")[:, :expand]
        wanted = np.where(np.take_along_axis(here, pick, 1), np.take_along_axis(ids[act], pick, 1), n)
        closed[act[:, None], pick] = False
        near = np.sort(links[wanted].reshape(len(act), -1), axis=1)
        fresh = ~seen[act[:, None], near]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        r, c = np.nonzero(fresh)
        found = near[r, c]
        seen[act[r], found] = True
        products = np.full(near.shape, -np.inf)
        products[r, c] = np.einsum("ij,ij->i", x[found], q[act[r]])
        every = np.concatenate((score[act], products), axis=1)
        best = np.argpartition(-every, beam - 1, axis=1)[:, :beam]
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(every, best, 1), axis=1, kind="stable"), 1)
        score[act] = np.take_along_axis(every, best, 1)
        ids[act] = np.take_along_axis(np.concatenate((ids[act], np.where(fresh, near, n)), axis=1), best, 1)
        closed[act] = np.take_along_axis(np.concatenate((closed[act], fresh), axis=1), best, 1)
    return np.where(ids < n, ids, -1), score


def robust_prune(x: np.ndarray, of: np.ndarray, candidates: np.ndarray, degree: int = DEGREE, relax: float = RELAX) -> np.ndarray:
    """(rows, degree) neighbours of nodes `of` out of candidates (rows, c; len(x) where there's none, no node twice in a row)."""
    n = len(x)
    padded = np.concatenate((x, np.zeros((1, x.shape[1]))))
    none = (candidates == n) | (candidates == of[:, None])
    vectors = padded[candidates]
    away = np.where(none, np.inf, np.maximum(0, 1 - np.einsum("rcd,rd->rc", vectors, x[of])))
    apart = np.maximum(0, 1 - vectors @ vectors.transpose(0, 2, 1)) * relax * relax  # half the squared distances
    out = np.full((len(of), degree), n)
    left, rows = np.where(none, np.inf, away), np.arange(len(of))
    for k in range(degree):
        first = left.argmin(axis=1)
        has = np.isfinite(left[rows, first])
        if not has.any():
            break
        out[has, k] = candidates[has, first[has]]
        left[apart[rows, first] <= away] = np.inf
        left[rows, first] = np.inf
    return out


def _link_back(x: np.ndarray, links: np.ndarray, nodes: np.ndarray) -> None:
    """Each edge from one of `nodes` goes back as well; nodes that get more than fit are pruned."""
    n, degree = len(x), links.shape[1]
    source, target = np.repeat(nodes, degree), links[nodes].ravel()
    real = target < n
    source, target = source[real], target[real]
    away = 1 - np.einsum("ij,ij->i", x[source], x[target])
    order = np.lexsort((away, target))
    source, target = source[order], target[order]
    starts = np.concatenate(([0], np.flatnonzero(target[1:] != target[:-1]) + 1)) if len(target) else np.array([], int)
    rank = np.arange(len(target)) - np.repeat(starts, np.diff(starts, append=len(target)))
    near = rank < 2 * degree  # of those that come in, the nearest
    source, target, rank = source[near], target[near], rank[near]
    touched, row = np.unique(target, return_inverse=True)
    coming = np.full((len(touched), int(rank.max(initial=-1)) + 1), n)
    coming[row, rank] = source
    for at in range(0, len(touched), STEP_ROWS):
        own, more = touched[at : at + STEP_ROWS], coming[at : at + STEP_ROWS]
        every = np.sort(np.concatenate((links[own], more), axis=1), axis=1)
        every[:, 1:][every[:, 1:] == every[:, :-1]] = n
        every.sort(axis=1)
        every = every[:, : max(degree, int((every < n).sum(axis=1).max()))]
        full = (every < n).sum(axis=1) > degree
        links[own[~full]] = every[~full, :degree]
        if full.any():
            links[own[full]] = robust_prune(x, own[full], every[full], degree)


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, passes: int = 2, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(links (n, degree) with n for none, nodes that searches start from)"""
    n, rng = len(x), np.random.default_rng(seed)
    order = rng.permutation(n)
    links = np.full((n, degree), n)
    starts = order[: min(n, STARTS)]

    def placed(nodes: np.ndarray, candidates: np.ndarray) -> None:
        links[nodes] = robust_prune(x, nodes, candidates, degree)
        _link_back(x, links, nodes)

    def searched(nodes: np.ndarray) -> None:
        for at in range(0, len(nodes), STEP_ROWS):
            part = nodes[at : at + STEP_ROWS]
            padded = np.concatenate((links, np.full((1, degree), n)))
            found, _ = beam_search(x, padded, x[part], starts, beam)
            every = np.sort(np.concatenate((np.where(found < 0, n, found), links[part]), axis=1), axis=1)
            every[:, 1:][every[:, 1:] == every[:, :-1]] = n
            placed(part, every)

    first = order[: min(n, 2 * STARTS)]
    placed(first, np.tile(first, (len(first), 1)))
    at = len(first)
    while at < n:
        size = max(STARTS, min(STEP_ROWS, at // 4))
        searched(order[at : at + size])
        at += size
    for _ in range(passes - 1):
        searched(rng.permutation(n))
    return links, starts


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """k centroids; one that loses all its rows moves to the row that is worst served."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        cost = np.einsum("ij,ij->i", c, c)[None, :] - 2 * x @ c.T
        best = cost.argmin(axis=1)
        total, count = np.zeros_like(c), np.bincount(best, minlength=k)
        np.add.at(total, best, x)
        lost = np.flatnonzero(count == 0)
        total[lost] = x[np.argsort(-(cost.min(axis=1) + np.einsum("ij,ij->i", x, x)))[: len(lost)]]
        c = total / np.maximum(count, 1)[:, None]
    return c


def _cells_needed(x: np.ndarray, c: np.ndarray, k: int, coverage: float) -> int:
    """How many of the cells with the largest products of centroid and query hold that part of sampled queries' neighbours."""
    q = x[:: max(1, len(x) // SAMPLE_QUERIES)][:SAMPLE_QUERIES]
    home = (np.einsum("ij,ij->i", c, c)[None, :] - 2 * x @ c.T).argmin(axis=1)
    top = np.argsort(-(q @ x.T), axis=1)[:, : k + 1]
    place = np.empty((len(q), len(c)), int)
    np.put_along_axis(place, np.argsort(-(q @ c.T), axis=1), np.arange(len(c))[None, :], 1)
    ranks = np.sort(np.take_along_axis(place, home[top], 1).ravel())
    return int(ranks[min(len(ranks) - 1, int(np.ceil(coverage * len(ranks))) - 1)]) + 1


def _fit(nodes: DataFrame, k: int, sample_rows: int, shard_rows: int, coverage: float) -> dict:
    """dimension -> (centroids, cells that a query asks), from the sample_rows rows that hash lowest."""
    total = nodes.count()
    sample = nodes.select("v").orderBy(F.xxhash64("node", F.lit(1))).limit(sample_rows).toArrow().column("v").combine_chunks()
    groups: dict[int, list[np.ndarray]] = {}
    for v in sample:
        groups.setdefault(len(v), []).append(v.values.to_numpy())
    cells = {}
    for size, rows in groups.items():
        x = np.array(rows, np.float64)
        n = min(round(len(x) * total / len(sample) / shard_rows), len(x) // 10, CELLS)
        if n > 1:
            c = kmeans(x, n)
            cells[size] = c, _cells_needed(x, c, k, coverage)
    return cells


def _by_size(column: pa.Array):
    """(dimension, places, vectors) of an array column"""
    flat, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    lengths = np.diff(offsets)
    for size in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == size)
        yield size, at, flat[offsets[at][:, None] + np.arange(size)].astype(np.float64)


def _in_cells(nodes: DataFrame, cells: dict, least: dict | None = None, k: int = 0) -> DataFrame:
    """nodes with (size, cell): the cell of the nearest centroid; with `least`, the number of rows of each cell, those that a query asks, more of
    them where they hold too few rows."""
    shared = nodes.sparkSession.sparkContext.broadcast((cells, least))  # at most CELLS centroids a dimension
    names = nodes.columns

    def each(batches):
        cells, least = shared.value
        for batch in batches:
            for size, at, x in _by_size(batch.column(names.index("v"))):
                c, ask = cells.get(size, (np.zeros((1, size)), 1))
                if least is None:
                    row, cell = np.arange(len(at)), (np.einsum("ij,ij->i", c, c)[None, :] - 2 * x @ c.T).argmin(axis=1)
                else:
                    order = np.argsort(-(x @ c.T), axis=1)
                    held = np.cumsum(np.array([least.get((size, i), 0) for i in range(len(c))])[order], axis=1)
                    asked = (np.arange(len(c)) < ask)[None, :] | (held - np.array([least.get((size, i), 0) for i in range(len(c))])[order] <= 2 * k)
                    row, place = np.nonzero(asked)
                    cell = order[row, place]
                take = pa.array(at[row])
                yield pa.RecordBatch.from_arrays([*(b.take(take) for b in batch.columns), pa.array(np.full(len(row), size, np.int64)), pa.array(cell.astype(np.int64))], [*names, "size", "cell"])

    kinds = ", ".join(f"{n} {t}" for n, t in nodes.dtypes)
    return nodes.mapInArrow(each, f"{kinds}, size long, cell long")


def _vectors(table: pa.Table) -> np.ndarray:
    return table.column("v").combine_chunks().values.to_numpy().astype(np.float64).reshape(table.num_rows, -1)


def build_index(nodes: DataFrame, cells: dict, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """nodes(node, first_id, v) -> (size, cell, part, node, first_id, v, links): each shard's graph, links being places in the order of nodes of the shard."""
    placed = _in_cells(nodes, cells)
    parts = placed.groupBy(F.col("size").alias("_s"), F.col("cell").alias("_c")).agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("_parts"))
    placed = placed.join(parts, (F.col("size") == F.col("_s")) & (F.col("cell") == F.col("_c"))).withColumn("part", F.pmod(F.xxhash64("node", F.lit(3)), "_parts").cast("int")).drop("_s", "_c", "_parts")
    columns = ["size", "cell", "part", "node", "first_id", "v"]

    def graph(table: pa.Table) -> pa.Table:
        table = table.select(columns).sort_by("node")
        n = table.num_rows
        links = np.full((n, 1), n)
        if n > EXACT_ROWS:
            links, _ = build_graph(augmented(_vectors(table)))
        used = [row[row < n] for row in links]
        return table.append_column("links", pa.array(used, pa.list_(pa.int32())))

    kinds = dict(placed.dtypes)
    return placed.select(*columns).groupBy("size", "cell", "part").applyInArrow(graph, ", ".join(f"{c} {kinds[c]}" for c in columns) + ", links array<int>")


def search_index(index: DataFrame, queries: DataFrame, cells: dict, k: int = 20, beam: int = SEARCH_BEAM, query_block: int = QUERY_BLOCK) -> DataFrame:
    """queries(node, v) against build_index()'s rows -> (q, node, first_id, score): of each shard asked, the k best nodes found."""
    shards = index.groupBy("size", "cell", "part").agg(F.count("*").alias("n")).collect()  # a row for each shard
    held: dict = {}
    for r in shards:
        held[r["size"], r.cell] = held.get((r["size"], r.cell), 0) + r.n
    asked = _in_cells(queries.select(F.col("node").alias("q"), "v"), cells, held, k)
    counts = asked.groupBy("size", "cell").agg(F.count("*").alias("n"))
    blocks = counts.select(F.col("size").alias("_s"), F.col("cell").alias("_c"), F.ceil(F.col("n") / query_block).cast("int").alias("_blocks"))
    parts = index.groupBy(F.col("size").alias("_s"), F.col("cell").alias("_c")).agg((F.max("part") + 1).alias("_parts"))
    at = (F.col("size") == F.col("_s")) & (F.col("cell") == F.col("_c"))
    dealt = asked.join(blocks, at).drop("_s", "_c").withColumn("block", F.pmod(F.xxhash64("q", F.lit(5)), "_blocks").cast("int"))
    dealt = dealt.join(parts, at).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).select("size", "cell", "part", "block", "q", "v")
    copies = index.join(blocks, at).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select("size", "cell", "part", "block", "node", "first_id", "v", "links")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        made: list[pa.Table] = []
        if left.num_rows and right.num_rows:
            left = left.sort_by("node")
            v, q = _vectors(left), _vectors(right)
            n, node, names = left.num_rows, left.column("node").to_numpy(), right.column("q").to_numpy()
            first = left.column("first_id").to_pandas().fillna(np.iinfo(np.int64).max).to_numpy(np.int64) if left.column("first_id").null_count else left.column("first_id").to_numpy()
            if n > EXACT_ROWS:
                x, lists = augmented(v), left.column("links").combine_chunks()
                lengths = np.diff(lists.offsets.to_numpy())
                links = np.full((n + 1, max(1, lengths.max())), n)
                links[:n][np.arange(links.shape[1])[None, :] < lengths[:, None]] = lists.values.to_numpy()
                starts = np.random.default_rng(11).permutation(n)[:STARTS]
            for lo in range(0, len(q), STEP_ROWS):
                part = q[lo : lo + STEP_ROWS]
                if n > EXACT_ROWS:
                    scaled = part / np.abs(part).max(axis=1)[:, None]
                    found, _ = beam_search(x, links, np.concatenate((scaled, np.zeros((len(part), 1))), axis=1), starts, beam)
                    r, c = np.nonzero(found >= 0)
                    row, place = r, found[r, c]
                else:
                    row, place = np.repeat(np.arange(len(part)), n), np.tile(np.arange(n), len(part))
                score = (v[place] * part[row]).sum(axis=1)
                order = np.lexsort((node[place], first[place], -score, row))
                row, place, score = row[order], place[order], score[order]
                starts_of = np.concatenate(([0], np.flatnonzero(row[1:] != row[:-1]) + 1))
                near = np.arange(len(row)) - np.repeat(starts_of, np.diff(starts_of, append=len(row))) < k
                row, place, score = row[near], place[near], score[near]
                made.append(pa.table({"q": names[lo + row], "node": node[place], "first_id": left.column("first_id").take(pa.array(place)), "score": score}))
        empty = pa.table({"q": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "first_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        return pa.concat_tables(made) if made else empty

    key = ("size", "cell", "part", "block")
    return copies.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInArrow(search, "q long, node long, first_id long, score double")


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, coverage: float = 0.98, sample_rows: int = SAMPLE_ROWS, shard_rows: int = SHARD_ROWS, query_block: int = QUERY_BLOCK, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank from 1, vec_id, score): for each row whose id is divisible by `every`, the k nearest other rows found."""
    kind = "array<float>" if dict(vectors.dtypes)[vector_col] == "array<float>" else "array<double>"
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("v"))
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    v = v.where(F.coalesce(~odd & F.exists("v", lambda c: c != 0), F.lit(False))).withColumn("v", F.transform("v", lambda c: c + 0.0).cast(kind))  # -0.0 as 0.0
    keyed = materialize(v.select("vec_id", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), "v").withColumn("row", F.monotonically_increasing_id()))
    nodes = keyed.groupBy("h1", "h2").agg(F.first("v").alias("v"), F.min("vec_id").alias("first_id"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()))
    names = nodes.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "node")
    rows = keyed.select("vec_id", "row", "h1", "h2")
    same = (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))

    cells = _fit(nodes, k, sample_rows, shard_rows, coverage)
    index = materialize(build_index(nodes.select("node", "first_id", "v"), cells, shard_rows))
    asking = materialize(rows.where(F.col("vec_id") % every == 0).join(names, same).select("vec_id", "row", F.col("node").alias("q")))
    asked = asking.select(F.col("q").alias("_q")).distinct()
    queries = nodes.join(asked, F.col("node") == F.col("_q"), "left_semi").select("node", "v")
    # one more than k, as the query itself is among them
    found = search_index(index, queries, cells, k + 1, query_block=query_block)
    best = W.partitionBy("q").orderBy(F.col("score").desc(), F.col("first_id").asc_nulls_last(), "node")
    found = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1).drop("_n", "first_id")
    least = W.partitionBy("h1", "h2").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    members = rows.withColumn("_n", F.row_number().over(least)).where(F.col("_n") <= k + 1).join(names, same).select(F.col("node").alias("_m"), "vec_id", "row")
    ordered = W.partitionBy("q").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    ranked = found.join(members, F.col("node") == F.col("_m")).withColumn("_n", F.row_number().over(ordered)).where(F.col("_n") <= k + 1)
    lists = ranked.groupBy(F.col("q").alias("_q")).agg(F.sort_array(F.collect_list(F.struct("_n", "row", "vec_id", "score"))).alias("near"))  # k + 1 at most
    out = asking.join(lists, F.col("q") == F.col("_q")).select(F.col("vec_id").alias("query_id"), F.col("row").alias("_row"), "near")
    others = F.slice(F.filter("near", lambda x: x["row"] != F.col("_row")), 1, k)
    return out.select("query_id", F.posexplode(others).alias("_k", "x")).select("query_id", (F.col("_k") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
