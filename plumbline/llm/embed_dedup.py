"""Near-duplicate embeddings (operator 5): spherical k-means cells, blocked cosine products within cells.

Exact for any centroids: a vector u of cell c satisfies u.c >= u.c', so another vector v of cell c' can only be within
the angle t of u if its angle to the plane between c and c' is at most t, that is v.c' - v.c <= sin(t) |c' - c|, and if its
angle to c' is at most t more than that of the outermost vector of c'. Every v is therefore also a guest of each cell for which
both hold, and a cell compares its own vectors with its own and its guests. Of two cells only one takes guests of the other, so a
pair meets once. Centroids are fitted on a bounded sample and decide
only how much is compared. Cells that come out too large are cut in the same way by centroids of their own, fitted on a bounded
sample of the cell, for as long as that makes fewer comparisons: the number of cells follows the number of vectors.

Identical vectors of one label are one node with a multiplicity. They meet by 128 bits of hash, so that vectors themselves are
shuffled once, to make the nodes, and after that only to be compared. Cells beyond `tile_rows` are compared as pairs of tiles, of which
one at least is the cell's own. Guests are copies of vectors, and without clusters each vector is a guest of many cells: cells are therefore
compared in passes of about PASS_COPIES copies of a vector each, made of the nodes anew and never stored, and each pass's shuffles go with its end.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, and all vectors of a null label,
link with nothing and are their own component; vectors of different length don't link; repeated rows are vectors of their
own that link with each other; a null vec_id gives a row with a null component_id unless it is linked with another id.
"""

from __future__ import annotations

import math
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize
from .graph import connected_components
from .tiles import local_roots, run_groups

SAMPLE_ROWS = 20_000  # rows that k-means is fitted on, over all labels
CELL_ROWS = 2_000  # vectors that a cell is meant to have
CHILD_SAMPLE, CHILDREN, TASK_ROWS = 512, 32, 50_000  # of a cell that is cut: rows its centroids are fitted on, their number at most, rows in a task
PASS_COPIES = 1.5  # of a vector, that one pass sends to be compared
GUEST_TILES = 4  # times tile_rows are the guests in a tile
SLACK = 1e-9  # of the bound, against rounding


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """k unit centroids of unit rows; a centroid that loses all its rows moves to the row that is worst served."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        score = x @ c.T
        best = score.argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, best, x)
        norm = np.linalg.norm(total, axis=1)
        lost = np.flatnonzero(norm < 1e-9)
        total[lost] = x[np.argsort(score.max(axis=1))[: len(lost)]]
        norm[lost] = 1
        c = total / norm[:, None]
    return c


def fit_cells(nodes: DataFrame, sample_rows: int = SAMPLE_ROWS, cell_rows: int = CELL_ROWS) -> dict:
    """(label, dimension) -> centroids, from the sample_rows rows of nodes(label, v) that hash lowest."""
    total = nodes.count()
    sample = nodes.select("label", "v").orderBy(F.xxhash64("node", F.lit(1))).limit(sample_rows).collect()
    groups: dict = {}
    for r in sample:
        groups.setdefault((r.label, len(r.v)), []).append(r.v)
    cells = {}
    for key, rows in groups.items():
        x = np.array(rows, dtype=np.float64)
        x /= np.linalg.norm(x, axis=1)[:, None]
        k = min(round(len(x) * total / len(sample) / cell_rows), len(x) // 10)
        if k > 1:
            cells[key] = spherical_kmeans(x, k)
    return cells


def _by_kind(batch: pa.RecordBatch):
    """(label, dimension, places, unit vectors) of a batch of (node, label, mult, v)."""
    labels = batch.column(1).to_numpy()
    flat, lengths = batch.column(3).flatten().to_numpy(), np.diff(batch.column(3).offsets.to_numpy())
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    for label, size in sorted(set(zip(labels.tolist(), lengths.tolist(), strict=True))):
        at = np.flatnonzero((labels == label) & (lengths == size))
        x = flat[starts[at][:, None] + np.arange(size)].astype(np.float64)
        yield label, size, at, x / np.linalg.norm(x, axis=1)[:, None]


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def _takes(best: np.ndarray, k: int) -> np.ndarray:
    """For each row's best cell, the cells of k that take its guests: of two cells one does, and each does for half of the others."""
    ahead = (np.arange(k)[None, :] - best[:, None]) % k
    return (2 * ahead < k) | ((2 * ahead == k) & (best[:, None] < np.arange(k)[None, :]))


def _radii(nodes: DataFrame, cells: dict) -> dict:
    """(label, dimension) -> the angle of each cell's outermost vector: one number for each centroid."""
    if not cells:
        return {}
    shared = nodes.sparkSession.sparkContext.broadcast(cells)

    def each(batches):
        for batch in batches:
            for label, size, _, x in _by_kind(batch):
                if (c := shared.value.get((label, size))) is not None:
                    score = x @ c.T
                    best = score.argmax(axis=1)
                    far = np.zeros(len(c))
                    np.maximum.at(far, best, _angle(score[np.arange(len(x)), best]))
                    hit = np.unique(best)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hit), label, np.int64)), pa.array(np.full(len(hit), size, np.int64)), pa.array(hit), pa.array(far[hit])], ["label", "size", "cell", "far"])

    rows = nodes.select("node", "label", "mult", "v").mapInArrow(each, "label long, size long, cell long, far double").groupBy("label", "size", "cell").agg(F.max("far").alias("far")).collect()
    out = {key: np.zeros(len(c)) for key, c in cells.items()}
    for r in rows:
        out[r.label, r.size][r.cell] = r.far
    return out


def _pass_of(bucket: str, passes: int) -> int:
    return zlib.crc32(bucket.encode()) % passes


def _assign(nodes: DataFrame, shared, cosine: float, passes: int = 1, turn: int = 0) -> DataFrame:
    """(bucket, node, mult, home, v): each node once at home and once as a guest wherever a partner may be at home, of the buckets whose turn it is.
    shared: centroids and radii, broadcast; at most sample_rows / 10 centroids."""
    reach, within = math.sqrt(1 - cosine * cosine) + SLACK, math.acos(cosine) + SLACK

    def each(batches):
        cells, radii = shared.value
        for batch in batches:
            for label, size, at, x in _by_kind(batch):
                c = cells.get((label, size))
                if c is None:
                    row, cell, home = np.arange(len(at)), np.zeros(len(at), np.int64), np.ones(len(at), bool)
                else:
                    score = x @ c.T
                    best = score.argmax(axis=1)
                    apart = np.sqrt(np.maximum(0, 2 - 2 * c @ c.T))[best]
                    near = score[np.arange(len(at)), best][:, None] - score <= reach * apart + SLACK
                    near &= _angle(score) <= radii[label, size][None, :] + within + 1e-7  # arccos loses digits near 1
                    near &= _takes(best, len(c))
                    near[np.arange(len(at)), best] = True
                    near &= np.array([_pass_of(f"{label}/{size}/{i}", passes) == turn for i in range(len(c))])[None, :]
                    row, cell = np.nonzero(near)
                    home = cell == best[row]
                if c is None and _pass_of(f"{label}/{size}/0", passes) != turn:
                    continue
                take = pa.array(at[row])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{label}/{size}/{i}" for i in cell.tolist()], pa.string()), batch.column(0).take(take), batch.column(2).take(take), pa.array(home), batch.column(3).take(take)],
                    ["bucket", "node", "mult", "home", "v"],
                )

    kind = dict(nodes.dtypes)["v"]
    return nodes.select("node", "label", "mult", "v").mapInArrow(each, f"bucket string, node long, mult long, home boolean, v {kind}")


def _memberships(x: np.ndarray, c: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """(best cell, which cells each row is in) by the planes between the centroids."""
    score = x @ c.T
    best = score.argmax(axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * c @ c.T))[best]
    near = score[np.arange(len(x)), best][:, None] - score <= reach * apart + SLACK
    near[np.arange(len(x)), best] = True
    return best, near


def _children(placed: DataFrame, sizes: DataFrame, reach: float, cell_rows: int) -> DataFrame:
    """(bucket, parts, salts, centroids): for each cell of sizes(bucket, n) that a cut helps, its own centroids."""
    own = placed.where("home").join(F.broadcast(sizes.withColumnRenamed("bucket", "_b")), F.col("bucket") == F.col("_b")).select("bucket", "n", "node", "v")
    order = W.partitionBy("bucket").orderBy(F.xxhash64("node", F.lit(2)))
    sample = own.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= CHILD_SAMPLE).withColumn("_group", F.xxhash64("bucket"))

    def fit(table: pa.Table):
        n = table.column("n")[0].as_py()
        x = table.column("v").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(table.num_rows, -1)
        x /= np.linalg.norm(x, axis=1)[:, None]
        k = min(CHILDREN, -(-n // cell_rows), len(x) // 8)
        if k < 2:
            return None
        c = spherical_kmeans(x, k)
        if _memberships(x, c, reach)[1].sum() > len(x) * k / 2:
            return None  # vectors that all are within reach of each other
        return pa.RecordBatch.from_arrays([table.column("bucket").combine_chunks()[:1], pa.array([k], pa.int32()), pa.array([max(1, n // TASK_ROWS)], pa.int32()), pa.array([c.ravel()], pa.list_(pa.float64()))], ["bucket", "parts", "salts", "centroids"])

    return run_groups(sample, ["bucket", "n", "v"], fit, "bucket string, parts int, salts int, centroids array<double>")


def _cut(placed: DataFrame, children: DataFrame, reach: float) -> DataFrame:
    """The rows of the cells that children has, in their new cells. A cell's centroids go with each of its parts, ahead of its rows."""
    kind = dict(placed.dtypes)["v"]
    ahead = children.select("bucket", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("parts").cast("long").alias("node"), F.lit(-1).cast("long").alias("mult"), F.lit(False).alias("home"), F.col("centroids").alias("c"), F.lit(None).cast(kind).alias("v"))
    rows = placed.join(F.broadcast(children.select(F.col("bucket").alias("_b"), "salts")), F.col("bucket") == F.col("_b")).select("bucket", F.pmod(F.xxhash64("node", F.lit(3)), "salts").cast("int").alias("salt"), "node", "mult", "home", F.lit(None).cast("array<double>").alias("c"), "v")
    dealt = ahead.unionByName(rows).repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "mult")

    def each(batches):
        c = None
        for batch in batches:
            heads = np.flatnonzero(batch.column(3).to_numpy() < 0).tolist()
            for lo, hi in zip([0, *heads], [*heads, batch.num_rows], strict=True):
                if lo in heads:
                    c = np.array(batch.column(5)[lo].as_py()).reshape(batch.column(2)[lo].as_py(), -1)
                    lo += 1
                if hi <= lo:
                    continue
                part = batch.slice(lo, hi - lo)
                x = part.column(6).flatten().to_numpy().astype(np.float64).reshape(hi - lo, -1)
                best, near = _memberships(x / np.linalg.norm(x, axis=1)[:, None], c, reach)
                own = part.column(4).to_numpy(zero_copy_only=False)
                near &= _takes(best, len(c)) | ~own[:, None]  # a guest of the whole cell is at home elsewhere
                near[np.arange(len(x)), best] = True
                row, cell = np.nonzero(near)
                take = pa.array(row)
                home = own[row] & (cell == best[row])
                names = [f"{b}/{i}" for b, i in zip(part.column(0).take(take).to_pylist(), cell.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), part.column(2).take(take), part.column(3).take(take), pa.array(home), part.column(6).take(take)], ["bucket", "node", "mult", "home", "v"])

    return dealt.mapInArrow(each, f"bucket string, node long, mult long, home boolean, v {kind}")


def _refined(placed: DataFrame, cosine: float, cell_rows: int, rounds: int = 8) -> DataFrame:
    """placed, with its large cells cut as long as that helps. Only centroids are stored."""
    reach = math.sqrt(1 - cosine * cosine) + SLACK
    for _ in range(rounds):
        large = placed.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 4 * cell_rows)
        children = materialize(_children(placed, large, reach, cell_rows))
        if children.isEmpty():
            break
        stays = placed.join(F.broadcast(children.select(F.col("bucket").alias("_b"))), F.col("bucket") == F.col("_b"), "left_anti")
        placed = stays.unionByName(_cut(placed, children, reach))
    return placed


def _tiled(placed: DataFrame, tile_rows: int) -> DataFrame:
    """placed with _group and _side: a small bucket is one group; of a large one each two tiles of its own vectors are, and each tile of these with each of guests."""
    guests = GUEST_TILES * tile_rows
    own = F.count(F.when(F.col("home"), 1))
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("_n"), own.alias("_o")).where(F.col("_n") > tile_rows)
    sizes = materialize(sizes.select(F.col("bucket").alias("_b"), F.ceil(F.col("_o") / tile_rows).cast("int").alias("_to"), F.ceil((F.col("_n") - F.col("_o")) / guests).cast("int").alias("_tg")))
    out = placed.join(F.broadcast(sizes), F.col("bucket") == F.col("_b"), "left")
    to, tg = F.col("_to"), F.col("_tg")
    tile = F.pmod(F.xxhash64("node", F.lit(7)), F.when(F.col("home"), to).otherwise(tg)).cast("int")
    none = F.array().cast("array<int>")
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(none)
    # (own tile, kind and place of the other tile, side)
    at = lambda i, kind, j, side: F.struct(i.alias("i"), F.lit(kind).alias("kind"), j.alias("j"), side.cast("int").alias("side"))
    of_own = F.concat(F.transform(upto(to), lambda j: at(F.least(F.col("_tile"), j), 0, F.greatest(F.col("_tile"), j), F.col("_tile") > j)), F.transform(upto(tg), lambda j: at(F.col("_tile"), 1, j, F.lit(0))))
    of_guest = F.transform(upto(to), lambda i: at(i, 1, F.col("_tile"), F.lit(1)))
    whole = F.array(at(F.lit(0), 2, F.lit(0), F.lit(0)))
    out = out.withColumn("_tile", tile).withColumn("_at", F.explode_outer(F.when(to.isNull(), whole).when(F.col("home"), of_own).otherwise(of_guest))).where("_at is not null")
    return out.select(*placed.columns, F.xxhash64("bucket", "_at.i", "_at.kind", "_at.j").alias("_group"), F.col("_at.side").alias("_side"))


def embedding_links(nodes: DataFrame, cosine: float = 0.98, tile_rows: int = 4096, cells: dict | None = None, cell_rows: int = CELL_ROWS, pass_copies: float = PASS_COPIES) -> DataFrame:
    """nodes(node, label, mult, v) -> rows (kind, x, y): kind 0 adds y links to node x, kind 1 is an edge of a spanning star."""
    cells = fit_cells(nodes, cell_rows=cell_rows) if cells is None else cells
    shared = nodes.sparkSession.sparkContext.broadcast((cells, _radii(nodes, cells)))
    sizes = _assign(nodes, shared, cosine).groupBy("bucket").agg(F.count("*").alias("n"), F.count(F.when(F.col("home"), 1)).alias("o"))
    # guests meet each tile of the cell's own vectors, and these each tile of guests and of their own
    copies = F.col("n") * F.greatest(F.ceil(F.col("o") / tile_rows), F.lit(1)) + F.col("o") * F.ceil((F.col("n") - F.col("o")) / (GUEST_TILES * tile_rows))
    total, held = sizes.agg(F.sum(copies), F.sum("o")).first()
    passes = max(1, math.ceil((total or 0) / (pass_copies * max(1, held or 0))))
    found = [_pass_links(_refined(_assign(nodes, shared, cosine, passes, turn), cosine, cell_rows), cosine, tile_rows) for turn in range(passes)]
    return reduce(DataFrame.unionByName, found)


def _pass_links(placed: DataFrame, cosine: float, tile_rows: int) -> DataFrame:
    tiled = _tiled(placed, tile_rows)

    def work(table: pa.Table):
        side, home = table.column("_side").to_numpy(), table.column("home").to_numpy()
        mult, node = table.column("mult").to_numpy(), table.column("node").to_numpy()
        if not home.any():
            return None
        x = table.column("v").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(node), -1)
        norm = np.linalg.norm(x, axis=1)
        two, n = bool(side.any()), len(node)
        a, b = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if two else (np.arange(n), np.arange(n))
        links, ii, jj = np.zeros(n, np.int64), [], []
        for at in range(0, len(a), 512):
            block = a[at : at + 512]
            close = (x[block] @ x[b].T) / (norm[block][:, None] * norm[b][None, :]) >= cosine
            close &= block[:, None] != b[None, :]
            if two:
                links[block] += close @ mult[b]
                links[b] += mult[block] @ close
            else:  # of two guests each has its own home, where they may meet
                links[block] += np.where(home[block], close @ mult[b], close @ (mult * home)[b])
            i, j = np.nonzero(close)
            ii.append(block[i])
            jj.append(b[j])
        root = local_roots(n, np.concatenate(ii), np.concatenate(jj))
        child, linked = np.flatnonzero(root != np.arange(n)), np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([0, 1], [len(linked), len(child)]).astype(np.int32)), pa.array(np.concatenate([node[linked], node[child]])), pa.array(np.concatenate([links[linked], node[root[child]]]))],
            ["kind", "x", "y"],
        )

    return materialize(run_groups(tiled, ["_side", "home", "mult", "node", "v"], work, "kind int, x long, y long"))


def embedding_components(vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **fit) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per vector; see the module for the defined cases."""
    kind = "array<float>" if dict(vectors.dtypes)[vector_col] == "array<float>" else "array<double>"
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast(kind).alias("v"))
    odd = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    fine = F.col("label").isNotNull() & F.coalesce(~odd & F.exists("v", lambda c: c != 0), F.lit(False))
    v = v.withColumn("v", F.when(fine, F.transform("v", lambda c: c + 0.0).cast(kind)))  # -0.0 as 0.0: copies then are equal as keys too
    alone = v.where(F.col("v").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    keyed = v.where(F.col("v").isNotNull()).select("*", F.xxhash64("label", "v").alias("h1"), F.xxhash64(F.lit(1), "v", "label").alias("h2"))
    # a node is a distinct vector of a label, named by a row number that the checkpoint keeps fixed
    nodes = keyed.groupBy("h1", "h2").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.min("vec_id").alias("first_id"), F.count("*").alias("mult"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()))
    found = embedding_links(nodes.select("node", "label", "mult", "v"), cosine, **fit)
    links = found.where("kind = 0").groupBy("x").agg(F.sum("y").alias("links"))
    roots = connected_components(found.where("kind = 1").select(F.col("x").alias("a"), F.col("y").alias("b"))).withColumnRenamed("node", "rn")
    placed = nodes.select("node", "first_id", "mult", "h1", "h2").join(roots, F.col("node") == F.col("rn"), "left").withColumn("top", F.coalesce("root", "node")).drop("rn", "root")
    named = placed.groupBy(F.col("top").alias("_top")).agg(F.min("first_id").alias("component_id"))
    out = placed.join(named, F.col("top") == F.col("_top")).join(links, F.col("node") == F.col("x"), "left")
    out = out.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "component_id")
    linked = keyed.select("vec_id", "h1", "h2").join(out, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))).select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
