import math

import numpy as np
import pytest

from plumbline.llm import ann_graph
from plumbline.llm.queries import op11_ann_graph

TABLE = "vec_id long, embedding array<double>, label int"


def brute(rows, k=20, every=20):
    """query row -> the k nearest other rows, best first."""
    fine = [(i, np.array(v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = {}
    for n, (i, q) in enumerate(fine):
        if i is not None and i % every == 0:
            near = [(-float((q * x).sum()), math.inf if j is None else j, m) for m, (j, x) in enumerate(fine) if m != n and len(x) == len(q)]
            out.setdefault(i, []).append([(j, -s) for s, j, _ in sorted(near)[:k]])
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((math.inf if r.vec_id is None else r.vec_id, r.score, r["rank"]))
    return out


def recall(got, want):
    hits = sum(len({x[0] for x in got[i]} & {x[0] for x in w[0]}) for i, w in want.items())
    return hits / sum(len(w[0]) for w in want.values())


def test_beam_search_finds_neighbours():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(3000, 24)) * rng.uniform(0.2, 3, size=(3000, 1))
    x = ann_graph.augmented(v)
    assert np.allclose(np.linalg.norm(x, axis=1), 1)
    links, starts = ann_graph.build_graph(x)
    assert links.shape == (3000, ann_graph.DEGREE) and all(len(set(r[r < 3000])) == (r < 3000).sum() and i not in r for i, r in enumerate(links))
    q = rng.normal(size=(100, 24))
    ids, score = ann_graph.beam_search(x, np.concatenate((links, np.full((1, links.shape[1]), 3000))), np.concatenate((q, np.zeros((100, 1))), axis=1), starts)
    assert (np.diff(score, axis=1) <= 0).all() and all(len(set(r)) == len(r) for r in ids)
    top = np.argsort(-(q @ v.T), axis=1)[:, :20]
    assert np.mean([len(set(a[:20]) & set(b)) / 20 for a, b in zip(ids, top, strict=True)]) > 0.95


def test_pruning_keeps_diverse_edges():
    x = ann_graph.augmented(np.array([[0.0, 1.0], [0.1, 1.0], [0.11, 1.0], [-0.3, 1.0], [1.0, 0.5]]))
    kept = ann_graph.robust_prune(x, np.array([0]), np.array([[0, 1, 2, 3, 4]]), 4)[0]
    away = 1 - x @ x.T
    want, left = [], sorted((1, 2, 3, 4), key=lambda i: away[0, i])
    while left:
        want.append(left[0])
        left = [i for i in left[1:] if 1.44 * away[want[-1], i] > away[0, i]]
    assert [i for i in kept if i < 5] == want and 2 not in want and 3 in want


@pytest.mark.parametrize("extra", [{}, {"shard_rows": 300, "sample_rows": 500}, {"shard_rows": 700, "query_block": 10, "coverage": 1.0}])
def test_given_table_by_recall(spark, extra):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.select("vec_id", "embedding").orderBy("vec_id").collect()]
    got, want = found(ann_graph.nearest(table, **extra)), brute(rows)
    vectors = {i: np.array(v) for i, v in rows}
    assert got.keys() == want.keys() and recall(got, want) >= 0.95
    for i, near in got.items():
        assert [x[2] for x in near] == list(range(1, 21)) and i not in [x[0] for x in near]
        assert all(abs(float(vectors[i] @ vectors[j]) - s) < 1e-12 for j, s, _ in near) and [x[:2] for x in near] == sorted((x[:2] for x in near), key=lambda x: (-x[1], x[0]))


def test_clusters_ask_few_cells(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16)) * 5
    x = np.concatenate([c + rng.normal(size=(250, 16)) * 0.3 for c in centres])
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], TABLE)
    nodes = table.selectExpr("vec_id as node", "vec_id as first_id", "embedding as v")
    cells = ann_graph._fit(nodes, 20, 2000, 250, 0.97)
    assert 8 <= len(cells[16][0]) <= 16 and cells[16][1] <= 4
    got, want = found(ann_graph.nearest(table, shard_rows=250, sample_rows=2000)), brute([(i, v.tolist()) for i, v in enumerate(x)])
    assert recall(got, want) >= 0.95


def test_groups_of_equal_vectors(spark):
    rng = np.random.default_rng(3)
    x = [rng.integers(-3, 4, size=6).astype(float).tolist() for _ in range(40)]
    rows = [(i, x[i % 40] if i % 3 else [1.0, 2.0, 0.0, 0.0, 1.0, -1.0]) for i in range(1200)]
    got, want = found(ann_graph.nearest(spark.createDataFrame([(i, v, 1) for i, v in rows], TABLE))), brute(rows)
    assert {i: [x[:2] for x in near] for i, near in got.items()} == {i: [tuple(x) for x in w[0]] for i, w in want.items()}


def test_nearest_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, -0.0]), (20, [0.5, 0.0]), (3, [2.0, 2.0]), (None, [2.0, 2.0]), (40, [1.0, 2.0, 3.0]), (41, [1.0, 0.0, 0.0]), (60, None), (80, []), (100, [0.0, 0.0]), (120, [nan, 1.0]), (140, [inf, 1.0]), (160, [None, 1.0]), (180, [7.0])]
    table = spark.createDataFrame([(i, v, None) for i, v in rows], TABLE).selectExpr("*", "1 as node", "'z' as v", "2 as rank", "3 as q", "4 as size")
    got = ann_graph.nearest(table).collect()
    assert sorted((r.query_id, r["rank"], -1 if r.vec_id is None else r.vec_id, r.score) for r in got if r.query_id != 20) == [(0, 1, 3, 2.0), (0, 2, -1, 2.0), (0, 3, 20, 0.5), (0, 4, 20, 0.5), (40, 1, 41, 1.0)]
    assert sorted((r["rank"], -1 if r.vec_id is None else r.vec_id, r.score) for r in got if r.query_id == 20) == sorted(2 * [(1, 3, 1.0), (2, -1, 1.0), (3, 0, 0.5), (4, 20, 0.25)])
    assert ann_graph.nearest(table.where("false")).count() == 0 == ann_graph.nearest(table.where("vec_id = 180")).count()


def test_query_has_its_columns(spark):
    assert op11_ann_graph(spark, "/root/testdata/sf0.001").columns == ["query_id", "rank", "vec_id", "score"]
