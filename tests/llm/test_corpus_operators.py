import random
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from plumbline.llm import embed_dedup, graph, packing, simhash, substring
from plumbline.llm.queries import tokenizer_file

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def roots(n, pairs):
    top = list(range(n))

    def find(i):
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# ---- components ----
@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(250, 280)] + [(7, 7)]
    got = {r.node: r.root for r in graph.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: r for i, r in enumerate(roots(300, pairs)) if r != i}


def test_no_components(spark):
    assert graph.connected_components(spark.createDataFrame([(None, 1), (2, 2)], "a long, b long")).count() == 0


# ---- SimHash ----
def plain_fingerprint(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    fps = np.array([plain_fingerprint(t) for _, t in rows], dtype=np.uint64)
    pairs = np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    want = roots(len(rows), pairs.tolist())
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(docs).collect()}
    assert got == {i: (f"{f:016x}", rows[c][0]) for (i, _), f, c in zip(rows, fps.tolist(), want, strict=True)}


@pytest.mark.parametrize("scheme", [(5, 1), (6, 2), (7, 3), (8, 4)])
def test_every_scheme_and_small_tiles_are_exact(spark, scheme, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**64, 60, dtype=np.uint64)
    flips = [f ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for f in base for k in (1, 3, 4, 5)]
    hot = [np.uint64(0xFFFF) ^ np.uint64(1 << i) for i in range(20)]
    fps = np.unique(np.array([*base, *flips, *hot], dtype=np.uint64))
    monkeypatch.setattr(simhash, "block_scheme", lambda n, radius: scheme)
    edges = simhash.fingerprint_links(spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long"), 4, tile_rows=5)
    names = {int(f): i for i, f in enumerate(fps.view(np.int64))}
    found = roots(len(fps), [(names[r.a], names[r.b]) for r in edges.collect()])
    assert found == roots(len(fps), np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4).tolist())


def test_simhash_defined_cases(spark):
    docs = docs_of(spark, [(3, ""), (1, None), (None, " \n"), (4, "one"), (4, "one"), (None, "alone here")]).selectExpr("*", "1 as fp", "2 as root", "3 as component_id")
    rows = sorted((r.doc_id or 0, r.component_id or 0, r.fingerprint) for r in simhash.simhash_components(docs).collect())
    assert [r[:2] for r in rows] == [(0, 0), (0, 1), (1, 1), (3, 1), (4, 4), (4, 4)] and rows[2][2] == "0" * 16
    assert simhash.simhash_components(docs.where("false")).count() == 0
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 4]


# ---- embeddings ----
def test_embeddings_across_cells_and_tiles(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(12, 16))
    x = np.concatenate([c + 0.06 * np.linalg.norm(c) * rng.normal(size=(25, 16)) / 4 for c in centre] + [rng.normal(size=(100, 16))])
    x = np.concatenate((x, x[:30], -x[:1]))
    label = [int(v) for v in rng.integers(0, 2, len(x))]
    rows = [(i, v.tolist(), la) for i, (v, la) in enumerate(zip(x, label, strict=True))]
    u = x / np.linalg.norm(x, axis=1)[:, None]
    close = (u @ u.T >= 0.98) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(close, False)
    want = roots(len(x), np.argwhere(close).tolist())
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    cells = {(la, 16): embed_dedup.spherical_kmeans(u[np.array(label) == la], 9) for la in (0, 1)}
    for extra in ({}, {"cells": cells}, {"cells": cells, "tile_rows": 7}, {"tile_rows": 11}, {"cells": {}, "cell_rows": 12}, {"cells": cells, "cell_rows": 5}):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.embedding_components(table, **extra).collect()}
        assert got == {i: (int(close[i].sum()), want[i], want[i] == i) for i in range(len(x))}


def test_guests_go_one_way_and_cells_in_passes(spark):
    """Without clusters a vector is a guest of most cells: pairs of cells meet once, and no pass sends many copies of a vector."""
    for k in range(1, 12):
        takes = embed_dedup._takes(np.arange(k), k)
        assert (takes ^ takes.T)[~np.eye(k, dtype=bool)].all()
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 8))
    x[300:] = x[:300] + 0.05 * rng.normal(size=(300, 8))
    u = x / np.linalg.norm(x, axis=1)[:, None]
    close = u @ u.T >= 0.98
    np.fill_diagonal(close, False)
    want = roots(len(x), np.argwhere(close).tolist())
    cells = {(0, 8): embed_dedup.spherical_kmeans(u, 20)}
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    nodes = spark.createDataFrame([(i, 0, 1, v.tolist()) for i, v in enumerate(x)], "node long, label long, mult long, v array<double>")
    shared = spark.sparkContext.broadcast((cells, embed_dedup._radii(nodes, cells)))
    whole = sorted((r.bucket, r.node) for r in embed_dedup._assign(nodes, shared, 0.98).collect())
    parts = [[(r.bucket, r.node) for r in embed_dedup._assign(nodes, shared, 0.98, 5, turn).collect()] for turn in range(5)]
    assert sorted(y for part in parts for y in part) == whole and max(map(len, parts)) < len(whole) / 2
    for extra in ({"pass_copies": 1.5}, {"pass_copies": 0.5, "tile_rows": 20}):
        got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.embedding_components(table, cells=cells, **extra).collect()}
        assert got == {i: (int(close[i].sum()), want[i]) for i in range(len(x))}


def test_shuffles_of_a_step_go_with_its_end(spark):
    import glob

    from plumbline.llm.common import RELEASE, materialize

    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before = files()
    kept = materialize(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.1)
    assert not left and kept.count() == 7 and spark.conf.get(RELEASE) == "false"


def test_embeddings_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (8, [1.0, -0.0], 1), (9, [1.0, 0.0, 0.0], 1), (None, [0.0, 1.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 as node", "2 as v")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in embed_dedup.embedding_components(table).collect())
    assert got == [(0, 0, 0, False)] + [(i, 0, i, True) for i in range(1, 8)] + [(8, 1, 8, True), (8, 1, 8, True), (9, 0, 9, True)]
    assert embed_dedup.embedding_components(table.where("false")).count() == 0


# ---- packing ----
def check_packing(rows, lengths, capacity):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(n for p in places.values() for _, n in p) == sorted(lengths)
    return len(places)


def test_packing_pieces_and_places(spark):
    import zlib

    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 150")
    odd = docs_of(spark, [(1000, ""), (1001, None), (1002, "<|endoftext|> x a<|endoftext|>b <|ENDOFTEXT|>c d<|StartOfText|>e. <|startoftext|>, <|endoftext|>F"), (1003, "Ünï\x1c\x1dcode\x85 ΣΑΣ ΟΔΟΣ it's 12345 é z"), (1004, "word " * 9000), (1004, "word " * 9000), (None, "x")])
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(odd)
    rows = packing.pack(docs.selectExpr("*", "1 as length", "2 as piece"), path).collect()
    want = []
    for r in docs.collect():
        ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want += [(r.doc_id or -1, k, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) if r.doc_id is not None else (-1, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted((-1 if False else w[0], *w[1:]) for w in want)
    n = check_packing(rows, [w[3] for w in want], 4096)
    assert n <= 1.02 * sum(w[3] for w in want) / 4096 + 1
    assert packing.pack(odd.where("false"), path).count() == 0


def plain_best(lengths, capacity):
    """The fewest sequences, by search."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in {r: j for j, r in enumerate(rooms)}.values():
            if rooms[k] >= lengths[i]:
                place(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1 :])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best[0]


def test_reduction_keeps_the_optimum():
    rng, sizes = random.Random(6), set()
    for k in range(600):
        lengths = [rng.randint(4 if k % 2 else 1, 20) for _ in range(rng.randint(1, 9))]
        counts = np.bincount(lengths, minlength=21)
        fixed = packing.reduce_instance(counts, 20)
        sizes |= {sum(k for _, k in items) for _, items in fixed}
        left = [s for s in range(21) for _ in range(int(counts[s]))]
        assert sum(m for m, _ in fixed) + (plain_best(left, 20) if left else 0) == plain_best(lengths, 20)
        assert sorted(left + [s for m, items in fixed for s, k in items for _ in range(m * k)]) == sorted(lengths)
        rest = packing.best_fit(counts, 20)
        assert sum(m * sum(s * k for s, k in items) for m, items in rest) == sum(left) and all(sum(s * k for s, k in items) <= 20 for _, items in rest)
    assert sizes == {1, 2, 3}


def test_reduction_on_a_long_range_of_lengths():
    """What is fixed leaves the lower bound reachable: best fit of the rest needs no more sequences than without the reduction."""
    rng = np.random.default_rng(13)
    for low, high, n in ((1, 4096, 3000), (1000, 4096, 20_000), (1300, 2800, 5000), (1, 300, 100_000)):
        counts = np.bincount(rng.integers(low, high + 1, n), minlength=4097)
        plain = sum(m for m, _ in packing.best_fit(counts.copy(), 4096))
        whole = packing.solve(dict(enumerate(counts.tolist())), 4096)
        used = np.zeros(4097, np.int64)
        for m, items in whole:
            assert sum(size * k for size, k in items) <= 4096
            for size, k in items:
                used[size] += m * k
        assert (used == counts).all()
        assert -(-int((np.arange(4097) * counts).sum()) // 4096) <= sum(m for m, _ in whole) <= plain


# ---- substrings ----
def plain_windows(g, window):
    """Every (l, c, r) of the Cartesian tree that is wide enough, by recursion."""
    out, todo = [], [(0, len(g) - 1)]
    while todo:
        lo, hi = todo.pop()
        if hi - lo + 1 >= window:
            c = lo + int(np.argmin(g[lo : hi + 1]))
            out.append((lo, c, hi))
            todo += [(lo, c - 1), (c + 1, hi)]
    return sorted(out, key=lambda x: x[1])


def test_compact_windows():
    rng = np.random.default_rng(7)
    for n, top in ((3, 9), (40, 2**60), (300, 2**60), (300, 20), (500, 3), (200, 1)):
        g = rng.integers(0, top, n).astype(np.uint64)
        for window in (2, 5, 47):
            assert list(zip(*(x.tolist() for x in substring.compact_windows(g, window)), strict=True)) == plain_windows(g, window)


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)]


def test_planted_passages(spark):
    rng = random.Random(8)
    passage, other, short = words(rng, 60), words(rng, 51), words(rng, 45)
    long = words(rng, 200)
    changed = long.copy()
    changed[100] = "changed"
    plan = {1: passage, 2: passage, 3: words(rng, 80), 4: other, 5: other, 6: short, 7: short, 8: long, 9: changed, 10: passage[:40], 11: words(rng, 300)}
    docs = docs_of(spark, [(i, "\n".join(words(rng, 30)) + " " + " ".join(p) + "  " + " ".join(words(rng, 25))) for i, p in plan.items()] + [(12, ""), (13, None), (None, " ".join(passage)), (14, "few words")])
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = substring.repeated_passages(docs.selectExpr("*", "1 as key", "2 as a", "3 as `with`")).collect()
    got = {(r.doc_id, r.of_doc) for r in rows}
    assert got == {(2, 1), (5, 4), (9, 8)}
    for r in rows:
        assert r.end_word - r.start_word >= 46
        assert len(text[r.doc_id][r.start_char : r.end_char].split()) == r.end_word - r.start_word
    two = next(r for r in rows if r.doc_id == 2)
    assert text[2][two.start_char : two.end_char] == " ".join(passage)
    left = {r.doc_id: (r.text, r.n_chars) for r in substring.remove_repeats(docs).collect()}
    assert len(left) == 15 and " ".join(passage) in left[1][0] and " ".join(passage) not in left[2][0] and left[2][1] == len(left[2][0])
    assert all(left[i][0] == text[i] for i in text if i not in (2, 5, 9))
    assert substring.repeated_passages(docs.where("false")).count() == 0


def test_copies_and_near_copies_are_found(spark):
    rng = random.Random(9)
    base = words(rng, 400)
    rows = [(1, " ".join(base))] + [(i, " ".join(base)) for i in range(2, 40)]
    for i in range(40, 60):
        w = base.copy()
        w[rng.randrange(400)] = "edit"
        rows.append((i, " ".join(w)))
    docs = docs_of(spark, rows)
    assert {r.doc_id for r in substring.repeated_passages(docs).collect()} == set(range(2, 60))
    assert {r.doc_id for r in substring.remove_repeats(docs).where("doc_id < 40").collect()} == {1}


def test_repetitions_within_a_document_are_all_found(spark):
    rng = random.Random(10)
    p = " ".join(words(rng, 60))
    filler = [" ".join(words(rng, 30)) for _ in range(4)]
    docs = docs_of(spark, [(1, f"{filler[0]} {p} {filler[1]}"), (2, f"{p} {filler[2]} {p} {filler[3]} {p}"), (3, "again " * 200), (4, "again " * 300)])
    got = {(r.doc_id, r.of_doc, r.start_word, r.end_word) for r in substring.repeated_passages(docs).collect()}
    assert got == {(2, 1, 0, 60), (2, 1, 90, 150), (2, 1, 180, 240), (4, 3, 0, 300)}


def test_against_brute_force_on_whole_documents(spark):
    """Every stretch of 51 equal words in an earlier document is inside a passage, and no passage is without a near one."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r.doc_id: r.text.lower().split() for r in docs.collect()}
    first: dict = {}
    for i in sorted(text):
        for k in range(len(text[i]) - 50):
            first.setdefault(" ".join(text[i][k : k + 51]), i)
    spans: dict = {}
    for r in substring.repeated_passages(docs).collect():
        spans.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
        grams = lambda w: {" ".join(w[k : k + 5]) for k in range(len(w) - 4)}
        mine = grams(text[r.doc_id][r.start_word : r.end_word])
        earlier = set().union(*(grams(text[j]) for j in text if j < r.doc_id))
        assert len(mine & earlier) >= 0.8 * len(mine)
    missing = [(i, k) for i in text for k in range(len(text[i]) - 50) if first[" ".join(text[i][k : k + 51])] < i and not any(a <= k and k + 51 <= b for a, b in spans.get(i, []))]
    assert not missing


def edited(rng, base, places):
    w = base.copy()
    for p in places:
        w[p] = "".join(rng.choice("klmnop") for _ in range(6))
    return w


def passage_family(rng, kind):
    """Versions of one passage without shifts."""
    if kind == "one edit":
        base = words(rng, rng.randint(51, 60))
        return [base, edited(rng, base, [rng.randrange(len(base))])]
    if kind == "an unlike first version":
        base = words(rng, 51)
        return [edited(rng, base, [24 + rng.randrange(-4, 1), 24 + rng.randrange(2, 6)]), base, edited(rng, base, [rng.randrange(51)])]
    if kind == "slots":
        base, values = words(rng, 60), [words(rng, 3) for _ in range(3)]
        family = [base.copy() for _ in range(8)]
        for w in family:
            for at, some in zip((14, 30, 46), values, strict=True):
                w[at] = rng.choice(some)
        return family
    base = words(rng, 150)  # one edit in 30 words
    return [base, edited(rng, base, [p + rng.randrange(20) for p in range(0, 150, 30)])]


def near(a, b):
    same = [a[i : i + 5] == b[i : i + 5] for i in range(min(len(a), len(b)) - 4)]
    return any(sum(same[i : i + 47]) >= 42 for i in range(len(same) - 46))


def test_recall_of_near_copies_of_passages(spark):
    """At least 0.98 of the documents that have a passage of similarity 0.8 and more with an earlier one, by brute force over their families."""
    rng, rows, body, like = random.Random(14), [], {}, {}
    for kind, n in (("one edit", 100), ("an unlike first version", 100), ("slots", 25), ("long", 50)):
        for _ in range(n):
            family = []
            for w in passage_family(rng, kind):
                i = len(rows)
                rows.append((i, " ".join(words(rng, rng.randint(0, 60)) + w + words(rng, rng.randint(0, 60)))))
                if any(near(w, body[j]) for j in family):
                    like.setdefault(kind, set()).add(i)
                body[i] = w
                family.append(i)
    got = {r.doc_id for r in substring.repeated_passages(docs_of(spark, rows)).collect()}
    assert not got - set().union(*like.values())
    for kind, want in like.items():
        assert len(want & got) >= 0.98 * len(want), kind


def test_surroundings_that_do_not_fit_in_a_task_are_dealt_by_class(spark):
    rng = random.Random(15)
    p = words(rng, 60)
    docs = docs_of(spark, [(i, " ".join(words(rng, 40) + edited(rng, p, [rng.randrange(60)]) + words(rng, 40))) for i in range(60)] + [(i, " ".join(words(rng, 30) + p)) for i in range(60, 90)])
    found = substring.windows(docs)
    want = {(r.a, r.b, r.diag) for r in substring.candidate_intervals(found).collect()}
    small = {(r.a, r.b, r.diag): (r.lo, r.hi) for r in substring.candidate_intervals(found, held_rows=3).collect()}
    assert {a for a, _, _ in small} == {a for a, _, _ in want} and all(hi - lo + 1 >= 47 for lo, hi in small.values())


def test_partners_do_not_depend_on_partitions_batches_or_limits(spark):
    rng, rows = random.Random(17), []
    for _ in range(25):
        p = words(rng, 70)
        rows += [" ".join(words(rng, rng.randint(0, 50)) + edited(rng, p, rng.sample(range(70), rng.randrange(3))) + words(rng, rng.randint(0, 50))) for _ in range(12)]
    hot = words(rng, 60)
    rows += [" ".join(words(rng, 20) + hot + words(rng, 20)) for _ in range(60)]
    rng.shuffle(rows)
    docs = docs_of(spark, list(enumerate(rows)))

    def found(partitions, held_rows, batch):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            return sorted(tuple(r) for r in substring.candidate_intervals(substring.windows(docs.repartition(partitions)), held_rows=held_rows).collect())
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")

    want = found(1, 500_000, "10000")
    assert len(want) > 300
    for partitions, held_rows, batch in ((13, 500_000, "10000"), (60, 500_000, "37"), (1, 20, "10000"), (13, 3, "10"), (4, 0, "64")):
        assert found(partitions, held_rows, batch) == want
    spans = [sorted(tuple(r) for r in substring.repeated_passages(docs.repartition(n)).collect()) for n in (1, 13)]
    assert spans[0] == spans[1] and len(spans[0]) > 250


def test_rows_that_repeat_an_id(spark):
    """Each row is cut by its own passages; of copies one row stays in the near-duplicate operators."""
    from plumbline.llm import near_copies

    rng = random.Random(16)
    p, free = words(rng, 60), " ".join(words(rng, 100))
    docs = docs_of(spark, [(1, " ".join(p)), (5, free), (5, " ".join(words(rng, 20) + p)), (7, " ".join(words(rng, 90)))])
    left = sorted((r.doc_id, len(r.text.split())) for r in substring.remove_repeats(docs).collect())
    assert left == [(1, 60), (5, 20), (5, 100), (7, 90)]
    again = docs_of(spark, [(5, free), (5, free), (6, free), (8, " ".join(p)), (9, " ".join(p)), (9, "something else that is short"), (None, free), (None, free)]).selectExpr("*", "1 as node", "2 as text_key")
    for drop in (simhash.drop_near_duplicates, near_copies.drop_near_copies):
        kept = drop(again)
        assert kept.columns == again.columns
        assert sorted((r.doc_id or 0, len(r.text.split())) for r in kept.collect()) == [(0, 100), (0, 100), (5, 100), (8, 60), (9, 5)]
