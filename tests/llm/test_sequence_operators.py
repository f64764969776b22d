import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import fim, prefix_trie
from plumbline.llm.scans import Running, running_sums

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TURNS = "conv_id long, turn long, role string, text string"
SF = "/root/testdata/sf0.01"


# ---- running sums ----
@pytest.mark.parametrize("partitions", ["1", "3", "17"])
def test_running_sums_over_tasks(spark, partitions):
    rng, p, b = random.Random(3), 2147483647, 1103515245
    sizes = {0: 900, 1: 1, 2: 30, 3: 1, 7: 250}
    rows = [(g, i, rng.randrange(-5, 2**31)) for g, n in sizes.items() for i in range(n)]
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        table = spark.createDataFrame(rows, "g long, i long, v long").repartition(5)
        got = running_sums(table, "g", ["i"], [Running("s", "v", "s0"), Running("h", "v", "h0", b, p)], ["i"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want, plain, poly = set(), defaultdict(int), defaultdict(int)
    for g, i, v in sorted(rows):
        was = plain[g], poly[g]
        plain[g] += v
        poly[g] = (poly[g] + v * pow(b, i + 1, p)) % p
        want.add((g, i, i + 1, plain[g], was[0], poly[g], was[1]))
    assert {(r.g, r.i, r.position, r.s, r.s0, r.h, r.h0) for r in got} == want and len(got) == len(rows)


# ---- prefix trie ----
def plain_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    below = defaultdict(list)
    for node in members:
        if node:
            below[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in below[node]) if below[node] else 1
        saved[node] = sum(saved[x] for x in below[node]) + (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted(
        (min(m), len(x), -1 if not x else min(members[x[:-1]]), len(m), len(below[x]), leaves[x], saved[x], hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(x)))).encode()).hexdigest())
        for x, m in members.items()
    )


def trie_rows(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


@pytest.mark.parametrize("seed", range(4))
def test_trie_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), 160):
        shared = rng.random() < 0.5
        for t in range(rng.choice([1, 2, 3, 8, 9, 10, 14, 40])):
            rows.append((c, t, "user", "same" if shared else rng.choice(["a", "b", "ñandú", ""])))
    rng.shuffle(rows)
    assert trie_rows(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == plain_trie(rows)


def test_trie_of_ever_longer_and_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_CHARS", 12)
    monkeypatch.setattr(prefix_trie, "COPY_ROWS", 3)
    ladder = [(10 * c, t, "user", "x") for c in range(70) for t in range(c + 1)]
    copies = [(10_000 + 5 * c, t, "user", f"y{t}") for c in range(60) for t in range(12)]
    alike = [(20_000, 1, "user", "again")] * 25
    rows = ladder + copies + alike
    assert trie_rows(prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == plain_trie(rows)


def test_trie_of_the_given_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(prefix_trie.prefix_trie(table)) == plain_trie(rows)


def test_trie_defined_cases(spark):
    rows = [(None, 0, "user", "lost"), (3, None, None, "first"), (3, 0, "user", None), (3, 0, "user", None), (1, 5, "", ""), (4, 1, "user", "x" * 1_200_000), (9, 1, "user", "x" * 1_200_000), (-7, 0, "user", "q")]
    table = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 as position", "2 as k1", "3 as seg", "'z' as conv", "4 as depth")
    assert trie_rows(prefix_trie.prefix_trie(table.where("conv_id is null or conv_id >= 0"))) == plain_trie([r for r in rows if r[0] is None or r[0] >= 0])
    assert prefix_trie.prefix_trie(table.where("conv_id < 0")).count() >= 1
    assert prefix_trie.prefix_trie(table.where("false")).count() == 0 == prefix_trie.prefix_trie(table.where("conv_id is null")).count()


# ---- fill-in-middle ----
UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_fim(doc_id, text):
    units = UNITS.findall(text)
    n, hexed = len(units), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[k : k + 8], 16) for k in (0, 8, 16, 24))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ODD = ["", " ", "\n\n \t", "a", " a", "a ", "  two  words \x0b\x0c", "no break\xa0space here\x85 x\x1c", "日本 語🎉 \r\n é", "<", "<P", "a <P> b", "a<S>b", "x <M>", "<<P>>", "< P>", "end <", "S> <P x"]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1 << 20])
def test_units_by_events(block):
    rng = random.Random(block)
    texts = ODD + ["".join(rng.choice("ab \n\t<PSM>é") for _ in range(rng.randrange(60))) for _ in range(300)]
    for t in texts:
        found, ends = fim.Units(t, block=block), [0, *np.cumsum([len(x) for x in UNITS.findall(t)]).tolist()]
        assert found.n == len(ends) - 1 and [found.end(k) for k in range(found.n + 1)] == ends and found.marked == bool(re.search("<[PSM]>", t))


def test_fim_equals_brute_force_and_restores(spark):
    rng = random.Random(8)
    texts = ODD * 4 + ["".join(rng.choice("ab \n\t<é") for _ in range(rng.randrange(90))) for _ in range(200)] + ["word " * 300_000, "x" * 1_500_000, " " * 1_100_000]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, None, "en", "s", 1), (None, "a b c d", "en", "s", 1), (3, "twice here", "en", "s", 1), (3, "twice here", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as n", "'z' as form", "'q' as output")
    made = fim.fill_in_middle(docs).withColumn("back", fim.restored()).collect()
    key = lambda r: (r[0] is None, r[0] or 0, len(r[1]), r[1])
    want = [(i, *plain_fim(i, t or ""), t or "") for i, t, *_ in rows]
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in made]
    assert sorted(got, key=lambda r: key((r[0], r[6]))) == sorted(want, key=lambda r: key((r[0], r[6])))
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    digests = {(r.doc_id, r.output_sha256, r.restored_sha256) for r in fim.fim_digests(docs).collect()}
    assert digests == {(r[0], hashlib.sha256(r[5].encode()).hexdigest(), hashlib.sha256(r[6].encode()).hexdigest()) for r in got}
    assert fim.fim_digests(docs.where("false")).count() == 0


def test_fim_parameters(spark):
    docs = spark.createDataFrame([(i, "one two three four", "en", "s", 0) for i in range(200)], DOCS)
    forms = fim.fill_in_middle(docs, seed=7, fim_percent=100, spm_percent=0, sentinels=("[pre]", "[suf]", "[mid]"))
    assert {r.form for r in forms.collect()} == {"psm"}
    assert forms.where(fim.restored(sentinels=("[pre]", "[suf]", "[mid]")) != F.lit("one two three four")).count() == 0
