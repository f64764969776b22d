import random

import corpus_pipeline
from plumbline.llm import near_copies, pii, quality
from plumbline.llm.queries import tokenizer_file

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    stop = ("the", "of", "and", "to", "in")
    return [rng.choice(stop) if rng.random() < 0.3 else "".join(rng.choice("abcdefghiklmnoprst") for _ in range(rng.randint(3, 8))) for _ in range(n)]


def fixture(spark):
    rng = random.Random(11)
    passage, base = prose(rng, 60), prose(rng, 150)
    texts = {
        1: " ".join(base), 2: " ".join(base), 3: " ".join(prose(rng, 90)), 4: " ".join(prose(rng, 30) + passage + prose(rng, 30)), 5: " ".join(prose(rng, 20) + passage + prose(rng, 40)),
        6: "### *** ||| " * 40, 7: " ".join(prose(rng, 50)) + " mail jo.do@mail.example.com or +1 (234) 555-7975 now", 8: "", 9: None, 10: "too short", 11: " ".join(prose(rng, 6000)),
    }
    rows = [(i, t, "en" if i % 2 else None, None if i == 3 else "s", len(t or "")) for i, t in texts.items()]
    return spark.createDataFrame(rows, DOCS), texts, passage


def staged(spark, docs):
    out = []
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, "")
        out.append(docs)
    return out


def test_stages_take_effect(spark):
    docs, texts, passage = fixture(spark)
    good, near, cut, masked, packed = staged(spark, docs)
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    assert ids(good) == [1, 2, 3, 4, 5, 7, 11] and ids(near) == [1, 3, 4, 5, 7, 11]
    after = {r.doc_id: r for r in cut.collect()}
    p = " ".join(passage)
    assert sorted(after) == [1, 3, 4, 5, 7, 11] and p in after[4].text and p not in after[5].text and after[5].text == texts[5].replace(p, "") and after[5].n_chars == len(after[5].text)
    assert all(after[i].text == texts[i] for i in (1, 3, 4, 7, 11))
    safe = {r.doc_id: r.text for r in masked.collect()}
    assert "[EMAIL]" in safe[7] and "[PHONE]" in safe[7] and not pii.base_spans(safe[7]) and safe[3] == texts[3]
    for df in (good, near, cut, masked):
        assert df.columns == docs.columns and [f.dataType for f in df.schema] == [f.dataType for f in docs.schema]
    pieces = packed.collect()
    assert {r.doc_id for r in pieces} == set(safe) and max(r.piece for r in pieces if r.doc_id == 11) >= 1
    room: dict = {}
    for r in pieces:
        room[r.sequence_id] = room.get(r.sequence_id, 0) + r.length
    assert max(room.values()) <= 4096


def test_run_equals_the_stages(spark, tmp_path):
    docs, _, _ = fixture(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    run = sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "piece", "length", "ids_crc32").collect()))
    assert run == sorted(map(tuple, staged(spark, docs)[-1].select("doc_id", "piece", "length", "ids_crc32").collect()))


def test_stages_with_odd_tables(spark):
    docs, _, _ = fixture(spark)
    odd = docs.unionByName(docs.where("doc_id = 3")).unionByName(spark.createDataFrame([(None, " ".join(prose(random.Random(1), 40)), None, None, None)], DOCS))
    odd = odd.selectExpr("*", "1 as n_words", "'x' as _cuts", "2 as fp", "'y' as component_id", "3 as _kept", "4 as a", "5 as length")
    for df, copies in zip(staged(spark, odd)[:-1], (2, 1, 1, 1), strict=True):  # of repeated rows one stays from the second stage on
        rows = df.collect()
        assert df.columns == odd.columns and sum(r.doc_id == 3 for r in rows) == copies and sum(r.doc_id is None for r in rows) == 1
    for df in staged(spark, odd.where("false")):
        assert df.count() == 0
    assert quality.keep_good(odd).columns == odd.columns and tokenizer_file("word_bpe_49k.json")


def jaccard(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / len(x | y)


def test_near_copies_equal_brute_force(spark):
    rng = random.Random(5)
    texts, bases = {}, [prose(rng, rng.randint(150, 400)) for _ in range(12)]
    for base in bases:
        texts[len(texts) + 1] = " ".join(base)
        for share in (0.005, 0.01, 0.015, 0.02, 0.03, 0.05):
            copy = list(base)
            for at in rng.sample(range(len(copy)), max(1, int(share * len(copy)))):
                copy[at] = prose(rng, 1)[0] + "x"
            texts[len(texts) + 1] = " ".join(copy)
    pairs = [(a, b) for a in texts for b in texts if a < b and jaccard(texts[a], texts[b]) >= 0.8]
    assert {int(20 * jaccard(texts[a], texts[b])) for a, b in pairs} >= {16, 17, 18}  # 0.80 to 0.95
    root = {i: i for i in texts}
    for _ in texts:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], DOCS)
    kept = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert kept == sorted(set(root.values())) and len(kept) < len(texts) / 2
    for tile_rows in (3, 8):  # components over many tiles
        assert {r.doc_id: r.component_id for r in near_copies.near_copy_components(docs, tile_rows=tile_rows).collect()} == root
