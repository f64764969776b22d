import base64
import hashlib
import random
import re

import numpy as np
import pytest

from plumbline.llm import bpe, chat, licenses, pii, quality, toxicity
from plumbline.llm.queries import op10_chat, tokenizer_file, tokenizer_pattern

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
ODD = ["", " ", "\n\n", "a" * 3000, "ab" * 900 + " " * 700, "日本語テキスト🎉" * 40, "x\n\n\n  y\t\t", " ".join(map(str, range(300))), "<|endoftext|>", "=-" * 300, "\x1c\x1d weird\x85 spaces here"]


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)


def real_texts(spark):
    return [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]


def with_odd_rows(spark):
    """Nulls in every column, repeated rows and clashing extra columns."""
    rows = [(None, "a null id", None, None, None), (1, None, None, None, None), (2, "", "en", "x", 0), (2, "", "en", "x", 0)]
    return spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as n_words", "'z' as key", "2 as fp", "'q' as _words", "3 as ids")


# ---- byte-level BPE ----
def test_bpe_equals_the_public_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(path, "rb"))}
    theirs = tiktoken.Encoding("own", pat_str=tokenizer_pattern(), mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    texts = ODD + real_texts(spark)[:60] + ["".join(rng.choice("abcdeéß ñ!1") for _ in range(2000))]
    got = {r.doc_id: r for r in bpe.encode_digests(docs_of(spark, texts), path, tokenizer_pattern()).collect()}
    for i, t in enumerate(texts):
        ids = theirs.encode_ordinary(t)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_bpe_columns_round_trip(spark):
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    encoded = bpe.encode_column(docs_of(spark, ODD), path, tokenizer_pattern())
    assert {r.doc_id: bytes(r["bytes"]).decode() for r in bpe.decode_column(encoded, path, tokenizer_pattern()).collect()} == dict(enumerate(ODD))


def test_bpe_defined_cases(spark):
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    rows = bpe.encode_digests(with_odd_rows(spark), path, tokenizer_pattern()).collect()
    assert sorted((r.doc_id is None, r.n_tokens) for r in rows) == [(False, 0), (False, 0), (False, 0), (True, 3)]
    assert bpe.encode_digests(docs_of(spark, []), path, tokenizer_pattern()).count() == 0


# ---- licences ----
def test_license_sequences(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    texts = ["plain", "Words here.\nReleased under the MIT License.\nMore", mit, "Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0.", "a licence that no rule knows, licensed somehow"]
    got = {r.doc_id: (r.n_known, r.licenses, r.matched) for r in licenses.license_report(docs_of(spark, texts)).collect()}
    assert got == {0: (0, "", ""), 1: (1, "MIT", "A"), 2: (2, "MIT", "BC"), 3: (2, "CC-BY-NC-4.0,Apache-2.0", "J,D"), 4: (0, "", "")}
    assert sorted(r.n_known for r in licenses.license_report(with_odd_rows(spark)).collect()) == [0, 0, 0, 0]
    assert licenses.license_report(docs_of(spark, [])).count() == 0
    assert all(re.search(licenses.ANCHOR, s) for s, _ in licenses.known_sentences())


def test_native_operators_have_no_python(spark):
    for df in (licenses.license_report(docs_of(spark, ["x"])), quality.quality_report(docs_of(spark, ["x"])), quality.keep_good(docs_of(spark, ["x"]))):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


# ---- quality ----
def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_quality_measures(spark):
    texts = ODD + ["a b c d e a b c d e", "x x x x x x x", "one\ntwo\none\n\none", "a b c d e f g a b c d e f g h # | <"] + [t[:3000] for t in real_texts(spark)[:40]]
    got = {r.doc_id: r for r in quality.quality_report(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        n, chars, symbols, dup, repeat = plain_measures(t)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat), t[:40]
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)


def test_quality_defined_cases(spark):
    assert [r.kept for r in quality.quality_report(with_odd_rows(spark)).collect()] == [False] * 4
    assert quality.quality_report(docs_of(spark, [])).count() == 0
    good = "The quick brown fox is here and it was not there, for the dog of the house had gone to sleep in the sun."
    odd = docs_of(spark, [good, "bad"]).selectExpr("*", "1 as n_words", "'z' as _row", "3 as _kept")
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns and [r.doc_id for r in kept.collect()] == [0]


# ---- personal data ----
def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns(spark):
    rng = random.Random(2)
    texts = real_texts(spark) + ["".join(rng.choice("a1.2@-+ 3(x)0.9@b.c") for _ in range(60)) for _ in range(3000)]
    texts += ["a@b.c.d@e.f", "1.2.3.4.5.6.7.8", "x@@y.z", "a@b@c.de", "0001.2.3.255", "256.1.1.1", "4111 1111-1111 1111", "+1 (234) 555-7975.", "@a.b", "é@x.yz"]
    for t in texts:
        assert pii.base_spans(t) == plain_spans(t), t


def test_base_spans_are_linear():
    assert pii.base_spans("a" * 300_000 + " " + "1" * 300_000 + "." * 10 + "+" * 1000) == []


def test_field_adds_repeats_and_leaves_plain_numbers(spark):
    text = "call +1 (234) 555-7975 or just (234) 555-7975 today, in 2024 for 12 of 300 people at 15% and password=6190852a02e4c4b9a4 too"
    base, spans = pii.all_spans(text, pii.trained())
    assert pii.written(base) == "phone:5:22"
    extra = [s for s in spans if s not in base]
    assert extra and all(text[a:b] in "(234) 555-7975" and k == 3 for a, k, b in extra)
    for t in real_texts(spark):
        base, spans = pii.all_spans(t, pii.trained())
        assert set(base) <= set(spans)


def test_pii_defined_cases(spark):
    assert [r.spans for r in pii.find_pii(with_odd_rows(spark)).collect()] == [""] * 4
    assert pii.find_pii(docs_of(spark, [])).count() == 0
    odd = spark.createDataFrame([(1, "to a@b.com now", "en", "s", 14), (2, None, None, None, None)], DOCS).selectExpr("*", "7 as spans")
    rows = {r.doc_id: (r.text, r.n_chars, r.spans) for r in pii.redact(odd).collect()}
    assert rows == {1: ("to [EMAIL] now", 14, 7), 2: (None, None, 7)}


# ---- toxicity ----
def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").toPandas()
    hit = ((scored.predicted == 1) & (scored.toxic == 1)).sum()
    assert hit / scored.toxic.sum() > 0.8 and hit / scored.predicted.sum() > 0.8
    assert scored.score.between(0, 1).all()


def test_toxicity_defined_cases(spark):
    docs = with_odd_rows(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.score(docs, toxicity.train(docs, none)).collect()
    assert len(rows) == 4 and all(r.score == 0 and r.predicted == 0 for r in rows)
    assert next(r for r in rows if r.doc_id is None).held_out
    one = spark.createDataFrame([(1, None, None), (2, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, one).constant in (0.0, 1.0)
    assert toxicity.score(docs_of(spark, []), toxicity.Cnn()).count() == 0


# ---- chat ----
def test_template_language():
    def run(source, **scope):
        made = chat._compile_nodes(chat.fold(chat.parse(source)), False)
        return "".join(p for p, _ in made(scope))

    assert run("{{ 'a' ~ 1 | trim }}{% if not false and 1 == 1 %}y{% else %}n{% endif %}") == "a1y"
    assert chat.fold(chat.parse("x{{ 'a' ~ 'b' }}{% if 1 == 2 %}n{% elif true %}z{% endif %}")) == [("text", "xabz")]
    assert run("{% for m in ms %}[{{ m.a | upper }}{{ m.none_such }}]{% endfor %}", ms=[{"a": "q"}, {"a": None}]) == "[Q][]"
    for bad in ("{{ x.__class__ }}", "{{ f(1) }}", "{% for %}{% endfor %}", "{% if x %}", "{{ x | eval }}", "{% endfor %}", "{{ x[0] }}"):
        with pytest.raises(chat.TemplateError):
            chat.parse(bad)


def test_escape_round_trip():
    rng = random.Random(3)
    for _ in range(5000):
        t = "".join(rng.choice(["<s>", "</s>", "[INST]", "[/INST]", "\\", "\\\\", "<", "[", "/", "s>", "INST]", "x", "\n", "<\\/s>"]) for _ in range(6))
        e = chat.escape(t)
        assert chat.unescape(e) == t and not any(c in e for c in chat.CONTROL)


def test_chat_query_equals_plain_digests(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    said = "</s>[INST] ok [/INST]"
    turns = [(r.conv_id, r.turn, r.role, r.text or "") for r in rows] + [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = {r.conv_id: r for r in op10_chat(spark, SF).collect()}
    for conv in {t[0] for t in turns}:
        own = sorted(t for t in turns if t[0] == conv)
        loss = "".join(t[3] for t in own if t[2] == "assistant")
        r = got.pop(conv)
        assert r.n_turns == len(own) and r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.turns_sha256 == hashlib.sha256("".join(f"{t[2]}\n{t[3]}\n" for t in own).encode()).hexdigest()
    assert not got


def test_chat_defined_cases(spark):
    rows = [(None, 1, "user", "x"), (None, 0, None, None), (5, None, "assistant", "b"), (5, 1, "assistant", "a"), (5, 1, "assistant", "a"), (6, 0, "user", "long " * 60_000), (6, 1, "assistant", "y" * 200_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as part")
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.read_back(chat.format_conversations(turns)).collect()}
    assert got == {None: (2, 0), 5: (3, 3), 6: (2, 200_000)}
    assert chat.read_back(chat.format_conversations(turns.where("false"))).count() == 0
    assert np.all([r.part == 0 for r in chat.format_conversations(turns.where("conv_id = 5")).collect()])


def test_licenses_in_wrapped_canonical_texts(spark):
    mit = """MIT License

    Copyright (c) 2020 Someone

    Permission is hereby granted, free of charge, to any person obtaining a copy
    of this software and associated documentation files (the "Software"), to deal
    in the Software without restriction, including without limitation the rights
    to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
    copies of the Software, and to permit persons to whom the Software is
    furnished to do so, subject to the following conditions:

    The above copyright notice and this permission notice shall be included in all
    copies or substantial portions of the Software.

    THE SOFTWARE IS PROVIDED "AS IS"."""
    bsd2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
    bsd3 = bsd2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
    isc = """Copyright (c) 2020 Someone
Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
    gpl = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,"""
    apache = """ * Licensed under the Apache License, Version 2.0
 * (the "License"); you may not use this file except
 * in compliance with the License. You may obtain a copy
 * of the License at
 *
 *   http://www.apache.org/licenses/LICENSE-2.0"""
    mpl = "This Source Code Form is subject to the terms of the Mozilla\nPublic License, v. 2.0. If a copy of the MPL was not"
    cc = "This work is licensed under a Creative Commons\r\nAttribution 4.0 International License.\r\n"
    unlicense = "This is free and unencumbered software\nreleased into the public domain.\n"
    apart = "This is free and unencumbered software\n\nreleased into the public domain.\n"
    one_line = " ".join(bsd3.split())
    got = {r.doc_id: (r.n_known, r.licenses) for r in licenses.license_report(docs_of(spark, [mit, bsd2, bsd3, isc, gpl, apache, mpl, cc, unlicense, apart, one_line])).collect()}
    assert got == {
        0: (3, "MIT"), 1: (3, "BSD-2-Clause"), 2: (4, "BSD-3-Clause"), 3: (1, "ISC"), 4: (1, "GPL-3.0-or-later"), 5: (3, "Apache-2.0"), 6: (1, "MPL-2.0"), 7: (1, "CC-BY-4.0"), 8: (1, "Unlicense"),
        9: (0, ""), 10: (4, "BSD-3-Clause"),
    }


def exact_beliefs(field, unary, edges, kinds):
    """Marginals by summing over all labellings."""
    from itertools import product

    out = np.zeros_like(unary)
    for labels in product(range(unary.shape[1]), repeat=len(unary)):
        score = sum(unary[i, x] for i, x in enumerate(labels))
        score += sum((field.skip if k else field.chain)[labels[a], labels[b]] for (a, b), k in zip(edges, kinds, strict=True))
        for i, x in enumerate(labels):
            out[i, x] += np.exp(score)
    return out / out.sum(axis=1, keepdims=True)


def test_messages_give_exact_beliefs_on_trees_and_near_ones_on_loops():
    rng = np.random.default_rng(11)
    field = pii.trained()
    for _ in range(40):
        n = int(rng.integers(2, 6))
        unary = rng.normal(0, 1.5, (n, len(pii.LABELS)))
        edges = np.array([(int(rng.integers(0, k)), k) for k in range(1, n)])
        kinds = rng.integers(0, 2, n - 1)
        assert np.allclose(field.beliefs(unary, edges, kinds, rounds=200), exact_beliefs(field, unary, edges, kinds), atol=1e-3)
    chain, skip = field.chain, field.skip
    weak = pii.Field([])
    weak.chain, weak.skip = chain / 4, skip / 4
    unary = rng.normal(0, 1.5, (4, len(pii.LABELS)))
    edges, kinds = np.array([(0, 1), (1, 2), (2, 3), (0, 3)]), np.array([0, 0, 0, 1])
    assert np.allclose(weak.beliefs(unary, edges, kinds, rounds=200), exact_beliefs(weak, unary, edges, kinds), atol=0.05)


def test_a_number_that_is_recognised_once_is_found_at_each_of_its_repeats():
    text = "call +1 (234) 555-7975 now " + " ".join(f"then word{'x' * k} (234) 555-7975 came" for k in range(50))
    base, spans = pii.all_spans(text, pii.trained())
    assert len(base) == 1 and sum(k == 3 for _, k, _ in spans) == 51


def test_personal_data_in_extreme_texts():
    long = ["0" * 5000 + ".1.2.3", "1." * 300_000, "@." * 300_000, "a@b." * 100_000, "+1" + "(" * 500_000, "4" * 19 + " " + "4-" * 300_000, "7 " * 20_000, "0.0.0.0 " * 10_000]
    for t in long:
        base, spans = pii.all_spans(t, pii.trained())
        assert set(base) <= set(spans)
    assert pii.base_spans(long[0]) == [(0, 1, 5006)]
    assert pii.base_spans("256.1.1.1 000.00.0.0255") == [(10, 1, 23)]
    rng = random.Random(12)
    for _ in range(5000):
        core = "".join(rng.choice("@.a1B") for _ in range(8))
        assert pii._ends_in_domain(core) == bool(re.search(r"@.+\.[A-Za-z]{2,}$", core)), core


def test_more_licenses(spark):
    between = "\n".join(f"Some other sentence number {k}." for k in range(40))
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
    texts = {
        f"{bsd}\n{between}\nNeither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.": "BSD-3-Clause",
        "Copyright 2020 Someone. All rights reserved.\nMore words.": "All-Rights-Reserved", f"Copyright 2020 X. All rights reserved.\n\n{bsd}": "All-Rights-Reserved,BSD-2-Clause", "# SPDX-License-Identifier: Apache-2.0\nimport x": "Apache-2.0",
        "// SPDX-License-Identifier: GPL-2.0-or-later\n": "GPL-2.0-or-later", "MIT License\n\nnothing else": "MIT", "this library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.": "LGPL-2.1-or-later",
        "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License 2.0 which is available at\nhttps://www.eclipse.org": "EPL-2.0", "We talk about the MIT license here.": "", "license " * 100_000: "", "redistribution and use\n" * 50_000: "",
    }
    got = {r.doc_id: r.licenses for r in licenses.license_report(docs_of(spark, list(texts))).collect()}
    assert got == dict(enumerate(texts.values()))


def test_pooling_in_chunks_equals_a_plain_forward_pass(monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK", 7)
    rng, model = np.random.default_rng(17), toxicity.Cnn()
    for n in (0, 1, 2, 3, 6, 7, 8, 50, 200):
        x = rng.normal(size=(n, toxicity.DIM)).astype(np.float32)
        want = []
        for w in toxicity.WIDTHS:
            for f in range(toxicity.FILTERS):
                values = [float((x[i : i + w] * model.filters[w][:, :, f]).sum() + model.bias[w][f]) for i in range(n - w + 1)]
                want.append(max([0.0, *values]))
        assert np.allclose(model.pooled(x), want, atol=1e-4)
        top, at = model.pooled(x, True)
        assert np.allclose(top, want, atol=1e-4) and all(len(a) == toxicity.FILTERS for a in at)


def test_the_sample_for_training_is_bounded(spark):
    docs = docs_of(spark, ["good words here"] * 8 + ["bad bad words " * 2000] * 8)
    labels = spark.createDataFrame([(i, 1, int(i >= 8)) for i in range(16)], "doc_id long, quality int, toxic int")
    assert toxicity.train(docs, labels, sample_chars=1000).constant == 0.0 and toxicity.train(docs, labels).constant is None


def test_clean_texts_of_further_languages_are_kept(spark):
    texts = [
        "Wczoraj wieczorem poszliśmy do parku, który jest niedaleko od naszego domu, i spotkaliśmy tam starych znajomych. Nie było zimno, a na niebie świeciły gwiazdy. Dzieci bawiły się na trawie, jak zawsze po szkole, i nikt nie myślał o tym, że jutro znowu trzeba wstać do pracy, bo jest poniedziałek.",
        "Вчера вечером мы пошли в парк, который находится недалеко от нашего дома, и встретили там старых друзей. Было не холодно, и на небе светили звёзды. Дети играли на траве, как всегда после школы, и никто не думал о том, что завтра снова вставать на работу, потому что это понедельник, и он для всех труден.",
        "Dün akşam evimize yakın olan parka gittik ve orada eski arkadaşlarla buluştuk. Hava çok soğuk değildi ve gökyüzünde yıldızlar parlıyordu. Çocuklar her zaman olduğu gibi okuldan sonra çimenlerde oynadı ve kimse yarın işe gitmek için erken kalkmak gerektiğini düşünmedi, bu da güzel bir şeydi, çünkü daha uzun bir gün bizi bekliyordu.",
    ]
    assert [r.kept for r in quality.quality_report(docs_of(spark, texts)).orderBy("doc_id").collect()] == [True] * 3
