"""Language ID, toxicity, packing, personal data, licences, decontamination:
small fixtures against brute force, and the defined edge cases."""

import os
import zlib

import numpy as np
import pytest

from zonelake.llm import decontaminate, langid, licenses, oracle, packing, pii, toxicity
from zonelake.llm.registry import tokenizer_path

DOCS = "doc_id long, text string, lang string, score string, `row` int"


def odd_docs(spark):
    """Nulls, empties, ties, repeated rows, long texts and clashing columns."""
    en, de = "the cat sat on the mat and ate", "der hund und die katze nicht schön"
    rows = [(1, en, "en", "x", 1), (1, en, "en", "x", 1), (2, None, None, None, None), (3, "", "en", "x", 2),
            (None, de, "de", "y", 3), (4, de * 3, "de", None, 4), (5, "123 .. !!", "en", "z", 5),
            (6, (en + " ") * 3000, "en", "z", 6), (7, de, "de", "y", 7)]
    return spark.createDataFrame(rows, DOCS)


def test_language_id_edges(spark):
    docs = odd_docs(spark)
    model = langid.train(docs)
    got = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    assert langid.predict(docs, model).count() == 9
    assert got[1]["lang_pred"] == "en" and got[7]["lang_pred"] == got[None]["lang_pred"] == "de"
    for k in (2, 3, 5):
        assert (got[k]["lang_pred"], got[k]["score"]) == ("und", 0.0)
    kept = langid.keep_known(docs, model)
    assert kept.schema == docs.schema and kept.count() == 6
    empty = docs.where("false")
    assert langid.train(empty).starts == []
    assert langid.predict(docs, langid.train(empty)).where("lang_pred != 'und'").count() == 0


def test_language_scores_match_a_plain_sum(spark):
    docs = odd_docs(spark)
    model = langid.train(docs, bits=10)
    text = "the mat und schön"
    ids, starts, counts, _ = langid.gram_ids(["katze", text], 10)
    span = slice(starts[1], starts[1] + counts[1])
    block = model.block(0)
    logs = [float(row[ids[0][span]].sum() + row[ids[1][span]].sum()) + p
            for row, p in zip(block.log_prob.astype(float), block.log_prior)]
    asked = spark.createDataFrame([(1, "katze"), (2, text)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in langid.predict(asked, model).collect()}
    assert got[2]["lang_pred"] == block.names[int(np.argmax(logs))]
    assert got[2]["score"] == pytest.approx(1 / np.exp(np.array(logs) - max(logs)).sum(), rel=1e-4)


def test_languages_in_blocks_give_the_same(spark):
    rng = np.random.default_rng(4)
    rows = [(k, " ".join("".join(rng.choice(list("abcdefgh")[k % 7:k % 7 + 2], 5)) for _ in range(6)), f"l{k % 7}", 0, 0.5)
            for k in range(70)] + [(70, None, "l1", 0, 0.5), (71, "12", "l2", 0, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, best_mass long, best_log double")
    whole, cut = langid.train(docs, bits=8), langid.train(docs, bits=8, block_languages=3)
    assert [len(m.starts) for m in (whole, cut)] == [1, 3]
    a, b = (sorted(langid.predict(docs, m).collect()) for m in (whole, cut))
    assert [r[:2] for r in a] == [r[:2] for r in b]
    assert np.allclose([r[2] for r in a], [r[2] for r in b], rtol=1e-9)
    kept = langid.keep_known(docs, cut)
    assert kept.schema == docs.schema and kept.count() == langid.keep_known(docs, whole).count() > 0


def test_toxicity_learns_and_handles_edges(spark):
    rng = np.random.default_rng(0)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choice(words, 40)) for _ in range(240)]
    bad = [k for k in range(240) if k % 3 == 0]
    for k in bad:
        texts[k] += " awful creature"
    docs = spark.createDataFrame([(k, t, "en" if k % 2 else "de") for k, t in enumerate(texts)]
                                 + [(900, None, None), (901, "", "en"), (None, "w1", "en")],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k in bad)) for k in range(200)] + [(None, 1), (3, 1)],
                                   "doc_id long, toxic int")
    net = toxicity.train(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, net).collect()}
    assert len(got) == 243
    right = sum((got[k] >= 0.3) == (k in bad) for k in range(200, 240))
    assert right >= 36
    assert 0 <= got[900] == got[901] <= 1
    nothing = toxicity.train(docs, labels.where("toxic = 1"))
    assert nothing is None and toxicity.score(docs, nothing).where("score != 0").count() == 0


def test_packing_round_trip(spark):
    docs = odd_docs(spark)
    path = tokenizer_path("word_bpe_49k.json")
    rows = [r.asDict() for r in packing.packed_documents(docs, path, capacity=64).collect()]
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for doc, own in by_doc.items():
        ids = np.array(plain.encode(texts[doc], add_special_tokens=False).ids + [1], dtype="<u4")
        copies = 2 if doc == 1 else 1
        assert sum(r["length"] for r in own) == copies * len(ids)
        for r in own:
            assert zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
            assert r["doc_tokens"] == len(ids)
    by_sequence: dict = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    full = packing.sequences(docs, path, capacity=64).collect()
    assert len(full) == len(by_sequence)
    assert all(len(r["ids"]) == 64 or len(r["ids"]) & (len(r["ids"]) - 1) == 0 for r in full)
    assert packing.packed_documents(docs.where("false"), path).count() == 0


@pytest.mark.parametrize("text", ["it's DON'T 'll x's", "\x1c a\x1db\x85c ᠎ d​q", "ÀÉ éa. İİa ŉx ǅ µ! ªº",
                                  "é ﬁ ΑΣ ΑΣ.", "<|endoftext|> hi", "a,b. c!? 1a2 ..."])
def test_chunk_encoder_equals_the_tokenizer(text):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    got = np.frombuffer(packing.ChunkEncoder(path).encode([text])[0], "<u4").tolist()
    assert got == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_patterns_cover_the_demand_close_to_the_bound():
    rng = np.random.default_rng(2)
    for top in (3, 40):
        demand = rng.integers(0, top, 64)
        size = np.arange(1, 65)[demand > 0]
        demand = demand[demand > 0]
        plan = packing.pattern_plan(size, demand, 64)
        assert (sum(p * n for p, n in plan) >= demand).all()
        assert all((p * size).sum() <= 64 for p, _ in plan)
        bound = (size * demand).sum() / 64
        assert sum(n for _, n in plan) <= bound * 1.03 + 4


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(4)
    for _ in range(4000):
        text = "".join(rng.choice(list("a1@.-+ (92)4"), rng.integers(0, 30)))
        want = sorted((m.start(), k, m.end()) for k, kind in enumerate(pii.KINDS)
                      for m in pii.BASE[kind].finditer(text) if pii.valid(kind, m.group()))
        assert pii.base_spans(text) == want


def test_wide_spans_equal_the_patterns():
    rng = np.random.default_rng(6)
    parts = ["a", "b.c", " ", "(at)", "[at]", "(dot)", ".", "@", "x-y", "555", "(212)", "-", "0199", "/", "4111", "+1 ", "é"]
    for _ in range(4000):
        text = "".join(rng.choice(parts, rng.integers(0, 14)))
        base = pii.base_spans(text)
        want, taken = [], [(s, e) for s, _, e in base]
        for s, k, e in sorted((m.start(), pii.KINDS.index(kind), m.end()) for kind, pattern in pii.WIDE.items()
                              for m in pattern.finditer(text)):
            if all(e <= a or b <= s for a, b in taken):
                want.append((s, k, e))
                taken.append((s, e))
        assert pii.wide_spans(text, base) == want, text


def test_personal_data_reads_long_runs_once():
    import time

    start = time.perf_counter()
    for text in ("0" * 5000 + ".1.1.1", "a" * 1_000_000 + " at", "1" * 1_000_000 + ".", "at (at)" * 100_000,
                 "1.2." * 200_000, "a@" * 300_000, "+1" * 300_000, "a (at) b (dot) " * 50_000):
        pii.wide_spans(text, pii.base_spans(text))
    assert pii.base_spans("0" * 5000 + ".1.1.1") == [(0, 1, 5006)]
    assert pii.base_spans("0" * 4000 + "256.1.1.1") == []
    assert time.perf_counter() - start < 10


def test_personal_data_keeps_base_and_masks(spark):
    rows = [(1, "mail a.b@c.org or 10.1.2.3"), (2, None), (3, ""), (None, "call +1 (212) 555-0100 now"),
            (4, "card 4111 1111 1111 1111"), (5, "ip 300.1.2.3 card 4111 1111 1111 1112"),
            (6, "phone (212) 555-0199 ok")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.fit(docs)
    got = {r["doc_id"]: r for r in pii.find(docs, model).collect()}
    assert [s["kind"] for s in got[1]["base"]] == ["email", "ip"]
    assert got[2]["spans"] == got[3]["spans"] == got[5]["base"] == []
    assert set(map(tuple, got[1]["base"])) <= set(map(tuple, got[1]["spans"]))
    masked = {r["doc_id"]: r["text"] for r in pii.mask(docs, model).collect()}
    assert masked[1] == "mail <EMAIL> or <IP>" and masked[2] is None
    assert masked[None] == "call <PHONE> now"
    assert pii.find(docs.where("false"), pii.fit(docs.where("false"))).count() == 0


def test_licences(spark):
    text = ('Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in '
            "compliance with the License.\nYou may obtain a copy of the License at\n\n  http://x\n\nUnless required "
            "by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an "
            '"AS IS" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n')
    docs = spark.createDataFrame(
        [(1, text), (2, "Some text.\nReleased under the MIT License.\nReleased under the MIT license."),
         (3, None), (4, ""), (None, "Licensed under CC BY-NC 4.0."), (5, "No license here at all.")],
        "doc_id long, text string")
    got = {(r["doc_id"], r["license"], r["rule"].count("+") + 1, r["n_matches"]) for r in licenses.scan(docs).collect()}
    assert got == {(1, "Apache-2.0", 4, 1), (2, "MIT", 1, 2), (None, "CC-BY-NC-4.0", 1, 1)}
    assert licenses.scan(docs.where("false")).count() == 0


GPL = ("This program is free software{0} you can redistribute it and/or modify\nit under the terms of the GNU General "
       "Public License as published by\nthe Free Software Foundation{1} either version {2} of the License, or\n(at your "
       "option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY "
       "WARRANTY{0} without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n"
       "GNU General Public License for more details.\n")
BSD2 = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the "
        "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n"
        "   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above "
        "copyright notice,\n   this list of conditions and the following disclaimer in the documentation.\n")
APACHE = 'Licensed under the Apache License, Version 2.0 (the "License");\n'
LIBRARY = ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General "
           "Public\nLicense as published by the Free Software Foundation; either\nversion {0} of the License, or (at your "
           "option) any later version.\n\nThis library is distributed in the hope that it will be useful,\nbut WITHOUT ANY "
           "WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.\n")
CC = "This work is licensed under the Creative Commons Attribution{0} 4.0 International License."
#: The notices as their licences print them.
NOTICES = [
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated '
            'documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation '
            'the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, '
            'and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe '
            'above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of '
            'the Software.\n'),
    ("Apache-2.0", APACHE + "you may not use this file except in compliance with the License.\nYou may obtain a copy of the "
                   "License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or "
                   "agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\n"
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n"),
    ("GPL-3.0-or-later", GPL.format(":", ",", 3)), ("GPL-3.0-or-later", GPL.format(";", ";", 3)),
    ("GPL-3.0-or-later", GPL.format(",", ",", 3)), ("GPL-2.0-or-later", GPL.format(";", ";", 2)),
    ("GPL-2.0-or-later", GPL.format(":", ",", 2)), ("GPL-2.0-or-later", GPL.format(",", ",", 2)),
    ("BSD-2-Clause", BSD2),
    ("BSD-3-Clause", BSD2 + "\n3. Neither the name of the copyright holder nor the names of its\n   contributors may be used "
                     "to endorse or promote products derived from\n   this software without specific prior written "
                     "permission.\n"),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT license."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", APACHE),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL "
                "was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/.\n"),
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby "
            "granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n"),
    ("LGPL-2.1-or-later", LIBRARY.format("2.1")), ("LGPL-3.0-or-later", LIBRARY.format("3")),
    ("AGPL-3.0-or-later", GPL.format(":", ",", 3).replace("GNU General Public\nLicense", "GNU Affero General Public License")
     .replace("GNU General \nPublic License", "GNU Affero General Public License")
     .replace("GNU General Public License as", "GNU Affero General Public License as")),
    ("Zlib", "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be "
             "held liable for any damages\narising from the use of this software.\n\nPermission is granted to anyone to use "
             "this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\n"
             "freely, subject to the following restrictions:\n"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt)\n"),
    ("EPL-2.0", "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public "
                "License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/\n\nMore.\n"),
    ("CC-BY-SA-4.0", CC.format("-ShareAlike")), ("CC-BY-NC-4.0", CC.format("-NonCommercial")),
    ("CC-BY-ND-4.0", CC.format("-NoDerivatives")), ("CC-BY-NC-SA-4.0", CC.format("-NonCommercial-ShareAlike")),
]


def test_licences_equal_the_statement(spark):
    import duckdb

    texts = [t for _, t in NOTICES]
    odd = [None, "", "  \n\n ", "No license: here!", " Released under the MIT license. \n \n\tReleased under the MIT License!",
           "Released under\nthe MIT License.\nReleased under the MIT License.", "free-software. This program is free-software:",
           "".join(texts), "\n".join(reversed(texts)), texts[0] * 3 + texts[2], "x " * 50000 + texts[-1]]
    rows = [(k % 17 or None, t) for k, t in enumerate(texts + texts[:3] + odd)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = con.sql(oracle.licenses()).fetchall()
    key = lambda r: (r[0] or 0, *r[1:])
    assert sorted(map(tuple, licenses.scan(docs).collect()), key=key) == sorted(want, key=key) and len(want) > 40


def test_licences_of_the_notices_as_printed(spark):
    docs = spark.createDataFrame([(k, text) for k, (_, text) in enumerate(NOTICES)], "doc_id long, text string").cache()
    got = {}
    for r in licenses.scan(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["license"], r["n_matches"]))
    assert got == {k: [(name, 1)] for k, (name, _) in enumerate(NOTICES)}
    seen = {r["sentence_id"] for r in licenses.known_sentences(docs).select("sentence_id").distinct().collect()}
    assert seen == set(licenses.SENTENCES)
    assert {s for _, sequence in licenses.RULES for s in sequence} == set(licenses.SENTENCES)


def test_common_subsequence_equals_dynamic_program():
    rng = np.random.default_rng(6)
    for _ in range(300):
        a, b = (rng.integers(0, 5, rng.integers(1, 20)).tolist() for _ in range(2))
        t = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
        assert decontaminate.common_subsequence(a, b) == t[-1, -1]


def test_words_and_bucket_sums_of_slices_equal_plain_ones():
    texts = ["Ab, c-d  é!", "", " \t", "日本x語。a", "A" * 50, "\x00\x1fz", "ab ab ab"]
    ids, counts = decontaminate.words_of(texts)
    assert ids.tolist() == [w for t in texts for w in decontaminate.words(t)]
    assert counts.tolist() == [len(decontaminate.words(t)) for t in texts]
    assert [len(x) for x in decontaminate.words_of([""])] == [0, 1]
    rng = np.random.default_rng(2)
    rows, passage, b = rng.normal(size=(50, 5)), rng.integers(0, 50, 4000), rng.zipf(1.3, 4000) % 700
    own, got = decontaminate.bucket_sums(rows, passage, b, 15)
    want = np.zeros((700, 5))
    np.add.at(want, b, rows[passage])
    assert np.allclose(want[own], got) and not want[np.setdiff1d(np.arange(700), own)].any()


def test_decontamination_finds_copies_and_paraphrases(spark):
    rng = np.random.default_rng(7)
    words = [f"{a}{b}{c}" for a in "bcdfgklm" for b in "aeiou" for c in "nrst"]
    texts = [list(rng.choice(words, 120)) for _ in range(150)]
    items = [list(rng.choice(words, 30)) for _ in range(4)]
    texts[3][40:70] = items[0]
    texts[9][:30] = items[1]
    changed = list(items[2])
    changed[5], changed[20] = "other", "thing"
    texts[20][60:90] = changed
    texts[21] = items[3][:12] + texts[21]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)]
                                 + [(500, None), (501, ""), (None, " ".join(items[0]))], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(t) + ".") for k, t in enumerate(items)] + [(9, None), (10, "too short")],
                                  "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, bench).collect()}
    assert got == {(3, 0), (9, 1), (20, 2), (None, 0)}
    clashing = docs.selectExpr("*", "doc_id as bad_doc_id", "'r' as row", "1 as bad_row", "text as Fp")
    kept = decontaminate.remove(clashing.unionByName(clashing.where("doc_id = 3").selectExpr(
        "doc_id", "'own text of the same id' as text", "bad_doc_id", "row", "bad_row", "Fp")), bench)
    assert kept.columns == clashing.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    # by row: the contaminated row without an id goes, another text of a contaminated id stays
    assert len(left) == 150 and [t for i, t in left if i == 3] == ["own text of the same id"]
    assert not {None, 9, 20} & {i for i, _ in left}
    assert decontaminate.matches(docs, bench.where("false")).count() == 0
    assert decontaminate.matches(docs.where("false"), bench).count() == 0


def test_decontamination_searches_every_block_of_the_benchmark(spark):
    rng = np.random.default_rng(8)
    words = [f"{a}{b}{c}" for a in "bcdfgklm" for b in "aeiou" for c in "nrst"]
    texts = [list(rng.choice(words, 120)) for _ in range(60)]
    items = [list(rng.choice(words, 30)) for _ in range(7)]
    for k, item in enumerate(items):
        texts[5 * k][40:70] = item
    texts[50][10:40], texts[50][60:90] = items[0], items[6]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(t) + ".") for k, t in enumerate(items)] + [(0, " ".join(items[0]) + ".")],
                                  "item_id long, text string")

    def found(**bounds):
        return sorted(tuple(r) for r in decontaminate.matches(docs, bench, decontaminate.Settings(**bounds)).select(
            "doc_id", "item_id", "start_word", "lcs", "answer_found").collect())

    whole = found()
    assert {r[:2] for r in whole} == {(5 * k, k) for k in range(7)} | {(50, 0), (50, 6)}
    assert found(block_items=2) == whole
    assert found(block_words=40) == whole
    assert len(list(decontaminate.item_blocks(bench, decontaminate.Settings(block_items=2)))) == 4


def test_decontamination_finds_short_and_unspaced_items(spark):
    chinese = "水的沸点在海平面上是一百摄氏度。正确吗"
    texts = ["we ask: what is the capital of France? nobody knows", "the capital of what is France", "what is the capital",
             "前文" + chinese + "后文还有更多的字", "沸点", "of France", "x Paris, Paris y", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "Capital of France")], "doc_id long, text string")
    bench = spark.createDataFrame(
        [(0, "What is the capital of France?"), (1, "capital of France"), (2, chinese), (3, "Paris"), (4, "of France"),
         (5, "capital of France."), (6, "..."), (7, "沸点"), (8, "France nobody capital")], "item_id long, text string")
    found = decontaminate.matches(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"], r["start_word"]) for r in found if r["cosine"] is None} == {
        (0, 0, 2), (0, 1, 5), (0, 5, 5), (0, 4, 6), (5, 4, 0), (6, 3, 1), (None, 1, 0), (None, 5, 0), (None, 4, 1),
        (3, 7, 4), (4, 7, 0)}
    assert {(r["doc_id"], r["item_id"]) for r in found if r["cosine"] is not None} == {(3, 2)}
    assert len(found) == 12
    assert decontaminate.words("水, 火。Abc") == decontaminate.words("水 火 abc")


def test_decontamination_accepts_repeated_words_by_the_subsequence_rule(spark):
    rng = np.random.default_rng(9)
    words = [f"{a}{b}{c}" for a in "bcdfgklm" for b in "aeiou" for c in "nrst"]
    rare = [f"q{k}" for k in range(14)]
    item = [w for pair in zip(["the"] * 6, rare[:6]) for w in pair] + rare[6:]
    kept = [w if w == "the" or w in rare[:1] + rare[8:] else f"z{k}" for k, w in enumerate(item)]
    texts = [list(rng.choice(words, 100)) for _ in range(80)]
    texts[7][30:50] = kept
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(0, " ".join(item[:14]) + ". " + " ".join(item[14:]))], "item_id long, text string")
    found = decontaminate.matches(docs, bench).collect()
    assert [(r["doc_id"], r["lcs"], r["answer_found"]) for r in found] == [(7, 13, True)]


def test_toxicity_sample_goes_on_after_a_long_text(spark):
    docs = spark.createDataFrame([(k, "word " * 20, "en") for k in range(40)]
                                 + [(k, "long " * 400, "en") for k in range(40, 60)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(k, k % 2) for k in range(100, 2000)],
                                   "doc_id long, toxic int")
    texts, y, _, share = toxicity.sample(docs, labels, 16, 60, 4500)
    # no text that fits is left out: the bound is used up
    assert sum(len(t) for t in texts) * 5 == 4500 and set(y.tolist()) == {0, 1}
    assert share == {0: 980, 1: 980}
    assert len(toxicity.sample(docs, labels, 16, 60, 1999)[1]) == 19  # 9 x 100 characters in each half of 999, then one more
    assert len(toxicity.sample(docs, labels, 16, 60, 100_000)[1]) == 60


def test_toxicity_learns_from_every_labelled_row(spark):
    # words in four texts each, which only all rows together show four times
    rows = [(k, f"only{k // 4} word " + "plain " * 5, "en") for k in range(4400)]
    rows += [(k, f"good{k % 9} plain word", "en") for k in range(4400, 4500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k < 4400)) for k in range(4500)], "doc_id long, toxic int")
    net = toxicity.train(docs, labels, rounds=1, more_rounds=1)
    ids, _ = toxicity.word_ids([f"only{k}" for k in range(1100)], net.bits)
    assert (net.slot[ids] < len(net.embed) - 1).all()


def test_toxicity_shards_and_long_texts(spark, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice([f"w{k}" for k in range(50)], 30)) + (" awful" if k % 4 == 0 else "") for k in range(320)]
    texts[0] = "w1 " * 50_000 + texts[0]  # longer than a run
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(320)], "doc_id long, toxic int")
    a, b = (toxicity.train(d, labels, rounds=6, batch=8, shard_rows=80) for d in (docs, docs.repartition(5)))
    assert (a.embed == b.embed).all() and a.out_bias == b.out_bias and a.shift == b.shift and a.by_lang == b.by_lang
    got = toxicity.score(docs, a).collect()
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] % 4 == 0) for r in got]) > 0.95
    # the places found are those of a plain search
    ids, counts = toxicity.word_ids(texts[:5], a.bits)
    top, _, _ = toxicity.peaks(a, np.split(ids, np.cumsum(counts)[:-1]))
    assert np.allclose(np.maximum(top, 0), a.maxima(ids, counts), atol=1e-4)


def test_toxicity_rounds_leave_no_copies_of_the_network(spark, monkeypatch):
    # 20,000 words in four texts each: a network of more than 1 MB, beyond which
    # Spark sends what a function holds as a broadcast of its own and keeps it
    rng = np.random.default_rng(5)
    order = np.concatenate([rng.permutation(20_000) for _ in range(4)]).reshape(160, 500)
    docs = spark.createDataFrame([(k, " ".join(f"w{w}" for w in own) + " awful" * (k % 4 == 0), "en")
                                  for k, own in enumerate(order)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(160)], "doc_id long, toxic int")
    sent, plain = [], type(spark.sparkContext).broadcast

    def noted(self, value):
        sent.append((value, plain(self, value)))
        return sent[-1][1]

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", noted)
    net = toxicity.train(docs, labels, rounds=2, more_rounds=2, batch=16, shard_rows=80)
    assert len(net.embed) > 18_000
    assert not [len(value) for value, _ in sent if isinstance(value, bytes)]
    assert len(sent) == 7 and not any(os.path.exists(b._path) for _, b in sent)


def test_toxicity_values_by_bytes_come_back():
    rng = np.random.default_rng(6)
    for values in (rng.normal(0, 0.1, (50, 17)).astype(np.float16), np.array([0.0, -0.0, np.inf, 1e-7], np.float16),
                   rng.normal(0, 9, 30).astype(np.float32), np.arange(511, 1000, dtype=np.int32), np.zeros(0, np.int32)):
        back = toxicity.from_planes(toxicity.planes(values), values.dtype)
        assert back.tobytes() == values.tobytes() and back.dtype == values.dtype
