"""SimHash, repeated substrings, nearest neighbours, Katz backoff and the
pipeline against brute force on small fixtures."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash

from zonelake.llm import hnsw, katz, simhash, substrings


def test_simhash_components_match_brute_force(spark):
    rng = np.random.default_rng(1)
    base = [list(rng.choice([f"w{k}" for k in range(200)], 60)) for _ in range(8)]
    rows = []
    for k in range(160):
        t = list(base[k % 8])
        for _ in range(k // 40):
            t[rng.integers(60)] = f"v{rng.integers(50)}"
        rows.append((k, " ".join(t)))
    rows += [(300, None), (301, ""), (302, "One two"), (302, "one TWO"), (None, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def fingerprint(text):
        w = (text or "").encode().lower().split()
        grams = [b" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] * bool(w)
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    want = Counter((doc, fps[i], least.get(find(i))) for i, (doc, _) in enumerate(rows))
    got = Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"])
                  for r in simhash.near_duplicates(docs).collect())
    assert got == want
    kept = [r["doc_id"] for r in simhash.keep_first(docs).collect()]
    assert Counter(kept) == Counter(set(least.values()))  # the row without an id is a copy of another
    assert simhash.near_duplicates(docs.where("false")).count() == 0


def test_one_row_of_each_component_stays(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(7, a, "x"), (7, b, "y"), (9, b, "z"), (9, b, "z"), (None, a, "n"), (None, "only here without an id", "n"),
            (None, "only here without an id", "n"), (12, None, "e"), (11, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_doc_id string").selectExpr(
        "*", "1 as fp", "2 as kept_fp", "3 as KEPT_ID", "4 as first", "5 as root")
    got = simhash.keep_first(docs)
    assert got.columns == docs.columns
    assert {(r["doc_id"], r["text"]) for r in got.collect()} == {
        (7, a), (7, b), (None, "only here without an id"), (11, "")}
    assert got.count() == 4
    assert simhash.keep_first(docs.where("false")).count() == 0


def test_simhash_large_anchors_are_split_exactly(spark):
    rng = np.random.default_rng(2)
    core = int(rng.integers(1 << 62))
    fps = {core ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 60, (150, 2))} | set(
        map(int, rng.integers(0, 1 << 62, 50)))
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    for split_at in (4, 4096):
        edges = simhash.component_roots(simhash.links(frame, 2, split_at)).collect()
        root = {r["u"]: r["v"] for r in edges}
        left = {f: f for f in fps}

        def find(x):
            while left[x] != x:
                x = left[x]
            return x

        for x in fps:
            for y in fps:
                if x < y and (x ^ y).bit_count() <= 2:
                    a, b = sorted((find(x), find(y)))
                    left[b] = a
        assert {f: root.get(f, f) for f in fps} == {f: find(f) for f in fps}


def test_suffix_order():
    rng = np.random.default_rng(3)
    for _ in range(60):
        s = np.append(rng.choice(np.frombuffer(b"ab\x00c", np.uint8), rng.integers(1, 300)), np.uint8(255))
        b = s.tobytes()
        got = substrings.suffix_order(s, 104)
        assert sorted(got) == list(range(len(b)))
        assert [b[k:k + 104] for k in got] == sorted(b[k:k + 104] for k in range(len(b)))


def test_repeated_substrings_match_brute_force(spark):
    rng = np.random.default_rng(4)
    letters = list("abcdefgh é")
    base = "".join(rng.choice(letters, 2500))
    docs = []
    for k in range(40):
        t = ""
        for _ in range(rng.integers(0, 6)):
            kind, a = rng.random(), int(rng.integers(0, 2000))
            if kind < 0.5:
                t += base[a:a + int(rng.integers(60, 400))]
            elif kind < 0.7:
                t += ["a", "xyz", "é" * 7 + "b" * 50][int(rng.integers(3))] * int(rng.integers(3, 200))
            else:
                t += "".join(rng.choice(letters, int(rng.integers(0, 150))))
        docs.append((k, t))
    docs += [(100, None), (101, ""), (102, base), (103, base)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in substrings.repeated_spans(frame, block_bytes=3000, sort_bytes=2000).collect()}
    seen: set = set()
    for k, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for j in range(len(b) - 99):
            if b[j:j + 100] in seen:
                gone[j:j + 100] = True
            seen.add(b[j:j + 100])
        edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
        r = got[k]
        assert (r["n_bytes"], r["n_removed"], r["starts"], r["ends"]) == (len(b), gone.sum(), edge[::2], edge[1::2])
        assert r["kept_sha256"] == hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()
    twice = spark.createDataFrame([(1, base), (1, base), (None, base)], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in substrings.repeated_spans(twice).collect()) == [0] + [len(base.encode())] * 2
    assert substrings.repeated_spans(frame.where("false")).count() == 0


@pytest.mark.parametrize("clusters", [1, 40, 400])
def test_nearest_neighbours_on_tight_clusters(spark, clusters):
    rng = np.random.default_rng(clusters)
    centre = rng.normal(size=(clusters, 64))
    v = centre[rng.integers(0, clusters, 8000)] + rng.normal(size=(8000, 64)) * 0.006
    frame = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "vec_id long, embedding array<double>")
    asked = np.arange(0, 8000, 80)
    got: dict[int, set] = {}
    for r in hnsw.nearest(frame, frame.where("vec_id % 80 = 0"), k=20, block_rows=30, lane_blocks=2).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    score = v[asked] @ v.T
    score[np.arange(len(asked)), asked] = -np.inf
    true = np.argsort(-score, axis=1)[:, :20]
    hits = [len(got[int(q)] & set(t.tolist())) for q, t in zip(asked, true)]
    assert np.mean(hits) / 20 >= 0.95 and min(hits) > 0


def test_every_graph_node_is_reachable():
    rng = np.random.default_rng(5)
    for v in (np.repeat(np.eye(6), 70, axis=0) + rng.normal(size=(420, 6)) * 1e-4, rng.normal(size=(500, 3)), np.ones((1, 4))):
        x, tables, entry = hnsw.build(v, 2)
        for level, table in enumerate(tables):
            seen, front = {entry}, [entry]
            while front:
                front = list({int(n) for f in front for n in table[f] if n >= 0} - seen)
                seen.update(front)
            assert seen >= set(np.flatnonzero((table >= 0).any(axis=1)).tolist())
            if level == 0:
                assert len(seen) == len(x)


def test_nearest_neighbours_reach_the_recall(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(1500, 24)) * rng.uniform(0.5, 2, (1500, 1))
    v[200:320] = v[7]
    rows = [(k, [float(x) for x in row], 1) for k, row in enumerate(v.astype(np.float32))]
    rows += [(2000, None, 0), (2001, [0.0] * 24, 0), (2002, [float("nan")] * 24, 0), (2003, [1.0, None] * 12, 0),
             (2004, [1.0, 2.0], 0), (2004, [1.0, 2.0], 0), (2020, [3.0, 1.0], 0), (None, [1.0] * 24, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got: dict = {}
    for r in hnsw.nearest(frame, frame.where("vec_id % 20 = 0"), k=20, shard_rows=400, block_rows=30).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    exact = v.astype(np.float32).astype(float)
    hit = 0
    for q in range(0, 1500, 20):
        s = exact @ exact[q]
        s[q] = -np.inf
        own = sorted(got[q])
        assert [r for r, _, _ in own] == list(range(1, 21))
        assert np.allclose([x for _, _, x in own], s[[k for _, k, _ in own]], atol=1e-9)
        assert own == sorted(own, key=lambda x: (-x[2], x[1]))
        hit += len({k for _, k, _ in own} & set(np.lexsort((np.arange(1500), -s))[:20].tolist()))
    assert hit >= 0.9 * 20 * 75
    assert [k for _, k, _ in got[2020]] == [2004] and 2000 not in got
    assert hnsw.nearest(frame.where("false"), frame, k=3).count() == 0


def test_katz_matches_brute_force(spark):
    rng = np.random.default_rng(6)
    words = [f"w{k}" for k in range(120)]
    weight = 1 / np.arange(1, 121)
    docs = [(k, " ".join(rng.choice(words, int(rng.integers(1, 60)), p=weight / weight.sum())), k % 5 != 0)
            for k in range(200)]
    docs += [(900, None, True), (901, "", False), (None, "w1 W2", False), (7, docs[7][1], True)]
    for train_all in (True, False):
        rows = [(i, t, bool(b and train_all)) for i, t, b in docs]
        frame = spark.createDataFrame(rows, "doc_id long, text string, train boolean").repartition(3)
        text = [((t or "").lower().split(), b) for _, t, b in rows]
        uni, after = Counter(), defaultdict(Counter)
        for w, b in text:
            if b:
                uni.update([*w, None])
                for a, c in zip([None, *w], [*w, None]):
                    after[a][c] += 1
        total, types = sum(uni.values()), len(uni)

        def n_of(counts):
            return [float(sum(c == r for c in counts)) for r in range(1, 7)]

        one = katz.Unigrams(total, n_of(uni.values()))
        d = katz.discounts(n_of([c for x in after.values() for c in x.values()]))

        def p1(w):
            return float(one.probability(np.array([uni[w]]))[0])

        def p2(a, w):
            if not uni[a]:
                return p1(w)
            own = after[a]
            freed = sum((1 - d[r]) * r for r in own.values() if r <= 5)
            under = sum(own.values()) + (freed == 0)
            if own[w]:
                return own[w] * (d[own[w]] if own[w] <= 5 else 1) / under
            return (freed or 1) / under * p1(w) / (1 - sum(p1(x) for x in own if own[x]))

        for a in list(after)[:5]:
            assert math.isclose(sum(p2(a, w) for w in uni) + p2(a, "unknown"), 1, rel_tol=1e-9)
        want = []
        for w, _ in text:
            seq = [*w, None]
            want.append((len(seq), sum(uni[x] > 0 for x in seq), total,
                         sum(math.log10((uni[x] + 1) / (total + types + 1)) for x in seq),
                         sum(math.log10(p2(a, x)) for a, x in zip([None, *w], seq))))
        for hot_share in (0.25, 0.01):
            got = katz.scores(frame, block_bytes=1500, hot_share=hot_share).collect()
            assert len(got) == len(rows)
            by_id = {r["doc_id"]: tuple(r)[1:] for r in got}
            for (i, _, _), x in zip(rows, want):
                assert np.allclose(by_id[i], x, rtol=1e-9), i
    assert katz.scores(frame.where("false")).count() == 0


def test_pipeline_matches_its_operators(spark, sf_small):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns = docs.columns
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, sf_small)
        assert docs.columns == columns, name
        docs = p.shared_table(docs, name)
    last = p.STAGES[-1][1](spark, docs, sf_small)
    assert {r[0] for r in last.select("doc_id").distinct().collect()} == {r[0] for r in docs.select("doc_id").collect()}
    assert docs.count() < spark.read.parquet(f"{sf_small}/documents.parquet").count()


def test_nearest_neighbours_search_few_graphs(spark, monkeypatch):
    """Rows that fit one graph are searched in one, by several tasks."""
    seen, index = [], hnsw.index
    monkeypatch.setattr(hnsw, "index", lambda vectors, shards, *a: seen.append(shards) or index(vectors, shards, *a))
    v = np.random.default_rng(5).normal(size=(9000, 6)).astype(np.float32)
    frame = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(9000), "embedding": v.tolist()}),
                                  "vec_id long, embedding array<double>")
    got = hnsw.nearest(frame, frame.where("vec_id % 200 = 0"), k=5, block_rows=10).toPandas()
    assert seen == [1] and len(got) == 45 * 5
    w = v.astype(float)
    score = w[::200] @ w.T
    score[np.arange(45), np.arange(45) * 200] = -np.inf
    best = np.argsort(-score, axis=1)[:, :5]
    own = got.sort_values(["query_id", "rank"])["vec_id"].to_numpy().reshape(45, 5)
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(own, best)]) >= 0.95
    long = np.random.default_rng(6).random((3, 9001))
    assert (hnsw.nearest_first(long, 64) == np.argsort(long, axis=1)[:, :64]).all()
