"""Repetition rules, phrases and hard negatives against brute force, and the
defined edge cases."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zonelake.llm import bond, phrases, repetition

DOCS = "doc_id long, text string, lang string, score string, phrase string, n long, `row` int, kept string"


def odd_docs(spark, texts):
    rows = [(k, t, lang, "x", "y", 1, 2, "z") for k, (t, lang) in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[0], (None, *rows[1][1:])], DOCS)


# --- repetition -------------------------------------------------------------

def plain_measures(text):
    """The definition, window by window, in Python's own strings."""
    spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")]
    words = [text[a:b] for a, b in spans]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = [x for i, x in enumerate(lines) if x in lines[:i]]
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_lines": len(lines), "n_dup_lines": len(dup),
           "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
           "dup_line_chars": sum(len(re.sub(r"[\x20\x09-\x0D]", "", x)) for x in dup)}

    def chars(starts, n):
        return sum(len(words[i]) for i in {s + k for s in starts for k in range(n)})

    for n in range(2, 11):
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        at = defaultdict(list)
        for i, g in enumerate(grams):
            at[g].append(i)
        often = {g: p for g, p in at.items() if len(p) > 1}
        if n == 3:
            out["n_repeat_words"] = len({s + k for p in often.values() for s in p for k in range(3)})
        if n <= 4:
            best = min(often, key=lambda g: (-len(often[g]), -sum(map(len, g)), often[g][0]), default=None)
            out[f"top_{n}"] = chars(often[best], n) if best else 0
        else:
            out[f"dup_{n}"] = chars([s for p in often.values() for s in p[1:]], n)
    return out


def odd_texts():
    rng = np.random.default_rng(3)
    words = ["a", "bb", "ß", "日本", "x#y", "$", " ", "long-word", "ünï"]
    some = [" ".join(rng.choice(words[:k], int(m))) for k, m in zip(rng.integers(1, 9, 60), rng.integers(1, 90, 60))]
    lined = ["\n".join(rng.choice(["one two", "one two ", "", "  ", "three\tfour", "one  two"], 12)) for _ in range(20)]
    return [None, "", " \n\t ", "one", "a a", "a a a a", *some, *lined, "\n".join(some[:9]), "ab " * 40_000]


def test_repetition_counts_match_the_definition():
    texts = odd_texts()[:-1]
    got = repetition.measures(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in got.items()} == plain_measures(t), t


def test_a_collision_changes_the_multiplier(monkeypatch):
    texts = pa.array(["a b c a b d a b c", "c b a c b a"])
    right = repetition.measures(texts)
    calls, real = [], repetition.equal_runs

    def colliding(keys, same):
        calls.append(1)
        return real(np.zeros_like(keys) if len(calls) == 1 else keys, same)

    monkeypatch.setattr(repetition, "equal_runs", colliding)
    got = repetition.measures(texts)
    assert len(calls) > 9 and all((got[k] == right[k]).all() for k in right)


def test_repetition_verdicts_and_edges(spark):
    plain = " ".join(f"word{k}" for k in range(80))
    copied = " ".join(f"w{k}" for k in range(100)) + " " + " ".join(f"w{k}" for k in range(30))
    texts = [plain, None, "", "too short", "same words again " * 40, copied,
             "\n".join([plain] + ["buy now"] * 3), plain + " word1 word2 word3"]
    docs = odd_docs(spark, [(t, "en") for t in texts])
    got = repetition.judge(docs)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == len(texts) + 2
    assert [k for k in range(len(texts)) if rows[k]["base_failed"]] == [1, 2, 3, 4]
    assert [k for k in range(len(texts)) if rows[k]["kept"]] == [0, 7]
    assert "dup_10" in rows[5]["failed_rules"] and rows[6]["failed_rules"] == ["n_dup_lines"]
    assert rows[None]["n_words"] == 0
    assert repetition.judge(docs.where("false")).count() == 0


def test_a_very_long_text_is_judged_whole(spark):
    text = odd_texts()[-1] + "end"
    row = repetition.judge(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["n_words"], row["n_repeat_words"], row["base_failed"]) == (40_001, 40_000, True)


# --- phrases ----------------------------------------------------------------

def plain_phrases(rows, longest, support, top, percent=100):
    f, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        low = re.sub(r"[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for n in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        gone = {p[i:j] for p, a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and 100 * a >= percent * cand[p[i:j]]}
        scored = []
        for p, a in cand.items():
            if p not in gone:
                score, _, k = min((1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k, k)
                                  for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i, s[2].decode(), -s[1], s[3], s[4], total[lang], -s[0])
                for i, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def spoken(seed=5, n=90):
    rng = np.random.default_rng(seed)
    words = np.array(["the", "The", "red", "fox", "née", "日本", "of", "Z", "ZZ"])
    marks = np.array([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", ": ", "!"])
    texts = ["".join(w + m for w, m in zip(rng.choice(words, k), rng.choice(marks, k))) for k in rng.integers(1, 60, n)]
    return [(t, ("en", "de", None, "en", "en")[i % 5]) for i, t in enumerate(texts)]


@pytest.mark.parametrize("shards, block_bytes, bits", [(1, 1 << 20, 20), (2, 700, 20), (50, 60, 12), (3, 700, 6)])
def test_phrases_match_brute_force_for_any_shards(spark, shards, block_bytes, bits):
    """Also with local support 1, blocks of one text and a sieve that is full."""
    rows = [*spoken(), (None, "en"), ("", None), ("the red fox " * 30, "en")]
    docs = odd_docs(spark, rows).repartition(3)
    every = [*rows, rows[0], rows[1]]
    got = phrases.collocations(docs, longest=5, support=6, top=20, shards=shards, block_bytes=block_bytes,
                                sieve_bits=bits)
    assert sorted(map(tuple, got.collect())) == plain_phrases(every, 5, 6, 20)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_phrases_of_nothing(spark):
    docs = odd_docs(spark, spoken(n=3))
    assert phrases.collocations(docs.where("false"), sieve_bits=12).count() == 0
    assert phrases.collocations(docs, support=1000, sieve_bits=12).count() == 0


def test_contained_percent(spark):
    rows = [("a b c. " * 9 + "a b. " * 3, "en")]
    docs = spark.createDataFrame(rows, "text string, lang string")
    for percent in (100, 75, 76):
        got = phrases.collocations(docs, support=2, contained_percent=percent, sieve_bits=12)
        assert sorted(map(tuple, got.collect())) == plain_phrases(rows, 5, 2, 2000, percent)


def test_a_frequent_phrase_is_frequent_in_a_shard(spark):
    """The mined candidates hold every frequent phrase."""
    docs = spark.createDataFrame(spoken(n=200), "text string, lang string").repartition(4)
    words, totals, found = phrases.frequent(docs, 4, 8, shards=3, block_bytes=2000, sieve_bits=16)
    counts = plain_phrases(spoken(n=200), 4, 8, 10 ** 6, percent=10 ** 6)
    assert {(r["lang"], r["phrase"], r["f"]) for r in found.collect()} == {(r[0], r[2], r[3]) for r in counts}


# --- hard negatives ---------------------------------------------------------

VECTORS = "vec_id long, label int, embedding array<float>, score string, shard int, id string, v int"


def plain_negatives(rows, positives=5, negatives=3, scale=256, every=50):
    good = {}
    for i, label, v in sorted((r for r in rows if None not in r[:3]), key=lambda r: (r[0], r[1], r[2])):
        if all(x is not None and np.isfinite(x) for x in v):
            good.setdefault(i, (label, [int(np.floor(float(np.float32(x)) * scale)) for x in v]))
    out = []
    for i, (label, v) in good.items():
        if i % every:
            continue
        score = {j: sum(a * b for a, b in zip(v, w)) for j, (_, w) in good.items() if j != i and len(w) == len(v)}
        order = sorted(score, key=lambda j: (-score[j], j))
        for p in [j for j in order if good[j][0] == label][:positives]:
            hit = [j for j in order if good[j][0] != label and 50 * score[p] <= 100 * score[j] <= 95 * score[p]]
            out += [(i, p, k, j, score[p], score[j]) for k, j in enumerate(hit[:negatives], 1)]
    return sorted(out)


def some_vectors(n=400, dim=12, seed=1):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    v[n // 2:n // 2 + n // 4] = v[0]  # a third of identical rows, so ties
    return [(k, int(rng.integers(0, 4)), [float(np.float32(x)) for x in row]) for k, row in enumerate(v)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, "i", 2) for r in rows], VECTORS)


@pytest.mark.parametrize("shard_rows, block_rows, first", [(10 ** 6, 10 ** 6, 4), (37, 3, 1), (100, 2, 64)])
def test_hard_negatives_match_brute_force(spark, monkeypatch, shard_rows, block_rows, first):
    monkeypatch.setattr(bond, "FIRST_STEP", first)
    odd = [(None, 1, [1.0] * 12), (1000, None, [1.0] * 12), (1001, 1, None), (1002, 1, [None] + [1.0] * 11),
           (1003, 1, [float("nan")] * 12), (1004, 2, [float("inf")] * 12), (1005, 1, [0.0] * 12),
           (1050, 1, [0.5, 0.25]), (1100, 1, [0.5, 0.25]), (1101, 2, [0.4, 0.2]), (1150, 3, []), (-50, 2, [0.1] * 12),
           (0, 9, [9.0] * 12)]
    rows = some_vectors() + odd
    got = bond.hard_negatives(frame(spark, rows + rows[:20]).repartition(5), F.col("vec_id") % 50 == 0,
                              shard_rows=shard_rows, block_rows=block_rows)
    want = plain_negatives(rows)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(k, k % 3, [float(np.float32(x)) for x in rng.normal(size=4) * 2.0 ** 20]) for k in range(160)]
    got = bond.hard_negatives(frame(spark, rows), F.col("vec_id") % 50 == 0, shard_rows=40)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows)
    huge = [(k, k % 2, [1e38, 1.0]) for k in range(51)]
    assert bond.hard_negatives(frame(spark, huge), F.col("vec_id") % 50 == 0).count() == 0


def test_the_scan_prunes_and_never_reads_a_lost_row(spark):
    rng = np.random.default_rng(4)
    v = np.floor(256 * rng.normal(size=(2000, 32)) * np.geomspace(1, 0.01, 32))
    shard = bond.Columns(np.arange(2000), np.zeros(2000, np.int64), v)
    left = []

    def survivors(low, high):
        score = v @ v[7]
        keep = high >= bond.largest(low, 5)
        left.append(int(keep.sum()))
        return keep

    rows, score = bond.vertical_scan(shard, v[7], np.ones(2000, dtype=bool), survivors)
    assert left[0] < 1000 and left[-1] >= 5
    exact = v @ v[7]
    assert set(np.argsort(-exact)[:5]) <= set(rows) and (score == exact[rows]).all()


def test_no_rows_no_negatives(spark):
    rows = frame(spark, some_vectors(60))
    assert bond.hard_negatives(rows.where("false"), F.col("vec_id") % 50 == 0).count() == 0
    assert bond.hard_negatives(rows, F.col("vec_id") < 0).count() == 0
