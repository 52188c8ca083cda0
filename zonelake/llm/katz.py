"""Katz backoff bigram model: training on some rows, scores for all.

Tokens are white-space words (A-Z lowered) and one end per text; the first
word's context is the end. Counts of 1 to 5 are discounted by Good-Turing
(absolute discounting where the counts of counts do not allow it). What a
context's discounts free goes to the words not seen after it, in proportion
to their unigram probability and normalised exactly over them. Unigrams are
discounted the same way; the mass they free is the probability of any unknown
word. A context whose counts are all above 5 frees one part in its count + 1.

Blocks of documents hold their token numbers and ask hash partitions, first
for word counts, then for bigrams: a bigram row carries its training count in
the block and the documents it occurs in, and the partition that has all
bigrams of a context counts them, derives the backoff weight and returns sums
by document. Discounts depend on the counts of counts of all partitions, so a
document's sums keep the tokens by count and the freed mass by the counts
behind it; they are completed in the last step. Contexts that hold more than
a share of all tokens are spread over partitions by the bigram, and their few
totals are summed by Spark. Tables of each step (tokens, counts, sums) lie in
the shared folder, partitioned by hash.

Defined results: null and empty texts are one end token; repeated rows and
null ids are scored row by row; with no training rows the counts are all
zero, ``score`` and ``base_score`` are finite and the model knows only the
unknown word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.llm.blocks import (ROWS, blocks, grouped, mapped, mixed, partition_of, row, row_batch, squeeze,
                                 squeeze_planes, squeeze_sorted, unsqueeze, unsqueeze_planes, unsqueeze_sorted)
from zonelake.llm.common import shared_table, tasks_for, texts_of

LOW = 5  # counts up to here are discounted
END = np.uint64(1)
U64 = np.uint64


def discounts(n: list[float]) -> np.ndarray:
    """Factors for counts 0 to LOW from the counts of counts ``n[0]`` (once)
    to ``n[LOW]``; each lies strictly between 0 and 1."""
    d = np.ones(LOW + 1)
    first = n[0]
    good = all(x > 0 for x in n)
    if good:
        tail = (LOW + 1) * n[LOW] / first
        for r in range(1, LOW + 1):
            d[r] = ((r + 1) * n[r] / (r * n[r - 1]) - tail) / (1 - tail) if tail < 1 else 0
        good = bool((d[1:] > 0).all() and (d[1:] < 1).all())
    if not good:
        step = first / (first + 2 * n[1]) if first > 0 else 0.5
        step = min(max(step, 0.1), 0.9)
        d[1:] = 1 - step / np.arange(1, LOW + 1)
    return d


def of_counts(c: np.ndarray) -> list[float]:
    """How many are 1, 2, ... LOW + 1."""
    return np.bincount(np.minimum(c, LOW + 2), minlength=LOW + 3)[1:LOW + 2].astype(float).tolist()


class Unigrams:
    """Discounted word probabilities by training count; zero is the unknown
    word's."""

    def __init__(self, total: float, n: list[float]):
        self.d = discounts(n)
        low = np.arange(1, LOW + 1)
        freed = float(((1 - self.d[1:]) * low * np.array(n[:LOW])).sum())
        self.total = total + (0 if freed > 0 else 1)
        self.unknown = (freed if freed > 0 else 1) / self.total

    def probability(self, c: np.ndarray) -> np.ndarray:
        factor = np.where(c <= LOW, self.d[np.minimum(c, LOW)], 1.0)
        return np.where(c > 0, factor * c / self.total, self.unknown)


def tokens(text: bytes) -> list[int]:
    return [xxhash.xxh64_intdigest(w, 7) for w in text.lower().split()]


def scores(docs: DataFrame, block_bytes: int = 8 << 20, hot_share: float = 0.25) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every
    row of ``docs`` (``doc_id, text, train``), learning from the rows where
    ``train`` is true. A context is spread if it holds more than ``hot_share``
    of a partition's even part of the training tokens."""
    spark = docs.sparkSession
    parts = tasks_for(spark)

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows in blocks(batches, block_bytes):
            texts = [t.encode("utf-8", "replace") for t in texts_of(rows)]
            train = rows.column(2).fill_null(False).to_numpy(zero_copy_only=False)
            known = rows.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = rows.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            yield row_batch("text", name, a=squeeze(np.frombuffer(b"".join(texts), np.uint8)),
                            b=squeeze(np.array([len(t) for t in texts], dtype=np.int64)),
                            c=squeeze(np.stack([ids, known, train]).astype(np.int64)))

    table = shared_table(docs.select("doc_id", "text", "train").mapInArrow(split, ROWS), "katz-texts")

    def tokenised(a: bytes, b: bytes):
        """Distinct word keys of a block, and each token's place among them,
        with the number of tokens of each text."""
        data, lengths = unsqueeze(a, np.uint8).tobytes(), unsqueeze(b, np.int64)
        ends = np.cumsum(lengths)
        per_text = [tokens(data[e - n:e]) for e, n in zip(ends.tolist(), lengths.tolist())]
        size = np.array([len(t) + 1 for t in per_text], dtype=np.int64)
        keys = np.full(int(size.sum()), END, dtype=U64)
        inner = np.ones(len(keys), dtype=bool)
        inner[np.cumsum(size) - 1] = False
        keys[inner] = np.fromiter((k for t in per_text for k in t), dtype=U64, count=int(inner.sum()))
        return *np.unique(keys, return_inverse=True), size

    def ask(one: dict) -> Iterator[dict]:
        words, local, size = tokenised(one["a"], one["b"])
        train = unsqueeze(one["c"], np.int64).reshape(3, -1)[2].astype(bool)
        count = np.bincount(local[np.repeat(train, size)], minlength=len(words))
        part = partition_of(words, parts)
        for p in np.unique(part):
            own = part == p
            yield row("ask", one["block"], int(p), a=squeeze_sorted(words[own]), b=squeeze(count[own]))

    def count_words(rows) -> Iterator[dict]:
        asked = [unsqueeze_sorted(a) for a in rows["a"]]
        keys, inverse = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([unsqueeze(b, np.int64) for b in rows["b"]]))
        total = total.astype(np.int64)
        # a word's number: its rank here, times the partitions, plus this one
        number = np.arange(len(keys), dtype=U64) * U64(parts) + U64(rows["part"][0])
        for name, own in zip(rows["block"], np.split(inverse, np.cumsum([len(k) for k in asked])[:-1])):
            yield row("count", name, rows["part"][0], a=squeeze(total[own]), b=squeeze_sorted(number[own]))
        yield row("stat", "", rows["part"][0], n=[float(total.sum()), float((total > 0).sum()), *of_counts(total)])

    counts = shared_table(grouped(mapped(table, ask), "part", parts, count_words, ROWS), "katz-words")
    n_stats = LOW + 3
    first = counts.where("kind = 'stat'").agg(*(F.sum(F.col("n")[k]) for k in range(n_stats))).first()
    stats = [float(x or 0) for x in first]
    total, types = stats[0], stats[1]
    uni = Unigrams(total, stats[2:])
    hot_from = hot_share * total / parts

    def bigrams(rows) -> Iterator[dict]:
        at = rows["kind"].index("text")
        name, ids = rows["block"][at], unsqueeze(rows["c"][at], np.int64).reshape(3, -1)
        words, local, size = tokenised(rows["a"][at], rows["b"][at])
        home = partition_of(words, parts)
        c, number = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=U64)
        for kind, p, a, b in zip(rows["kind"], rows["part"], rows["a"], rows["b"]):
            if kind == "count":
                c[home == p], number[home == p] = unsqueeze(a, np.int64), unsqueeze_sorted(b)
        starts = np.cumsum(size) - size
        base = np.add.reduceat(np.log10((c + 1) / (total + types + 1))[local], starts)
        known = np.add.reduceat((c > 0).astype(np.int64)[local], starts)
        yield row("base", name, xxhash.xxh32_intdigest(name) % parts, a=rows["c"][at],
                  b=squeeze(np.stack([size, known])), c=squeeze(base))
        end = int(np.searchsorted(words, END))
        context = np.concatenate([[end], local[:-1]])  # a text follows another one's end
        pair, place, n = np.unique(context << 32 | local, return_inverse=True, return_counts=True)
        doc = np.repeat(np.arange(len(size)), size)
        by_pair = doc[place.argsort(kind="stable")]
        firsts = np.cumsum(n) - n
        trained = np.bincount(place, weights=ids[2][doc], minlength=len(pair)).astype(np.int64)
        ctx, word = pair >> 32, pair & 0xFFFFFFFF
        a, b = number[ctx], number[word]
        part = partition_of(np.where(c[ctx] > hot_from, mixed(b), a), parts)
        order = np.lexsort((b, a, part))
        for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            span = np.repeat(firsts[own] - (np.cumsum(n[own]) - n[own]), n[own]) + np.arange(n[own].sum())
            used = ctx[own][np.flatnonzero(np.diff(ctx[own], prepend=-1))]
            yield row("pair", name, int(part[own[0]]), a=squeeze_sorted(a[own]), b=squeeze_planes(b[own]),
                      c=squeeze(np.stack([c[word[own]], trained[own], n[own]]).astype("<u4").view(np.uint8)
                                .reshape(3, -1, 4).transpose(0, 2, 1)),
                      d=squeeze(c[used]), e=squeeze(by_pair[span].astype("<u4").view(np.uint8).reshape(-1, 4).T))

    per_block = table.unionByName(counts.where("kind = 'count'"))
    pairs = grouped(per_block, "block", parts, bigrams, ROWS)

    def four(b: bytes, rows: int = 1) -> np.ndarray:
        planes = np.ascontiguousarray(unsqueeze(b, np.uint8).reshape(rows, 4, -1).transpose(0, 2, 1))
        return planes.view("<u4").reshape(rows, -1).astype(np.int64)

    def judge(rows) -> Iterator[dict]:
        for k in [k for k, kind in enumerate(rows["kind"]) if kind == "base"]:
            yield row("base", rows["block"][k], a=rows["a"][k], b=rows["b"][k], c=rows["c"][k])
        sent = [k for k, kind in enumerate(rows["kind"]) if kind == "pair"]
        if not sent:
            return
        own_ctx = [unsqueeze_sorted(rows["a"][k]) for k in sent]
        info = [four(rows["c"][k], 3) for k in sent]
        cuts = np.cumsum([len(x) for x in own_ctx])[:-1]
        used = np.concatenate([x[np.flatnonzero(np.diff(x, prepend=x[:1] + U64(1)))] for x in own_ctx])
        contexts, at = np.unique(used, return_index=True)
        c_ctx = np.concatenate([unsqueeze(rows["d"][k], np.int64) for k in sent])[at]
        ctx_all = np.searchsorted(contexts, np.concatenate(own_ctx))
        spots, word_all = np.unique(np.concatenate([unsqueeze_planes(rows["b"][k]) for k in sent]), return_inverse=True)
        keys, first_at, inverse = np.unique(ctx_all * len(spots) + word_all, return_index=True, return_inverse=True)
        r = np.bincount(inverse, weights=np.concatenate([i[1] for i in info])).astype(np.int64)
        ctx, p1 = ctx_all[first_at], uni.probability(np.concatenate([i[0] for i in info])[first_at])
        seen = r > 0
        mass = np.bincount(ctx[seen], weights=p1[seen], minlength=len(contexts))
        low = np.zeros((LOW, len(contexts)), dtype=np.int64)
        for k in range(LOW):
            low[k] = np.bincount(ctx[r == k + 1], minlength=len(contexts))
        hot = c_ctx > hot_from
        yield row("stat", "", rows["part"][0], n=of_counts(r))
        for k in np.flatnonzero(hot):
            yield row("hot", str(int(contexts[k])), rows["part"][0],
                      n=[*low[:, k].astype(float), float(mass[k]), float(c_ctx[k])])
        whole = ~hot & (c_ctx > 0)
        above = c_ctx + (low.sum(axis=0) == 0)  # the denominator
        log = np.zeros(len(keys))
        log[seen] = np.log10(r[seen])
        log[~seen] = np.log10(p1[~seen])
        settled = whole[ctx]
        log[settled] -= np.log10(above[ctx[settled]])
        lost = settled & ~seen
        log[lost] -= np.log10(1 - mass[ctx[lost]])
        for k, own, about in zip(sent, np.split(inverse, cuts), info):
            name, n, doc = rows["block"][k], about[2], four(rows["e"][k])[0]
            gram = np.repeat(own, n)
            docs_in, d = np.unique(doc, return_inverse=True)
            sums = np.bincount(d, weights=log[gram])
            small = np.stack([np.bincount(d[r[gram] == j + 1], minlength=len(docs_in)) for j in range(LOW)])
            # words not seen after a context: which counts its freed mass comes from
            new = np.flatnonzero(lost[gram] & (low[:, ctx[gram]].sum(axis=0) > 0))
            backed = np.concatenate([d[new][None], low[:, ctx[gram[new]]]])
            spread = np.flatnonzero(hot[ctx[gram]])
            pair, m = np.unique(np.stack([d[spread], ctx[gram[spread]], seen[gram[spread]]]), axis=1,
                                return_counts=True) if len(spread) else (np.zeros((3, 0), np.int64), np.zeros(0))
            far = np.stack([pair[0].astype(U64), contexts[pair[1]], pair[2].astype(U64), m.astype(U64)])
            yield row("sums", name, rows["part"][0], a=squeeze(docs_in), b=squeeze(sums),
                      c=squeeze(small.astype(np.uint32)), d=squeeze(backed.astype(np.int32)), e=squeeze(far))

    judged = shared_table(grouped(pairs, "part", parts, judge, ROWS), "katz-sums")
    second = judged.where("kind = 'stat'").agg(*(F.sum(F.col("n")[k]) for k in range(LOW + 1))).first()
    d = discounts([float(x or 0) for x in second])
    # at most parts / hot_share contexts hold more than that share
    spread = judged.where("kind = 'hot'").groupBy("block").agg(
        *(F.sum(F.col("n")[k]).alias(f"n{k}") for k in range(LOW + 1)), F.max(F.col("n")[LOW + 1]).alias("c")).collect()
    weight = (1 - d[1:]) * np.arange(1, LOW + 1)
    hot_keys = np.array([int(x["block"]) for x in spread], dtype=U64)
    freed = np.array([sum(w * x[f"n{k}"] for k, w in enumerate(weight)) for x in spread], dtype=float)
    over = np.array([x["c"] for x in spread], dtype=float) + (freed == 0)
    left = 1 - np.array([x[f"n{LOW}"] for x in spread], dtype=float)
    by_key = hot_keys.argsort()
    hot_keys, when_seen = hot_keys[by_key], -np.log10(over)[by_key]
    when_new = (np.log10(np.where(freed == 0, 1, freed)) - np.log10(left) - np.log10(over))[by_key]

    def finish(rows) -> Iterator[dict]:
        at = rows["kind"].index("base")
        ids = unsqueeze(rows["a"][at], np.int64).reshape(3, -1)
        size, known = unsqueeze(rows["b"][at], np.int64).reshape(2, -1)
        base = unsqueeze(rows["c"][at], np.float64)
        score = np.zeros(len(size))
        for k, kind in enumerate(rows["kind"]):
            if kind != "sums":
                continue
            doc = unsqueeze(rows["a"][k], np.int64)
            part = unsqueeze(rows["b"][k], np.float64) + np.log10(d[1:]) @ unsqueeze(
                rows["c"][k], np.uint32).reshape(LOW, -1)
            backed = unsqueeze(rows["d"][k], np.int32).reshape(LOW + 1, -1)
            part += np.bincount(backed[0], weights=np.log10(weight @ backed[1:]), minlength=len(doc))
            far = unsqueeze(rows["e"][k], U64).reshape(4, -1)
            if far.shape[1]:
                at = np.searchsorted(hot_keys, far[1])
                part += np.bincount(far[0].astype(np.int64), minlength=len(doc),
                                    weights=far[3] * np.where(far[2] == 1, when_seen[at], when_new[at]))
            score[doc] += part
        yield {"doc_id": [i if ok else None for i, ok in zip(ids[0].tolist(), ids[1].tolist())],
               "n_tokens": size, "n_known": known, "train_tokens": np.full(len(size), int(total)),
               "base_score": base, "score": score}

    last = judged.where("kind in ('base', 'sums')")
    return grouped(last, "block", parts, finish, "doc_id long, n_tokens long, n_known long, train_tokens long, "
                                                 "base_score double, score double")
