"""Benchmark decontamination by latent semantic retrieval.

1. Every text is cut into words (lower case, letters and digits; in scripts
   written without spaces each character is a word); a word is its 32-bit
   hash. Word numbers are written once to the shared folder, and
   Spark sums in how many passages (runs of ``size`` words) each bucket of
   hashes occurs, which gives the inverse document frequencies.
2. Randomised SVD of the TF-IDF matrix A of all passages: tasks sum
   A' (A G) for a random G (one power step), the driver orthonormalises it to
   Q, tasks sum (A Q)' (A Q) and the mean row, and the small eigenproblem
   gives the latent axes, scaled by their singular values. All sums have
   bounded size (buckets x ``rank``) and are added up over several steps.
3. Benchmark items are cut into windows of ``size`` words; passages start
   every ``stride`` words, so that a copy overlaps some passage well. Cosine
   in the latent space of a passage and an item window finds candidates.
4. Each candidate is checked on the words themselves: the item's words must
   make up ``overlap`` of the weight (squared inverse document frequency) of
   the passage or of the item, whichever is less, and the longest common
   subsequence of the item and the stretch of the document around the passage
   must cover ``sure`` of the item's words, or ``likely`` of them if the
   item's answer (its last sentence) is found in order there as well. A
   candidate is left out before only where the words it shares with the item,
   each as often as it occurs in both, are too few for that.
5. Items with fewer than ``min_words`` words are too short for latent search:
   they match where all their words stand in a row, found by walking a prefix
   tree from every word of the documents. Their ``cosine`` is null, and
   ``start_word`` is their first place.

The benchmark is searched for in blocks of at most ``block_items`` items and
``block_words`` words (a longer item is a block of its own): the windows of one
block go with the tasks, which map every document against it, and its matches
are appended to the shared folder. An item lies in one block, so its best
stretch of a document is found there. Defined results: null and empty texts, and items without a word, match
nothing; repeated documents and items give rows each (rows of equal ids and
figures once).
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.llm.blocks import squeeze, unsqueeze
from zonelake.llm.common import cut_lineage, fresh, map_slices, shared_table, texts_of
from zonelake.session import ensure_checkpoint_dir

MARKS = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalnum()),
                        b" " * sum(not chr(c).isalnum() for c in range(128)))
#: Marks of East Asian scripts, and characters of scripts without spaces
#: (Thai, Lao, Tibetan, Myanmar, Khmer, Tai, kana, ideographs).
EAST_MARKS = re.compile("[\u3000-\u3004\u3008-\u3020\u3030\u30fb\uff01-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")
UNSPACED = re.compile("([\u0e01-\u0eff\u0f00-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u3005-\u3007\u3021-\u302f"
                      "\u3031-\u30fa\u30fc-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua000-\ua4cf"
                      "\ua9e0-\ua9ff\uaa60-\uaa7f\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff])")
GROUPS = 16  # ranges of a sum, each added up by one reducer


def spaced(text: str) -> bytes:
    """The text's words, in lower case, between spaces."""
    if not text.isascii():
        text = UNSPACED.sub(r" \1 ", EAST_MARKS.sub(" ", text))
    return text.lower().encode("utf-8", "replace").translate(MARKS)


def words(text: str) -> list[int]:
    return list(map(crc32, spaced(text).split()))


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``words`` of all texts in a row, and how many each has."""
    per_text = [words(t) for t in texts]
    counts = np.fromiter(map(len, per_text), np.int64, len(per_text))
    return np.fromiter(chain.from_iterable(per_text), np.uint32, int(counts.sum())), counts


@dataclass
class Settings:
    bits: int = 15
    size: int = 24
    stride: int = 8
    rank: int = 64
    cosine: float = 0.4
    overlap: float = 0.25
    sure: float = 0.8
    likely: float = 0.6
    min_words: int = 8
    block_items: int = 10_000
    block_words: int = 1_000_000


def bucket(ids: np.ndarray, bits: int) -> np.ndarray:
    return ((ids * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int64)


def chunk_sums(table: np.ndarray, b: np.ndarray, counts: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows ``table[b]`` over runs of ``step`` words within each
    text, and the runs per text. Texts are padded to whole runs with the
    table's last row, which is zero, and the words at one place of all runs
    are added at a time."""
    runs = -(-counts // step)
    padded = np.full(int(runs.sum()) * step, len(table) - 1, dtype=np.int64)
    shift = (np.cumsum(runs) - runs) * step - (np.cumsum(counts) - counts)
    padded[np.arange(len(b)) + np.repeat(shift, counts)] = b
    places = padded.reshape(-1, step)
    total = np.zeros((len(places), *table.shape[1:]), dtype=table.dtype)
    for at in range(0, len(places), 2048):
        for k in range(step):
            total[at:at + 2048] += table[places[at:at + 2048, k]]
    return total, runs


def with_zero(table: np.ndarray) -> np.ndarray:
    return np.concatenate([table, np.zeros_like(table[:1])])


def passages(ids: np.ndarray, counts: np.ndarray, axes: np.ndarray, idf: np.ndarray, s: Settings):
    """Latent rows of the passages that start every ``stride`` words, each
    passage's text and first word. A passage is shorter at a text's end, and
    starts only where it has words the one before has not."""
    b = bucket(ids, s.bits)
    rows, runs = chunk_sums(axes, b, counts, s.stride)
    norm, _ = chunk_sums(idf ** 2, b, counts, s.stride)
    per = s.size // s.stride
    text = np.repeat(np.arange(len(counts)), runs)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
    total, weight = rows.copy(), norm.copy()
    for k in range(1, per):
        same = text[k:] == text[:-k]
        total[:-k][same] += rows[k:][same]
        weight[:-k][same] += norm[k:][same]
    keep = nth <= np.maximum(runs[text] - per, 0)
    return total[keep] / np.sqrt(weight[keep] + 1e-9)[:, None], text[keep], nth[keep] * s.stride


def summed(table: DataFrame, fn, width: int) -> np.ndarray:
    """``width`` numbers to which ``fn(ids, counts, total)`` adds for every
    slice. As many tasks as the cluster runs at a time share the slices, so the
    number of partial sums follows the cluster and not the data; a sum is cut
    into ranges, each added up by one reducer, and only the ranges' totals reach
    the driver."""
    ends = np.linspace(0, width, GROUPS + 1).astype(np.int64)
    schema = pa.schema([("part", pa.int32()), ("total", pa.binary())])

    def per_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total = np.zeros(width) if total is None else total
                ids = unsqueeze(a, np.uint32)
                if len(ids):
                    fn(ids, unsqueeze(b, np.int64), total)
        if total is not None:
            for k in range(GROUPS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([squeeze(total[ends[k]:ends[k + 1]])], pa.binary())], schema=schema)

    def per_range(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = unsqueeze(t, np.float64)
                own[k] = own[k] + x if k in own else x
        for k, x in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([squeeze(x)], pa.binary())], schema=schema)

    tasks = max(2 * table.sparkSession.sparkContext.defaultParallelism, 1)
    parts = table.select("ids", "counts").coalesce(tasks).mapInArrow(per_task, "part int, total binary")
    total = np.zeros(width)
    for r in parts.repartition(GROUPS, "part").mapInArrow(per_range, "part int, total binary").toLocalIterator():
        total[ends[r[0]]:ends[r[0] + 1]] = unsqueeze(bytes(r[1]), np.float64)
    return total


def bucket_sums(rows: np.ndarray, passage: np.ndarray, b: np.ndarray, bits: int, few: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of the words ``b`` and, for each, the sum of its words'
    passages' ``rows``. Rare buckets add one word of each at a time, frequent
    ones go through a count matrix."""
    order = b.astype(np.uint16).argsort(kind="stable") if bits <= 16 else b.argsort(kind="stable")
    b, at = b[order], passage[order]
    first = np.flatnonzero(np.diff(b, prepend=-1))
    n = np.diff(first, append=len(b))
    out = np.zeros((len(first), rows.shape[1]), dtype=rows.dtype)
    for k in range(few):
        rare = np.flatnonzero((n > k) & (n <= few))
        out[rare] += rows[at[first[rare] + k]]
    often = np.flatnonzero(n > few)
    step = max((1 << 18) // max(len(rows), 1), 1)
    for k in range(0, len(often), step):
        own = often[k:k + step]
        word = np.repeat(first[own] - (np.cumsum(n[own]) - n[own]), n[own]) + np.arange(n[own].sum())
        pair = np.repeat(np.arange(len(own)), n[own]) * len(rows) + at[word]
        out[own] = np.bincount(pair, minlength=len(own) * len(rows)).reshape(len(own), -1).astype(rows.dtype) @ rows
    return b[first], out


def word_table(docs: DataFrame) -> DataFrame:
    """Slices of documents as arrays: ``doc_ids, known, ids, counts``."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts = words_of(texts_of(part))
        known = part.column(0).is_valid().to_numpy(zero_copy_only=False)
        doc = part.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array([squeeze(x)], pa.binary()) for x in (ids, counts, doc, known)],
            names=["ids", "counts", "doc_ids", "known"])

    return map_slices(docs.select("doc_id", "text"), run, "ids binary, counts binary, doc_ids binary, known binary", limit=1 << 18)


def latent_axes(table: DataFrame, s: Settings, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(axes with the bucket weights applied, weights, mean latent row); a
    zero row ends the first two."""
    size = 1 << s.bits

    def frequency(ids, counts, total):
        runs = -(-counts // s.size)
        text = np.repeat(np.arange(len(counts)), counts)
        nth = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
        passage = (np.cumsum(runs) - runs)[text] + nth // s.size
        pair = np.unique(passage * size + bucket(ids, s.bits))
        total[:size] += np.bincount(pair % size, minlength=size)
        total[size] += runs.sum()

    seen = summed(table, frequency, size + 1)
    idf = np.log((seen[-1] + 1) / (seen[:-1] + 1)) + 1e-3

    def rows_of(ids, counts, axes):
        b = bucket(ids, s.bits)
        rows, runs = chunk_sums(axes, b, counts, s.size)
        norm, _ = chunk_sums(square, b, counts, s.size)
        return b, rows / np.sqrt(norm + 1e-9)[:, None], norm, runs

    idf32 = with_zero(idf.astype(np.float32))
    square = idf32 ** 2
    start = with_zero(np.random.default_rng(seed).normal(size=(size, s.rank + 8)).astype(np.float32)
                      * idf32[:-1, None])
    wide = start.shape[1]

    def power(ids, counts, total):
        b, rows, norm, runs = rows_of(ids, counts, start)
        text = np.repeat(np.arange(len(counts)), counts)
        nth = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
        passage = (np.cumsum(runs) - runs)[text] + nth // s.size
        own, back = bucket_sums(rows / np.sqrt(norm + 1e-9)[:, None], passage, b, s.bits)
        total.reshape(size, wide)[own] += back

    q, _ = np.linalg.qr(summed(table, power, size * wide).reshape(size, wide) * idf[:, None])
    basis = with_zero((q * idf[:, None]).astype(np.float32))

    def gram(ids, counts, total):
        rows = rows_of(ids, counts, basis)[1].astype(np.float64)
        total[:wide * wide] += (rows.T @ rows).reshape(-1)
        total[wide * wide:] += rows.sum(axis=0)

    got = summed(table, gram, wide * wide + wide)
    value, vector = np.linalg.eigh(got[:wide * wide].reshape(wide, wide))
    kept = [k for k in np.argsort(-value)[:s.rank] if value[k] > 1e-9 * max(value.max(), 1e-30)]
    turn = vector[:, kept] / np.sqrt(value[kept])
    n = max(seen[-1], 1)
    return (basis @ turn).astype(np.float32), idf32, (got[wide * wide:] / n @ turn).astype(np.float32)


def places(a: list[int]) -> dict[int, int]:
    """Where each word stands, as bits."""
    masks: dict[int, int] = {}
    for k, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << k
    return masks


def subsequence(n: int, masks: Iterable[int]) -> int:
    """Length of the longest common subsequence of ``n`` words and others
    given by their places among them, by bit-parallel rows."""
    full = (1 << n) - 1
    v = full
    for m in masks:
        u = v & m
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def common_subsequence(a: list[int], b: list[int]) -> int:
    masks = places(a)
    return subsequence(len(a), [masks[y] for y in b if y in masks])


def last_sentence(text: str) -> list[int]:
    """The item's answer: the words of its last sentence that has any."""
    for part in reversed(re.split(r"\n|\. |[。．！？]", text)):
        if found := words(part):
            return found
    return []


class Prefixes:
    """Prefix tree of word sequences; finds each where its words stand in a
    row. A node is its place in ``edges``, sorted (parent's number, word)."""

    def __init__(self, items: list[tuple[int, list[int]]]):
        number: dict[tuple, int] = {(): 0}
        for _, own in items:
            for n in range(1, len(own) + 1):
                number.setdefault(tuple(own[:n]), len(number))
        rows = sorted((number[p[:-1]] << 32 | p[-1], k, p) for p, k in number.items() if p)
        self.edges = np.array([r[0] for r in rows], dtype=np.uint64)
        self.nodes = np.array([r[1] for r in rows], dtype=np.uint64)
        self.first = np.unique(np.array([own[0] for _, own in items], dtype=np.uint32))
        ends: dict[int, list] = {}
        for item_id, own in items:
            ends.setdefault(number[tuple(own)], []).append(item_id)
        self.ends = ends
        self.is_end = np.zeros(len(number), dtype=bool)
        self.is_end[list(ends)] = True

    def found(self, ids: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
        """``text, first place, words, item_id`` for each text and sequence."""
        if not len(self.edges):
            return
        text = np.repeat(np.arange(len(counts)), counts)
        start = np.cumsum(counts) - counts
        at = np.flatnonzero(np.isin(ids, self.first))
        node, n = np.zeros(len(at), dtype=np.uint64), 0
        while len(at):
            inside = at + n < (start + counts)[text[at]]
            at, node = at[inside], node[inside]
            key = node << np.uint64(32) | ids[at + n].astype(np.uint64)
            place = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            goes = self.edges[place] == key
            at, node, n = at[goes], self.nodes[place[goes]], n + 1
            done = np.flatnonzero(self.is_end[node.astype(np.int64)])
            if len(done):
                ended, where = node[done].astype(np.int64), at[done]
                pair = text[where] * len(self.is_end) + ended
                for j in np.unique(pair, return_index=True)[1].tolist():
                    t = int(text[where[j]])
                    for item_id in self.ends[int(ended[j])]:
                        yield t, int(where[j] - start[t]), n, item_id


def item_blocks(benchmark: DataFrame, s: Settings) -> Iterator[list[tuple]]:
    """All items as ``(item_id, words, answer)``, a block at a time."""
    block, size = [], 0
    for r in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        own = words(r["text"])
        if not own:
            continue
        if block and (len(block) >= s.block_items or size + len(own) > s.block_words):
            yield block
            block, size = [], 0
        block.append((r["item_id"], own, last_sentence(r["text"])))
        size += len(own)
    if block:
        yield block


SCHEMA = ("doc_id long, item_id long, start_word long, cosine double, lcs long, coverage double, "
          "answer_found boolean")


def matches(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``doc_id, item_id, start_word, cosine, lcs, coverage, answer_found``:
    documents that hold a benchmark item, with the best stretch for each."""
    s = settings or Settings()
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/matches-{uuid.uuid4().hex}"
    table = None
    for items in item_blocks(benchmark, s):
        if table is None:
            table = shared_table(word_table(docs), "passages")
            latent = latent_axes(table, s)
        found, shared = block_matches(table, latent, items, s)
        found.write.mode("append").option("compression", "zstd").parquet(path)
        shared.destroy()
    if table is None:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path).distinct()


def block_matches(table: DataFrame, latent: tuple, items: list[tuple], s: Settings) -> tuple[DataFrame, Broadcast]:
    """The matches of one block of items, and what was sent to the tasks."""
    axes, idf, mean = latent
    short = Prefixes([(item_id, own) for item_id, own, _ in items if len(own) < s.min_words])
    items = [(item_id, own, answer, Counter(own)) for item_id, own, answer in items if len(own) >= s.min_words]
    windows, owner = [], []
    for k, (_, own, *_) in enumerate(items):
        starts = [*range(0, max(len(own) - s.size, 0) + 1, s.size // 2), max(len(own) - s.size, 0)]
        for at in sorted(set(starts)):
            b = bucket(np.array(own[at:at + s.size], np.uint32), s.bits)
            windows.append(axes[b].sum(axis=0) / np.sqrt((idf[b] ** 2).sum() + 1e-9) - mean)
            owner.append(k)
    member = np.zeros((len(items), -(-(1 << s.bits) // 8)), dtype=np.uint8)
    weight = np.zeros(len(items), dtype=np.float32)
    for k, (_, own, *_) in enumerate(items):
        b = bucket(np.array(own, np.uint32), s.bits)
        member[k] = np.packbits(np.bincount(b, minlength=1 << s.bits) > 0)
        weight[k] = (idf[b] ** 2).sum()
    target = np.array(windows, dtype=np.float32).reshape(len(windows), axes.shape[1])
    target /= np.linalg.norm(target, axis=1, keepdims=True) + 1e-12
    shared = table.sparkSession.sparkContext.broadcast((axes, idf, mean, target, np.array(owner), items, member, weight, short))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        axes, idf, mean, target, owner, items, member, weight, short = shared.value
        spots: dict[int, dict[int, int]] = {}
        for batch in batches:
            for a, b, c, d in zip(*(batch.column(k).to_pylist() for k in range(4))):
                ids, counts = unsqueeze(a, np.uint32), unsqueeze(b, np.int64)
                doc, known = unsqueeze(c, np.int64), unsqueeze(d, bool)
                rows = [(int(doc[t]) if known[t] else None, item_id, at, None, n, 1.0, True)
                        for t, at, n, item_id in short.found(ids, counts)]
                if rows:
                    yield as_batch(rows)
                if not len(target):
                    continue
                x, text, at = passages(ids, counts, axes, idf, s)
                x -= mean
                x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-12
                best: dict[tuple[int, int], tuple] = {}
                begin = np.cumsum(counts) - counts
                b = np.append(bucket(ids, s.bits), 0)
                value = np.append(idf[b[:-1]] ** 2, 0)  # of the words; the last place stands for none
                first = begin[text] + at
                spot = first[:, None] + np.arange(s.size)
                spot = np.where(spot < (begin + counts)[text][:, None], spot, len(ids))
                worth = value[spot]
                whole = worth.sum(axis=1)
                byte, bit = (b >> 3)[spot], (7 - (b & 7)).astype(np.uint8)[spot]
                step = max((1 << 21) // len(target), 1)
                for k in range(0, len(x), step):
                    cosine = x[k:k + step] @ target.T
                    near = np.flatnonzero(cosine >= s.cosine)
                    p, w = np.divmod(near, len(target))
                    # the windows of an item meet a passage once, at their best cosine
                    p, item, close = best_of(p, owner[w], cosine.reshape(-1)[near])
                    p += k
                    fits = weighs(p, item, worth, whole, byte, bit, member, weight)
                    p, item, close = p[fits], item[fits], close[fits]
                    may = could(ids, begin[text[p]], at[p], counts[text[p]], item, items)
                    for t, a, i, c in zip(text[p[may]].tolist(), at[p[may]].tolist(), item[may].tolist(), close[may].tolist()):
                        judge(best, spots, ids, counts, begin, t, a, i, c, items)
                rows = [(int(doc[t]) if known[t] else None, items[k][0], *v) for (t, k), v in sorted(best.items())]
                if rows:
                    yield as_batch(rows)

    def best_of(p, item, cosine):
        """Distinct (passage, item) pairs with their largest cosine; pairs come
        sorted, as an item's windows stand together."""
        first = np.flatnonzero((np.diff(p, prepend=-1) != 0) | (np.diff(item, prepend=-1) != 0))
        return p[first], item[first], np.maximum.reduceat(cosine, first) if len(first) else cosine

    def weighs(p, item, worth, whole, byte, bit, member, weight) -> np.ndarray:
        """Which pairs share enough of their words' weight."""
        out = np.zeros(len(item), dtype=bool)
        flat = member.reshape(-1)
        for k in range(0, len(item), 1 << 11):
            at, i = p[k:k + (1 << 11)], item[k:k + (1 << 11)]
            bits = flat.take(byte[at] + (i * member.shape[1])[:, None]) >> bit[at] & 1
            share = np.einsum("ij,ij->i", worth[at], bits.astype(worth.dtype))
            out[k:k + (1 << 11)] = share >= s.overlap * np.minimum(whole[at], weight[i])
        return out

    def could(ids, begin, at, counts, item, items) -> np.ndarray:
        """Which pairs' stretches hold enough of the item's words: all its
        words, however often the stretch has them, an upper bound of what
        ``judge`` counts. Compared as arrays, items of like length together;
        the two numbers that fill the rows up could only raise the bound."""
        lengths = np.fromiter((len(i[1]) for i in items), np.int64, len(items))[item]
        out = np.zeros(len(item), dtype=bool)
        order, k = np.argsort(lengths, kind="stable"), 0
        while k < len(order):
            # as many pairs as fit, by the longest item among them
            n = 1
            while k + n < len(order) and n < 4096 and 2 * n * lengths[order[min(k + 2 * n, len(order)) - 1]] * (
                    s.size + 2 * lengths[order[min(k + 2 * n, len(order)) - 1]]) <= 1 << 23:
                n *= 2
            rows = order[k:k + n]
            most = int(lengths[rows].max())
            low = np.maximum(at[rows] - lengths[rows], 0)
            high = np.minimum(at[rows] + s.size + lengths[rows], counts[rows])
            place = low[:, None] + np.arange(s.size + 2 * most)
            stretch = np.where(place < high[:, None], ids[np.minimum(begin[rows][:, None] + place, len(ids) - 1)], np.uint32(0xFFFFFFFF))
            own = np.full((len(rows), most), 0xFFFFFFFE, dtype=np.uint32)
            for r, i in enumerate(item[rows].tolist()):
                own[r, :len(items[i][1])] = items[i][1]
            if most <= 512:
                have = (own[:, :, None] == stretch[:, None, :]).any(axis=2).sum(axis=1)
            else:
                have = np.array([np.isin(a, c).sum() for a, c in zip(own, stretch)])
            out[rows] = have / lengths[rows] >= min(s.likely, s.sure)
            k += n
        return out

    def as_batch(rows) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow)

    def judge(best, spots, ids, counts, begin, t, at, k, cosine, items) -> None:
        own, answer, times = items[k][1:]
        low, high = max(at - len(own), 0), min(at + s.size + len(own), int(counts[t]))
        stretch = ids[begin[t] + low:begin[t] + high].tolist()
        # no subsequence is longer than the words in common, each as often as in both
        have = Counter(stretch)
        if sum(min(n, have[x]) for x, n in times.items()) / len(own) < min(s.likely, s.sure):
            return
        masks = spots.get(k) or places(own)
        if len(own) <= 1024:  # kept for the item's next candidate
            spots[k] = masks
        lcs = densest(own, masks, stretch)
        coverage = lcs / len(own)
        answered = bool(answer) and common_subsequence(answer, stretch) == len(answer)
        if coverage >= s.sure or coverage >= s.likely and answered:
            old = best.get((t, k))
            if old is None or (lcs, cosine) > (old[2], old[1]):
                best[t, k] = (low, cosine, lcs, coverage, answered)

    def densest(own, masks, stretch) -> int:
        """The most of the item in any part of the stretch not much longer
        than the item, so that scattered common words do not add up. Only the
        item's own words count, and a part with no more of them than the best
        so far has in order cannot have more."""
        room = len(own) + len(own) // 4 + 2
        at = [k for k, x in enumerate(stretch) if x in masks]
        shared = [masks[stretch[k]] for k in at]
        step, last = max(len(own) // 8, 1), max(len(stretch) - room, 0)
        most = 0
        for a in [*range(0, last, step), last]:
            low, high = bisect_left(at, a), bisect_left(at, a + room)
            if high - low > most:
                most = max(most, subsequence(len(own), shared[low:high]))
        return most

    names = [f.split()[0] for f in SCHEMA.split(", ")]
    arrow = pa.schema(list(zip(names, [pa.int64()] * 3 + [pa.float64(), pa.int64(), pa.float64(), pa.bool_()])))
    return table.select("ids", "counts", "doc_ids", "known").mapInArrow(search, SCHEMA), shared


def remove(docs: DataFrame, benchmark: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``docs`` without the rows that match an item, all columns. Rows are told
    apart by a number of their own, so a row goes or stays by its own text,
    whatever its id."""
    row, bad_row = fresh("row", docs.columns), fresh("bad_row", docs.columns)
    numbered = shared_table(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    bad = cut_lineage(matches(numbered.select(F.col(row).alias("doc_id"), "text"), benchmark, settings)
                      .select(F.col("doc_id").alias(bad_row)).distinct())
    return numbered.join(bad, F.col(row) == F.col(bad_row), "left_anti").drop(row)
