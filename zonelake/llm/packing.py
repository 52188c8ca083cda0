"""Sequence packing as a cutting-stock problem, solved by column generation.

Documents are tokenised on Spark; a document longer than a sequence is cut
into full pieces and one remainder. Piece lengths are counted in classes of
``grain`` tokens (a bounded histogram). On the driver, a linear program over
patterns (multisets of classes that fit into a sequence) is solved by the
revised simplex method; a knapsack dynamic program over its dual prices finds
the next pattern, until none improves. Rounded-down patterns plus a first-fit
of the few left-over pieces give a list of patterns with multiplicities, whose
size depends on the number of classes and not on the data. Pieces are ranked
within their class on Spark (counts per salted bucket, so that a class with a
third of all pieces is spread), and rank decides pattern, copy and slot.

Defined results: a null or empty text is one end token; repeated rows are
packed separately; an empty table gives no rows. Only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

import os
import re
import string
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.llm.common import cut_lineage, text_slices, texts_of

CAPACITY = 2048
END_ID = 1


#: Separators for Python's str.split() that are no white space (``\\s``) for the tokenizer.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
SPACE = re.compile(rf"[^\S{NOT_SPACE}]+")


#: A full stop or comma that ends a longer run of marks, which is one word.
RUN_OF_MARKS = re.compile(r"(?:[^\w\s]|_)[.,](?:\s|\Z)")


def chunks_of(text: str) -> list[str]:
    """The text's runs without white space. In Latin-1 text, letters are
    lowered and a stop or comma after a letter or digit stands apart, as for
    the tokenizer, so that fewer different runs occur."""
    if any(c in text for c in NOT_SPACE):
        return [c for c in SPACE.split(text) if c]
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text.split()
    if "<|" in text or RUN_OF_MARKS.search(text):
        return text.split()
    text = text.lower()
    for mark in (".", ","):
        text = text.replace(f"{mark} ", f" {mark} ").replace(f"{mark}\n", f" {mark}\n")
    return text.split()


class ChunkEncoder:
    """Token ids of a text as little-endian 32-bit bytes. The tokenizer drops
    white space and never joins across it, so each white-space-free chunk is
    encoded once and kept, up to ``keep`` chunks and as many older ones.
    Chunks of Latin letters are one word each, which its last token marks as
    ended: they are encoded many at a time, in lower case (as the tokenizer
    does) and by the model and byte alphabet alone: on such words the rest of
    the tokenizer (composition, lower case, splitting) does nothing, which is
    checked on the words themselves. A chunk of such letters and closing ASCII
    marks is the word's ids and the marks' ids (one run of marks is one word)."""

    MARKS = string.punctuation

    def __init__(self, path: str, keep: int = 250_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # the shortcut is for tokenizers built this way; others take their own path for every word
        probe = "abc ünïcödé straße ƀ zzzqx"
        if self.ids(self.bare, probe).tolist() != self.ids(self.tokenizer, probe).tolist():
            self.bare = self.tokenizer
        self.keep = keep
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    @staticmethod
    def ids(tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def words(self, words: list[str]) -> None:
        for k in range(0, len(words), 2000):
            part = words[k:k + 2000]
            text = " ".join(part)
            ids = self.ids(self.bare if unicodedata.is_normalized("NFC", text) else self.tokenizer, text)
            ends = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(ends) != len(part):
                raise ValueError("the tokenizer's words do not end with a marked token")
            buffer, at = ids.tobytes(), 0
            for word, end in zip(part, ends.tolist()):
                self.known[word] = buffer[at:end]
                at = end

    def others(self, chunks: list[str]) -> None:
        for k in range(0, len(chunks), 2000):
            part = chunks[k:k + 2000]
            for chunk, got in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.known[chunk] = np.array(got.ids, dtype="<u4").tobytes()

    def learn(self, chunks: set[str]) -> None:
        if len(self.known) > self.keep:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        plain, rest, made = set(), set(), []
        for chunk in chunks.difference(known):
            if chunk in older:
                known[chunk] = older[chunk]
                continue
            head = chunk.rstrip(self.MARKS)
            # Latin letters up to U+017F: composed, and lower case letter by letter but for U+0130
            if head.isalpha() and (head.isascii() or max(head) < "\u0180" and "\u0130" not in head):
                low, tail = head.lower(), chunk[len(head):]
                plain.add(low)
                if low != chunk:
                    made.append((chunk, low, tail))
                    if tail:
                        rest.add(tail)
            else:
                rest.add(chunk)
        for word in [w for w in plain | rest if w in older]:
            known[word] = older[word]
        self.words([w for w in plain if w not in known])
        self.others([c for c in rest if c not in known])
        known[""] = b""
        for chunk, low, tail in made:
            known[chunk] = known[low] + known[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        per_text = [chunks_of(t) for t in texts]
        self.learn(set().union(*per_text))
        ids_of = self.known.__getitem__
        return [b"".join(map(ids_of, chunks)) for chunks in per_text]


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
                 with_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``, the
    little-endian 32-bit ids, if asked for) for each piece."""
    end = np.array([END_ID], dtype="<u4").tobytes()
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), encoder(tokenizer).encode(texts_of(part))):
                    ids += end
                    for at in range(0, len(ids), 4 * capacity):
                        piece = ids[at:at + 4 * capacity]
                        row = (doc, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4)
                        rows.append((*row, piece) if with_ids else row)
                kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema + ", ids binary" * with_ids)


def knapsack(price: np.ndarray, size: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of items (``price``, integer ``size``) that
    fits into ``room``: its value and the number of each item."""
    best = np.zeros(room + 1)
    pick = np.full(room + 1, -1)
    order = np.argsort(size, kind="stable")
    size_up, price_up = size[order], price[order]
    fits = np.searchsorted(size_up, np.arange(room + 1), side="right")
    for r in range(1, room + 1):
        best[r] = best[r - 1]
        if fits[r]:
            value = best[r - size_up[:fits[r]]] + price_up[:fits[r]]
            k = int(value.argmax())
            if value[k] > best[r]:
                best[r], pick[r] = value[k], order[k]
    taken, r = np.zeros(len(size), dtype=np.int64), room
    while r > 0:
        if pick[r] < 0:
            r -= 1
        else:
            taken[pick[r]] += 1
            r -= int(size[pick[r]])
    return float(best[room]), taken


def fractional_patterns(size: np.ndarray, demand: np.ndarray, room: int, gap: float = 5e-4,
                        hold: float = 0.7, max_steps: int = 3_000) -> tuple[np.ndarray, np.ndarray]:
    """Column generation for: least number of patterns that cover ``demand``.
    Returns the basic patterns (rows) and their fractional multiplicities.

    Prices are smoothed: the knapsack sees a mix of the best prices so far and
    the current dual prices. Prices divided by the knapsack's value are
    feasible for the dual program, which bounds the optimum from below; steps
    end once the cover is within ``gap`` of that bound. Every basis on the
    way is a valid cover, also after ``max_steps``."""
    n = len(size)
    tilted = demand + 1e-7 * np.arange(1, n + 1)  # keeps the ratio test from cycling
    columns = np.diag(room // size).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    x = inverse @ tilted
    best, bound = inverse.sum(axis=0), 0.0
    for step in range(1, max_steps + 1):
        dual = inverse.sum(axis=0)
        for price in (hold * best + (1 - hold) * dual, dual):
            value, pattern = knapsack(price, size, room)
            if (price @ demand) / max(value, 1) > bound:
                best, bound = price, (price @ demand) / max(value, 1)
            if dual @ pattern > 1 + 1e-9:
                break
        else:
            break
        if x.sum() <= bound * (1 + gap) or x.sum() <= bound + 1:  # one sequence, or gap
            break
        d = inverse @ pattern
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        out = int(ratio.argmin())
        theta = ratio[out]
        x -= theta * d
        x[out] = theta
        inverse[out] /= d[out]
        others = np.arange(n) != out
        inverse[others] -= d[others, None] * inverse[out]
        columns[:, out] = pattern
        if step % 100 == 0:
            inverse = np.linalg.inv(columns)
            x = np.maximum(inverse @ tilted, 0)
    return columns.T.astype(np.int64), np.maximum(x, 0)


def pattern_plan(size: np.ndarray, demand: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """(pattern, copies) pairs whose slots cover ``demand``: the program's
    patterns rounded down, then first-fit decreasing for what is left over."""
    if not len(size):
        return []
    patterns, x = fractional_patterns(size, demand, room)
    plan, left = [], demand.astype(np.int64).copy()
    for p, copies in zip(patterns, np.floor(x + 1e-4).astype(np.int64)):
        if copies:
            plan.append((p, int(copies)))
            left -= p * copies
    left = np.maximum(left, 0)
    bins: list[tuple[int, np.ndarray]] = []
    for k in np.argsort(-size, kind="stable"):
        for _ in range(int(left[k])):
            for b, (free, own) in enumerate(bins):
                if free >= size[k]:
                    own[k] += 1
                    bins[b] = (free - size[k], own)
                    break
            else:
                own = np.zeros(len(size), dtype=np.int64)
                own[k] = 1
                bins.append((room - size[k], own))
    return plan + [(own, 1) for _, own in bins]


def slot_table(classes: np.ndarray, plan: list[tuple[np.ndarray, int]]) -> list[tuple]:
    """``class, first, per_copy, sequence, slot``: ranks from ``first`` on of
    a class go to consecutive sequences from ``sequence`` on, ``per_copy`` to
    each; ``slot`` orders the classes within a sequence."""
    rows, first, sequence = [], dict.fromkeys(classes.tolist(), 0), 0
    for pattern, copies in plan:
        for slot, k in enumerate(np.flatnonzero(pattern)):
            c, n = int(classes[k]), int(pattern[k])
            rows.append((c, first[c], n, sequence, slot))
            first[c] += n * copies
        sequence += copies
    return rows


def ranked(pieces: DataFrame, buckets: int) -> DataFrame:
    """``rank`` (from 0) of each piece within its ``class``. Ranks are counted
    per salted bucket and shifted by the counts of the buckets before."""
    salted = pieces.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = (salted.groupBy("class", "bucket").agg(F.count("*").alias("n"))
             .select("class", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")))
    within = Window.partitionBy("class", "bucket").orderBy("doc_id", "start", "ids_crc32")
    return (salted.withColumn("nth", F.row_number().over(within) - 1)
            .join(shift, ["class", "bucket"])
            .withColumn("rank", F.col("nth") + F.col("shift")).drop("bucket", "nth", "shift"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, grain: int = 8, buckets: int = 64) -> DataFrame:
    """``pieces`` (``doc_id, start, length, ids_crc32`` and any more columns)
    with ``sequence_id`` and ``offset``. At most ``capacity / grain`` length
    classes exist; a pattern holds at most ``capacity / grain`` slots."""
    if capacity % grain:
        raise ValueError("capacity must be a multiple of grain")
    spark = pieces.sparkSession
    pieces = pieces.withColumn("class", F.ceil(F.col("length") / grain).cast("int"))
    rows = pieces.groupBy("class").count().orderBy("class").collect()
    size = np.array([r[0] for r in rows], dtype=np.int64)
    demand = np.array([r[1] for r in rows], dtype=np.int64)
    slots = slot_table(size, pattern_plan(size, demand, capacity // grain))
    schema = T.StructType([T.StructField("class", T.IntegerType()),
                           T.StructField("slots", T.ArrayType(T.StructType([
                               T.StructField(n, T.LongType()) for n in ("first", "per_copy", "sequence", "slot")])))])
    by_class: dict[int, list[tuple]] = {}
    for c, *rest in slots:
        by_class.setdefault(c, []).append(tuple(rest))
    # one row per class: at most capacity / grain rows
    table = spark.createDataFrame(sorted(by_class.items()), schema)
    last_slot = F.element_at(F.filter("slots", lambda s: s["first"] <= F.col("rank")), -1)
    placed = (ranked(pieces, buckets).join(F.broadcast(table), "class").withColumn("at", last_slot)
              .withColumn("sequence_id", F.col("at.sequence")
                          + F.floor((F.col("rank") - F.col("at.first")) / F.col("at.per_copy")).cast("long"))
              .withColumn("slot", F.col("at.slot")))
    before = (Window.partitionBy("sequence_id").orderBy("slot", "rank")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
            .drop("class", "rank", "at", "slot", "slots"))


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, grain: int = 8) -> DataFrame:
    """One row per piece of ``docs``: where it lies in its document and in its
    sequence."""
    return pack(cut_lineage(token_pieces(docs, tokenizer, capacity)), capacity, grain)


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, grain: int = 8,
              pad_id: int = 0) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids`` (array of int),
    padded with ``pad_id`` to ``capacity`` unless the length is a power of
    two."""
    from zonelake.llm.common import shared_table

    pieces = shared_table(token_pieces(docs, tokenizer, capacity, with_ids=True), "pieces")
    placed = pack(pieces, capacity, grain)

    def join(pdf):
        ids = np.frombuffer(b"".join(pdf.sort_values("offset")["ids"]), dtype="<u4").astype(np.int32)
        if len(ids) & (len(ids) - 1):
            ids = np.concatenate([ids, np.full(capacity - len(ids), pad_id, np.int32)])
        return pdf.head(1)[["sequence_id"]].assign(ids=[ids])

    return placed.groupBy("sequence_id").applyInPandas(join, "sequence_id long, ids array<int>")
