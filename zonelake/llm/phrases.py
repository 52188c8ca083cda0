"""Phrase collocations by SON partitioning.

A phrase is a run of 2 to 5 words inside a piece of text (pieces end at
``. , ; : ! ?`` and line breaks), counted per language with overlaps. The
corpus is dealt to K shards (whole input tasks). A phrase with ``support``
occurrences has ``ceil(support / K)`` of them in at least one shard, because K
counts below that add up to less than ``support``. So:

1. words: word counts of the corpus, summed by Spark, and each language's total;
2. mine: each shard is mined completely at the lowered support, first phrases
   of two words, then longer ones whose pairs of neighbours were found. A shard
   may be larger than a task: its tasks send their distinct windows' hashes
   with counts, sorted and compressed, to hash ranges of that shard, which add
   them up. The locally frequent hashes of all shards are united;
3. count: every occurrence of the united candidates, frequent in its shard or
   not, is counted by its words; Spark sums them. These counts are exact and
   complete. Hashes only choose candidates: one that collides is counted as
   itself and dropped.

K is fixed, so local support and the share of the windows that become
candidates stay the same at every size.

Sieves. Words of fewer than ``support`` occurrences are in no phrase, and later
steps need only candidates. Both sets grow with the corpus, so what the tasks
get is a bit table of fixed size (``sieve_bits``) that lets all members through
and some others. It lets a phrase through everywhere or nowhere, so counts stay
complete; others only cost time.

Cutting a phrase after its first words, scores and the dropping of phrases
that a longer candidate contains are joins on the counted phrases (whole
numbers as decimals of 38 digits). The best of a language are taken in salted
groups first, so no task sees all phrases of a language.

Defined results: a null text is empty, a null language is ``und``; repeated
rows count each; an empty table or one without candidates gives no rows; only
``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonelake.llm.blocks import grouped, squeeze, squeeze_sorted, unsqueeze, unsqueeze_sorted
from zonelake.llm.common import shared_table, tasks_for, text_slices
from zonelake.llm.words import LOWER, byte_table, laid_out, owner, runs, strings

SPACES, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
#: Number of shards, and the text that a task lays out at once.
SHARDS, BLOCK_BYTES = 8, 12 << 20
#: 16 MB as a bit table; a member sets two bits.
SIEVE_BITS = 27
CHUNK_BITS = 21


class Block:
    """The words of some texts: exact numbers per (language, word), and for
    each word the piece it lies in."""

    def __init__(self, text: pa.Array, lang: pa.Array):
        data, starts = laid_out(text)
        data = LOWER[data]
        breaking = byte_table(BREAKS)[data]
        inside = ~(breaking | byte_table(SPACES)[data])
        # texts end with a newline, so a piece never spans two of them
        breaks = np.flatnonzero(breaking)
        del breaking
        first, end = runs(inside)
        coded = strings(data, first, end, inside)
        del data, inside, end
        self.words = coded.dictionary.to_pylist()
        number = coded.indices.to_numpy(zero_copy_only=False)
        self.piece = np.searchsorted(breaks, first).astype(np.int32)
        langs = lang.dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int32)[owner(first, starts)]
        del first, breaks
        wide = max(len(self.words), 1)
        pairs, index = np.unique(self.lang * np.int64(wide) + number, return_inverse=True)
        self.number = index.astype(np.int32)
        self.pair_lang, self.pair_word = np.divmod(pairs, wide)

    def keys(self) -> np.ndarray:
        """A 64-bit hash of each (language, word)."""
        seeds = [xxhash.xxh64_intdigest(lang.encode()) for lang in self.langs]
        return np.fromiter((xxhash.xxh64_intdigest(self.words[w], seeds[k])
                            for k, w in zip(self.pair_lang.tolist(), self.pair_word.tolist())),
                           np.uint64, len(self.pair_word))

    def text(self, at: int, n: int) -> str:
        return b" ".join([self.words[w] for w in self.pair_word[self.number[at:at + n]].tolist()]).decode()

    def together(self, n: int) -> np.ndarray:
        """Whether the n words from each position on are in one piece."""
        return self.piece[n - 1:] == self.piece[:len(self.piece) - n + 1]


def rolled(keys: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Hashes of windows one word longer than those of ``keys``."""
    h = (keys ^ keys >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15) + longer
    return h ^ h >> np.uint64(29)


def places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a sieve that a hash sets."""
    other = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - bits)).astype(np.int64), (other >> np.uint64(64 - bits)).astype(np.int64)


def passes(sieve: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes may be members."""
    out = np.empty(len(h), dtype=bool)
    for k in range(0, len(h), 1 << 18):
        one, two = places(h[k:k + (1 << 18)], bits)
        out[k:k + (1 << 18)] = (sieve[one >> 3] >> (one & 7).astype(np.uint8)
                                & sieve[two >> 3] >> (two & 7).astype(np.uint8) & 1)
    return out


def sieve_of(members: DataFrame, bits: int) -> np.ndarray:
    """Bit table of the hashes ``h``. Built in chunks by Spark: 2^bits bits
    reach the driver, whatever the number of members."""
    chunk = min(bits, CHUNK_BITS)

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.unique(np.concatenate(places(batch.column(0).to_numpy().view(np.uint64), bits)))
            yield pa.RecordBatch.from_arrays([pa.array((place >> chunk).astype(np.int32)),
                                              pa.array(place & ((1 << chunk) - 1))], names=["chunk", "place"])

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            which = batch.column(0).to_numpy()
            for c in np.unique(which).tolist():
                own.setdefault(c, np.zeros(1 << chunk, dtype=bool))[batch.column(1).to_numpy()[which == c]] = True
        for c, marks in own.items():
            yield pa.RecordBatch.from_pydict({"chunk": [c], "marks": [np.packbits(marks, bitorder="little").tobytes()]},
                                             schema=pa.schema([("chunk", pa.int32()), ("marks", pa.binary())]))

    placed = members.select("h").mapInArrow(spread, "chunk int, place long")
    table = np.zeros(max((1 << bits) // 8, 1), dtype=np.uint8)
    size = (1 << chunk) // 8
    for row in placed.repartition(1 << bits - chunk, "chunk").mapInArrow(gather, "chunk int, marks binary").collect():
        table[row["chunk"] * size:(row["chunk"] + 1) * size] |= np.frombuffer(row["marks"], np.uint8)
    return table


def blocks_of(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[Block]:
    """A task's rows in blocks of about ``limit`` bytes of text: half of it to
    one and a half, so that no small rest is left."""
    held: list[pa.RecordBatch] = []
    sizes: list[int] = []

    def block(k: int) -> Block:
        rows = pa.Table.from_batches(held[:k])
        del held[:k], sizes[:k]
        return Block(rows.column("text").combine_chunks(), rows.column("lang").combine_chunks())

    for batch in batches:
        for part in text_slices(batch, limit=max(limit // 8, 1)):
            held.append(part)
            sizes.append(part.nbytes)
            if sum(sizes) >= limit + limit // 2:
                yield block(max(int(np.searchsorted(np.cumsum(sizes), limit, side="right")), 1))
    if held:
        yield block(len(held))


def in_runs(n: int, size: int = 1 << 16) -> Iterator[slice]:
    return (slice(k, k + size) for k in range(0, n, size))


def word_counts(docs: DataFrame, block_bytes: int) -> DataFrame:
    """``lang, phrase, h, f`` of single words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks_of(batches, block_bytes):
            words, langs = pa.array(b.words, pa.binary()).cast(pa.string()), pa.array(b.langs, pa.string())
            keys, count = b.keys().view(np.int64), np.bincount(b.number, minlength=len(b.pair_word))
            for k in in_runs(len(keys)):
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(b.pair_lang[k])), words.take(pa.array(b.pair_word[k])), pa.array(keys[k]),
                     pa.array(count[k])], names=["lang", "phrase", "h", "f"])

    return (docs.mapInArrow(run, "lang string, phrase string, h long, f long")
            .groupBy("lang", "phrase").agg(F.min("h").alias("h"), F.sum("f").alias("f")))


def locally_frequent(docs: DataFrame, common, pairs, sizes: range, support: int, shards: int, block_bytes: int,
                     bits: int) -> DataFrame:
    """``h`` of the phrases of ``sizes`` words that are frequent in a shard,
    made of common words and, if given, of known ``pairs`` of neighbours."""
    least = -(-support // shards)
    parts = tasks_for(docs.sparkSession)

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        for b in blocks_of(batches, block_bytes):
            keys = b.keys()
            h = word = keys[b.number]
            alive = passes(common.value, keys, bits)[b.number]
            found = []
            for n in range(2, min(sizes.stop, len(word) + 1)):
                alive = alive[:-1] & alive[1:] & b.together(n)
                h = rolled(h[:-1], word[n - 1:])
                if n == 2 and pairs is not None:
                    at = np.flatnonzero(alive)
                    alive[at] = passes(pairs.value, h[at], bits)
                if n in sizes:
                    found.append(np.unique(h[alive], return_counts=True))
            del b, h, word, alive
            if not found:
                continue
            h, count = (np.concatenate(x) for x in zip(*found))
            part = (h % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((h, part))
            ends = np.cumsum(np.bincount(part, minlength=parts))
            for p, k in enumerate(np.split(order, ends[:-1])):
                if len(k):
                    counts = np.minimum(count[k], least).astype(np.uint32)
                    yield pa.RecordBatch.from_pydict(
                        {"key": [shard * parts + p], "hashes": [squeeze_sorted(h[k])], "counts": [squeeze(counts)]},
                        schema=pa.schema([("key", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())]))

    def add(rows: dict[str, list]) -> Iterator[dict[str, list]]:
        h = np.concatenate([unsqueeze_sorted(x) for x in rows["hashes"]])
        count = np.concatenate([unsqueeze(x, np.uint32) for x in rows["counts"]])
        order = np.argsort(h)
        h = h[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        often = np.add.reduceat(count[order], first, dtype=np.int64) >= least
        yield {"h": h[first[often]].view(np.int64)}

    sent = docs.mapInArrow(send, "key long, hashes binary, counts binary")
    return grouped(sent, "key", parts, add, "h long").distinct()


COUNTED = pa.schema([("part", pa.int32()), ("langs", pa.list_(pa.string())), ("lang", pa.binary()),
                     ("phrases", pa.binary()), ("counts", pa.binary())])


def candidate_counts(docs: DataFrame, common, wanted, longest: int, support: int, block_bytes: int,
                     bits: int) -> DataFrame:
    """``lang, phrase, f`` of every phrase that passes the candidates' sieve and
    occurs ``support`` times. Windows are named exactly, by pairs of the name of
    the window one word shorter (parts of a candidate are candidates) and the
    next word's number. A block sends its phrases with their counts as one
    compressed list for each hash range, where equal phrases are added up."""
    parts = tasks_for(docs.sparkSession)

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks_of(batches, block_bytes):
            keys = b.keys()
            names = np.where(passes(common.value, keys, bits)[b.number], b.number, np.int32(-1))
            h = word = keys[b.number]
            found = []
            for n in range(2, min(longest, len(word)) + 1):
                at = np.flatnonzero((names[:-1] >= 0) & (names[1:] >= 0) & b.together(n))
                h = rolled(h[:-1], word[n - 1:])
                at = at[passes(wanted.value, h[at], bits)]
                pair = names[at] * np.int64(len(keys)) + b.number[at + n - 1]
                _, first, index, count = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
                names = np.full(len(names) - 1, -1, dtype=np.int32)
                names[at] = index
                first = at[first]
                found.append((first, np.full(len(first), n), count, (h[first] % np.uint64(parts)).astype(np.int32)))
            if not found:
                continue
            first, n, count, part = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(part, kind="stable")
            for k in np.split(order, np.cumsum(np.bincount(part, minlength=parts))[:-1]):
                if len(k):
                    listed = "\n".join([b.text(i, m) for i, m in zip(first[k].tolist(), n[k].tolist())]).encode()
                    yield pa.RecordBatch.from_pydict(
                        {"part": [part[k[0]]], "langs": [b.langs], "lang": [squeeze(b.lang[first[k]])],
                         "phrases": [zstandard.compress(listed)], "counts": [squeeze(count[k].astype(np.int64))]},
                        schema=COUNTED)

    def add(rows: dict[str, list]) -> Iterator[dict[str, list]]:
        names = pa.array([x for one in rows["langs"] for x in one], pa.string())
        base = np.cumsum([0, *map(len, rows["langs"])])
        lang = np.concatenate([unsqueeze(x, np.int32) + k for x, k in zip(rows["lang"], base)])
        lang = names.take(pa.array(lang)).dictionary_encode()
        phrase = pa.concat_arrays([pa.array(zstandard.decompress(x).decode().split("\n"), pa.string())
                                   for x in rows["phrases"]]).dictionary_encode()
        count = np.concatenate([unsqueeze(x, np.int64) for x in rows["counts"]])
        wide = max(len(phrase.dictionary), 1)
        pair, index = np.unique(lang.indices.to_numpy().astype(np.int64) * wide + phrase.indices.to_numpy(),
                                return_inverse=True)
        f = np.zeros(len(pair), dtype=np.int64)
        np.add.at(f, index, count)
        often = f >= support
        one, two = np.divmod(pair[often], wide)
        yield {"lang": lang.dictionary.take(pa.array(one)), "phrase": phrase.dictionary.take(pa.array(two)),
               "f": f[often]}

    sent = docs.mapInArrow(send, "part int, langs array<string>, lang binary, phrases binary, counts binary")
    return grouped(sent, "part", parts, add, "lang string, phrase string, f long")


def frequent(docs: DataFrame, longest: int = 5, support: int = 100, shards: int = SHARDS,
             block_bytes: int = BLOCK_BYTES, sieve_bits: int = SIEVE_BITS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (``lang, phrase, h, f``, all of them), words per language (``lang,
    n``) and the phrases of 2 to ``longest`` words with ``f >= support``."""
    share = docs.sparkSession.sparkContext.broadcast
    docs = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    words = shared_table(word_counts(docs, block_bytes), "words")
    totals = shared_table(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    common = share(sieve_of(words.where(F.col("f") >= support), sieve_bits))
    mined = (support, shards, block_bytes, sieve_bits)
    two = shared_table(locally_frequent(docs, common, None, range(2, 3), *mined), "pairs")
    pairs = share(sieve_of(two, sieve_bits))
    more = shared_table(locally_frequent(docs, common, pairs, range(3, longest + 1), *mined), "longer")
    wanted = share(sieve_of(two.unionByName(more), sieve_bits))
    phrases = shared_table(candidate_counts(docs, common, wanted, longest, support, block_bytes, sieve_bits), "phrases")
    for sieve in (common, pairs, wanted):
        sieve.destroy()
    return words, totals, phrases


def collocations(docs: DataFrame, longest: int = 5, support: int = 100, top: int = 2000,
                 contained_percent: int = 100, **limits) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top``
    phrases: score floor(1000 a n / (l r)) of the lowest-scoring cut. A phrase
    goes if a longer candidate contains it and has ``contained_percent`` of its
    occurrences or more."""
    words, totals, phrases = frequent(docs, longest, support, **limits)
    big = lambda c: F.col(c).cast("decimal(19,0)")
    split = phrases.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def part(first, size):
        return F.array_join(F.slice("w", first, size), " ")

    m = F.size("w")
    cuts = split.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), m - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
                       part(F.col("k") + 1, m - F.col("k")).alias("right"))
    known = phrases.unionByName(words.where(F.col("f") >= support).select("lang", "phrase", "f"))
    scored = (cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
              .join(known.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
              .join(totals, "lang")
              .select("lang", "phrase", "a", "k", "l", "r", "n",
                      F.expr("(1000BD * (cast(a as decimal(17,0)) * cast(n as decimal(17,0)))) "
                             "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))").alias("score")))
    best = (scored.groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b")).select("lang", "phrase", "b.*"))
    inner = (split.where(m > 2)
             .select("lang", "w", "a", F.explode(F.sequence(F.lit(2), m - 1)).alias("size"))
             .select("lang", "w", "a", "size", F.explode(F.sequence(F.lit(1), m - F.col("size") + 1)).alias("first"))
             .select("lang", part(F.col("first"), F.col("size")).alias("phrase"), "a")
             .groupBy("lang", "phrase").agg(F.max("a").alias("outer_a")))
    left = (best.join(inner, ["lang", "phrase"], "left")
            .where(F.col("outer_a").isNull()
                   | (100 * big("outer_a") < F.lit(contained_percent) * big("a"))))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", "salt").orderBy(*order)
    ranked = (left.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(256)))
              .withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
              .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
              .where(F.col("rank") <= top))
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
