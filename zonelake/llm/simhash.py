"""SimHash near-duplicates by anchor points.

Fingerprints: 64-bit SimHash over XXH64 (seed 42) of word shingles, computed
per text in numpy. Links: fingerprints that differ in at most ``t`` bits.

Covering. The 64 bits are cut in a part A of 33 bits and a part B of 31. If
two fingerprints differ in at most ``t`` bits, they differ in none of A's bits
or in at most ``t - 1`` of B's. A's anchors are all 33-bit words (covering
radius 0, threshold 0: one anchor each). B's anchors are the words of the
Hamming code [31, 26], a perfect code of covering radius 1; a fingerprint goes
to every anchor within 1 + (t - 1) = t bits. Two fingerprints that link share
an anchor, because the one nearest to the first is within ``t`` of the second.
The comparison at an anchor is over all 64 bits, so links are exact.

Scale. Only distinct fingerprints are replicated (a group of exact copies is
one row). Anchors with more than ``split_at`` fingerprints are split by three
parts of the bits their own part leaves free; two linked fingerprints agree in
one of three when t <= 2. Per anchor only a spanning forest leaves the task,
never all pairs. Components: alternating large-star and small-star steps,
with the lineage cut in the checkpoint folder after each.

Defined results: a null or empty text has fingerprint zero; fewer words than a
shingle give one shingle of all words; rows with the same ``doc_id`` keep one
row each; null ids keep their row and never become a component id unless the
whole component has none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.llm.common import cut_lineage, fresh, map_slices, shared_table, sums_by, tasks_for

A_BITS, B_BITS = 33, 31
BYTE_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(words: list[bytes], width: int) -> Iterable[int]:
    """XXH64 of each run of ``width`` words, joined by a space."""
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())
    return map(xxhash.xxh64_intdigest, [joined[a:b] for a, b in spans], repeat(42))


def fingerprints(texts: list[str], width: int) -> np.ndarray:
    """Bit b is set if it is set in over half the shingle hashes. Bits are
    counted in the byte lanes of a word, over runs of at most 255 hashes."""
    per_text = [list(shingle_hashes(t.encode("utf-8", "replace").lower().split(), width)) for t in texts]
    counts = np.fromiter(map(len, per_text), np.int64, len(per_text))
    h = np.fromiter(chain.from_iterable(per_text), np.uint64, int(counts.sum()))
    runs = -(-counts // 255)
    text_of_run = np.repeat(np.arange(len(texts)), runs)
    nth = np.arange(len(text_of_run)) - np.repeat(np.cumsum(runs) - runs, runs)
    run_start = (np.cumsum(counts) - counts)[text_of_run] + nth * 255
    ones = np.zeros((len(texts), 8, 8), dtype=np.int64)
    if len(h):
        first = np.cumsum(runs) - runs
        for bit in range(8):
            lanes = np.add.reduceat((h >> np.uint64(bit)) & BYTE_LANES, run_start)
            lanes = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
            ones[:, :, bit] = sums_by(lanes, first, runs)
    set_bits = (2 * ones > counts[:, None, None]).reshape(len(texts), 64)
    return np.packbits(set_bits, axis=1, bitorder="little").view("<u8").reshape(-1)


def with_fingerprints(docs: DataFrame, width: int, name: str = "fp") -> DataFrame:
    """``docs`` with the 64 bits of each row's ``text`` as a signed long."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(part.schema.get_field_index("text"))
        fp = fingerprints([t or "" for t in texts.to_pylist()], width).view(np.int64)
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(fp)], names=[*part.schema.names, name])

    return map_slices(docs, run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def flips_by_syndrome(weight: int) -> list[np.ndarray]:
    """For each Hamming syndrome, the masks of at most ``weight`` bits that
    lead from a word with that syndrome to a code word."""
    masks, syndromes = [0], [0]
    layer = [(0, 0, 0)]
    for _ in range(weight):
        layer = [(i + 1, m | 1 << i, s ^ (i + 1)) for at, m, s in layer for i in range(at, B_BITS)]
        masks += [m for _, m, _ in layer]
        syndromes += [s for _, _, s in layer]
    masks, syndromes = np.array(masks, dtype=np.uint64), np.array(syndromes)
    return [masks[syndromes == s] for s in range(B_BITS + 1)]


def anchors(fp: np.ndarray, t: int, flips: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(index into fp, anchor key) pairs. Keys of part B have bit 62 set."""
    a = fp & np.uint64((1 << A_BITS) - 1)
    if t == 0:
        return np.arange(len(fp)), a.astype(np.int64)
    b = fp >> np.uint64(A_BITS)
    syndrome = np.zeros(len(fp), dtype=np.int64)
    for i in range(B_BITS):
        syndrome ^= ((b >> np.uint64(i)) & np.uint64(1)).astype(np.int64) * (i + 1)
    rows, keys = [np.arange(len(fp))], [a]
    for s in np.unique(syndrome):
        own = np.flatnonzero(syndrome == s)
        rows.append(np.repeat(own, len(flips[s])))
        keys.append((b[own][:, None] ^ flips[s]).reshape(-1) | np.uint64(1 << 62))
    return np.concatenate(rows), np.concatenate(keys).astype(np.int64)


def group_forest(group: np.ndarray, t: int) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of the link graph among one anchor's
    fingerprints: a breadth-first walk that compares a member with all the
    unvisited ones at once."""
    rest = group
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = np.bitwise_count(rest ^ x) <= t
            if near.any():
                found = rest[near]
                rest = rest[~near]
                queue.extend(found)
                yield from zip(repeat(int(x)), found.tolist())


def anchor_links(keyed: DataFrame, t: int, parts: int) -> DataFrame:
    """Spanning links ``u, v`` per key of ``keyed`` (``key, sub, fp``)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3

        def links(key, sub, fp):
            new = np.flatnonzero(np.diff(key) | np.diff(sub)) + 1
            starts = np.concatenate([[0], new])
            sizes = np.diff(np.concatenate([starts, [len(key)]]))
            ufp = fp.view(np.uint64)
            u, v = [], []
            two = starts[sizes == 2]
            hit = two[np.bitwise_count(ufp[two] ^ ufp[two + 1]) <= t]
            u.extend(fp[hit].tolist())
            v.extend(fp[hit + 1].tolist())
            for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
                for x, y in group_forest(ufp[s:s + n], t):
                    u.append(x - (1 << 64) if x >> 63 else x)
                    v.append(y - (1 << 64) if y >> 63 else y)
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            cols = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns)]
            if not len(cols[0]):
                continue
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            done = last[-1] + 1 if len(last) else 0
            held = [c[done:] for c in cols]
            if done:
                yield links(*(c[:done] for c in cols))
        if len(held[0]):
            yield links(*held)

    return (keyed.repartition(parts, "key", "sub").sortWithinPartitions("key", "sub")
            .mapInArrow(run, "u long, v long"))


def links(distinct: DataFrame, t: int, split_at: int = 4096) -> DataFrame:
    """Links between distinct fingerprints (``fp``), enough to connect every
    component; ``u > v`` as signed longs."""
    if not 0 <= t <= 2:
        raise ValueError("the covering is built for at most two differing bits")
    flips = flips_by_syndrome(t)

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            row, key = anchors(fp.view(np.uint64), t, flips)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], names=["key", "fp"])

    keyed = distinct.select("fp").mapInArrow(spread, "key long, fp long")
    large = keyed.groupBy("key").count().where(F.col("count") > split_at).select("key", F.lit(True).alias("large"))
    in_b = F.col("key").bitwiseAND(F.lit(1 << 62)) != 0

    def piece(k: int):
        """Part k of three of the bits that the anchor's own part leaves."""
        a = F.shiftrightunsigned("fp", 11 * k).bitwiseAND(F.lit((1 << 11) - 1))
        width = 11 if k == 2 else 10
        b = F.shiftrightunsigned("fp", A_BITS + 10 * k).bitwiseAND(F.lit((1 << width) - 1))
        return F.when(in_b, a).otherwise(b) * 4 + (k + 1)

    subs = F.when(F.col("large"), F.array(*(piece(k) for k in range(3)))).otherwise(F.array(F.lit(0).cast("long")))
    split = keyed.join(large, "key", "left").select("key", F.explode(subs).alias("sub"), "fp")
    found = anchor_links(split, t, tasks_for(distinct.sparkSession))
    return found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """``u, v``: each node of ``edges`` that is not the smallest of its
    component, with that smallest node, by large-star and small-star steps."""
    edges = cut_lineage(edges)
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = cut_lineage(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges
        before = now


def rooted(marked: DataFrame, max_bits: int) -> DataFrame:
    """``fp, first, root`` for each distinct fingerprint of ``marked``
    (``doc_id, fp``): its smallest id and its component."""
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = component_roots(links(distinct, max_bits))
    return (distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left")
            .select("fp", "first", F.coalesce("v", "fp").alias("root")))


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``: components of
    fingerprints linked at ``max_bits`` or fewer differing bits, named by
    their smallest ``doc_id``."""
    marked = cut_lineage(with_fingerprints(docs.select("doc_id", "text"), width).select("doc_id", "fp"))
    placed = rooted(marked, max_bits)
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(names, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, width: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of each component, all columns: one with the smallest id (a null
    id comes last), of those one with the smallest fingerprint, of equal ones
    any. Rows that share an id but no component are kept apart."""
    fp, same_fp, same_id = (fresh(name, docs.columns) for name in ("fp", "kept_fp", "kept_id"))
    marked = shared_table(with_fingerprints(docs, width, fp), "fingerprints")
    placed = rooted(marked.select("doc_id", F.col(fp).alias("fp")), max_bits)
    best = F.min(F.struct(F.col("first").isNull().alias("last"), "first", "fp")).alias("best")
    kept = cut_lineage(placed.groupBy("root").agg(best)
                       .select(F.col("best.fp").alias(same_fp), F.col("best.first").alias(same_id)))
    chosen = (F.col(fp) == F.col(same_fp)) & F.col("doc_id").eqNullSafe(F.col(same_id))
    return marked.join(kept, chosen, "left_semi").dropDuplicates([fp]).select(*docs.columns)
