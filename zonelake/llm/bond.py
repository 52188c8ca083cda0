"""Hard negatives by a BOND vertical scan.

Vectors are stored column by column: a shard holds one array per dimension.
An anchor reads the dimensions in the order of its own descending magnitudes
and adds up each row's partial inner product. What the unread dimensions can
still add lies between two bounds, from each column's smallest and largest
value, so every row has a range for its final score. After each step the
candidate bitmap loses the rows that the ranges rule out; the last rows have
been read in full, so results are exact.

Two scans: the first finds each anchor's positives (best rows of its own
label; a row goes when its upper bound is below the k-th best lower bound).
Their scores make windows, in whole percent of the positive's score; the
second scan finds the best rows of other labels per window (a row goes when it
can't be in any window, or k rows that surely are in it beat it).

On Spark: rows are dealt to shards of about ``shard_rows`` by a hash of their
id; blocks of anchors are sent to every shard (a stated query set against all
rows, in blocks), a shard is laid out once per task and the blocks stream past
it. A shard returns a bounded number of rows per anchor (and window), merged by
a ranked window over each anchor.

Components become ``floor(scale * x)``, scores are whole numbers. Sums below
2^53 are computed in doubles, which is exact; larger components switch a shard
to Python's whole numbers, and pairs whose score leaves 64 bits are left out.

Defined results: rows with a null id, label or vector, or a component that is
null or not finite (also once scaled) take no part; of rows with one id the
one with the smallest label, then vector, counts; vectors of different lengths
never meet; ties go to the smaller id; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from zonelake.llm.common import shared_table

SHARD_ROWS, BLOCK_ROWS = 8192, 128
#: Dimensions read before the first check of the bounds; later steps double.
FIRST_STEP = 4
EXACT = 1 << 53


class Columns:
    """A shard's rows of one length, column by column."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray):
        self.ids, self.labels = ids, labels
        self.dim = v.shape[1]
        self.size = float(np.abs(v).max(initial=0.0))
        self.whole = None
        self.cols = np.ascontiguousarray(v.T)

    def for_anchor(self, a: np.ndarray):
        """Columns and anchor as doubles if all sums are exact in them, as
        Python's whole numbers otherwise."""
        if self.dim * max(self.size, 1.0) * max(float(np.abs(a).max(initial=0.0)), 1.0) < EXACT:
            return self.cols, a
        if self.whole is None:
            self.whole = np.array([[int(x) for x in c] for c in self.cols], dtype=object).reshape(self.cols.shape)
        return self.whole, np.array([int(x) for x in a], dtype=object)


def largest(x: np.ndarray, k: int):
    """The k-th largest value, None if there are fewer."""
    if k < 1 or len(x) < k:
        return None
    return np.sort(x)[-k] if x.dtype == object else np.partition(x, len(x) - k)[-k]


def vertical_scan(shard: Columns, anchor: np.ndarray, alive: np.ndarray, survivors) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``shard`` (numbers, exact scores) that ``survivors(low, high)``
    never ruled out, from the candidate bitmap ``alive``."""
    cols, a = shard.for_anchor(anchor)
    rows = np.flatnonzero(alive)
    order = np.argsort(-np.abs(anchor), kind="stable")
    score = np.zeros(len(rows), dtype=cols.dtype)
    if len(rows) and shard.dim:
        one, two = a * cols.min(axis=1), a * cols.max(axis=1)
        # what the dimensions from the k-th on can add, at least and at most
        least = np.cumsum(np.minimum(one, two)[order][::-1])[::-1]
        most = np.cumsum(np.maximum(one, two)[order][::-1])[::-1]
    at, step = 0, FIRST_STEP
    while at < shard.dim and len(rows):
        dims = order[at:at + step]
        part = cols[dims] if len(rows) == len(shard.ids) else cols[dims[:, None], rows]
        score = score + a[dims] @ part
        at, step = at + len(dims), step * 2
        low, high = (score + least[at], score + most[at]) if at < shard.dim else (score, score)
        keep = survivors(low, high)
        if not keep.all():
            rows, score = rows[keep], score[keep]
    return rows, score


def positives_of(shard: Columns, anchor_id: int, label: int, v: np.ndarray, k: int):
    def survivors(low, high):
        bar = largest(low, k)
        return np.ones(len(low), dtype=bool) if bar is None else high >= bar

    rows, score = vertical_scan(shard, v, (shard.labels == label) & (shard.ids != anchor_id), survivors)
    best = np.lexsort((shard.ids[rows], -score))[:k] if score.dtype != object else np.array(
        sorted(range(len(rows)), key=lambda i: (-score[i], shard.ids[rows[i]]))[:k], dtype=np.int64)
    return [(int(shard.ids[rows[i]]), int(score[i])) for i in best]


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Whole scores s with ``low * score <= 100 * s <= high * score``."""
    return -(-low * score // 100), high * score // 100


def negatives_of(shard: Columns, label: int, v: np.ndarray, windows: list[tuple[int, int]], k: int):
    """For each window, its ``k`` best rows of another label."""
    spans = sorted({w for w in windows if w[0] <= w[1]})

    def survivors(low, high):
        keep = np.zeros(len(low), dtype=bool)
        for lo, hi in spans:
            may = (high >= lo) & (low <= hi)
            bar = largest(low[(low >= lo) & (high <= hi)], k)
            keep |= may if bar is None else may & (high >= bar)
        return keep

    rows, score = vertical_scan(shard, v, shard.labels != label, survivors)
    ranked = sorted(((-int(s), int(shard.ids[i])) for i, s in zip(rows, score))) if spans else []
    return [[(i, -s) for s, i in ranked if lo <= -s <= hi][:k] for lo, hi in windows]


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """``id, label, v``: one row per id, components as given."""
    infinite = F.lit(float("inf"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * scale) == infinite))
    return (vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                           F.col("embedding").alias("v"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad)
            .groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.*"))


def components(column: pa.Array, scale: int) -> list[np.ndarray]:
    """The vectors of a list column, scaled and floored."""
    return [np.floor(np.asarray(v, dtype=np.float64) * scale) for v in column.to_numpy(zero_copy_only=False)]


def shard_of(held: list[pa.RecordBatch], scale: int) -> dict[int, Columns]:
    table = pa.Table.from_batches(held).combine_chunks()
    v = components(table.column("v").combine_chunks(), scale)
    ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
    dims = np.fromiter(map(len, v), np.int64, len(v))
    return {int(d): Columns(ids[dims == d], labels[dims == d],
                            np.array([v[i] for i in np.flatnonzero(dims == d)]).reshape(int((dims == d).sum()), d))
            for d in np.unique(dims)}


FITS = 1 << 63


def scan(base: DataFrame, anchors: DataFrame, shards: int, blocks: int, scale: int, answer, schema: str) -> DataFrame:
    """``answer(columns, anchor)`` for every anchor (``id, label, v`` and
    ``more``, an array of pairs) at every shard; rows of ``schema``."""
    spark = base.sparkSession
    v_type = base.schema["v"].dataType.simpleString()
    item = f"struct<id:bigint,label:bigint,v:{v_type},more:array<struct<id:bigint,score:bigint>>>"
    rows = base.select(F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"), F.lit(-1).alias("block"),
                       "id", "label", "v", F.lit(None).cast(f"array<{item}>").alias("anchors"))
    packed = (anchors.select(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
                             F.struct("id", "label", "v", "more").alias("anchor"))
              .groupBy("block").agg(F.collect_list("anchor").alias("anchors")))
    sent = packed.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "block",
                         F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("bigint").alias("label"),
                         F.lit(None).cast(v_type).alias("v"), F.col("anchors").cast(f"array<{item}>").alias("anchors"))
    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, laid = None, [], None
        for batch in batches:
            which, block = (batch.column(i).to_numpy() for i in (0, 1))
            # a sorted partition: each shard's rows (block -1), then its anchors
            cuts = np.flatnonzero((np.diff(which) != 0) | (np.diff(block) != 0)) + 1
            for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                part = batch.slice(first, last - first)
                if which[first] != at:
                    at, held, laid = which[first], [], None
                if block[first] < 0:
                    held.append(part)
                    continue
                if laid is None:
                    laid = shard_of(held, scale) if held else {}
                    held = []
                for anchors_of in part.column("anchors"):
                    found = []
                    for a in anchors_of.as_py():
                        v = np.floor(np.asarray(a["v"], dtype=np.float64) * scale)
                        if len(v) in laid:
                            found.extend(r for r in answer(laid[len(v)], a, v) if -FITS <= r[-1] < FITS)
                    if found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    return (rows.unionByName(sent).repartition(shards, "shard").sortWithinPartitions("shard", "block")
            .mapInArrow(run, schema))


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
                   low_percent: int = 50, high_percent: int = 95, scale: int = 256,
                   shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for the rows of ``vectors`` (``vec_id, label,
    embedding``) where ``is_anchor`` (a condition on ``vec_id``) holds."""
    base = shared_table(usable(vectors, scale), "bond-rows")
    anchors = base.withColumnRenamed("id", "vec_id").where(is_anchor).withColumnRenamed("vec_id", "id")
    n_rows, n_anchors = base.count(), anchors.count()
    shards, blocks = max(1, -(-n_rows // shard_rows)), max(1, -(-n_anchors // block_rows))

    def first(columns, a, v):
        return [(a["id"], i, s) for i, s in positives_of(columns, a["id"], a["label"], v, positives)]

    nothing = F.lit(None).cast("array<struct<id:bigint,score:bigint>>").alias("more")
    found = scan(base, anchors.select("id", "label", "v", nothing), shards, blocks, scale, first,
                 "anchor_id long, positive_id long, score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    pairs = shared_table(found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
                         .select("anchor_id", "positive_id", "score"), "bond-positives")

    def second(columns, a, v):
        windows = [window_of(p["score"], low_percent, high_percent) for p in a["more"]]
        return [(a["id"], p["id"], p["score"], i, s)
                for p, rows in zip(a["more"], negatives_of(columns, a["label"], v, windows, negatives))
                for i, s in rows]

    asked = pairs.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list(F.struct(F.col("positive_id").alias("id"), "score")).alias("more"))
    found = scan(base, anchors.join(asked, "id").select("id", "label", "v", "more"), shards, blocks, scale, second,
                 "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
