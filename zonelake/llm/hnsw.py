"""Approximate nearest neighbours: one navigable small-world graph per shard.

Vectors are dealt to shards of about ``shard_rows`` rows by a hash of the id.
Each shard's task builds a hierarchical graph and stores it as flat neighbour
arrays (one row per shard: ids, vectors, and per level a nodes x degree table
of 32-bit neighbour numbers). Queries are grouped into blocks; every shard
answers every block with a best-first search down the levels, and the shard
results are merged by score. Shards and blocks are of bounded size, and a
(shard, block) pair is one unit of work, so neither side has to fit anywhere
as a whole. A shard's graph is read once for several blocks.

Largest inner product is turned into nearest neighbour by one more component,
sqrt(R^2 - |x|^2) with R the shard's largest norm. Equal vectors of a shard
are one node that carries all their ids, so a very common vector does not
clog the graph. Nodes are inserted in random order: a node's candidates are the
nearest of the nodes already in its level, in blocks, and those nearer to it
than to a kept one stay. Every node of a level can be reached from its entry.

Scores are exact inner products in double precision of the original vectors.

Defined results: vectors that are null, empty, all zero, or hold a null or
non-finite component take no part; vectors are only compared with vectors of
the same length; repeated rows of an id count once (the smallest vector).
Fewer candidates than asked for give fewer ranks; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonelake.llm.common import shared_table

DEGREE, BASE_DEGREE = 16, 64
UPPER_WIDTH = 32


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v, dim``: one finite non-zero vector per id."""
    v = F.col("embedding").cast("array<double>")
    good = ((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
            & F.exists(v, lambda x: x != 0))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(good)
            .groupBy("vec_id").agg(F.min(v).alias("v")).withColumn("dim", F.size("v")))


def levels_of(n: int, seed: int) -> np.ndarray:
    """Geometric levels, so that each one holds about 1/DEGREE of the one below."""
    u = np.random.default_rng(seed).random(n)
    level = np.floor(-np.log(u) / np.log(DEGREE)).astype(int)
    return level


def diverse(dist: np.ndarray, between: np.ndarray, degree: int) -> np.ndarray:
    """Which of the candidates of each row to keep: in order of distance, one
    is kept if it is nearer to the row's node than to every kept one. Slots
    left are filled with the nearest of the rest. ``dist`` is rows x c,
    ``between`` rows x c x c."""
    rows, c = dist.shape
    keep = np.zeros((rows, c), dtype=bool)
    for k in range(c):
        blocked = (keep & (between[:, k, :] <= dist[:, k, None])).any(axis=1)
        keep[:, k] = ~blocked & (keep.sum(axis=1) < degree) & np.isfinite(dist[:, k])
    room = degree - keep.sum(axis=1)
    spare = ~keep & np.isfinite(dist)
    return keep | spare & (np.cumsum(spare, axis=1) <= room[:, None])


def nearest_first(dist: np.ndarray, wide: int) -> np.ndarray:
    """Columns of the ``wide`` least of each row, in order. In a long row, they
    lie in the ``wide`` groups of columns with the least minima."""
    groups = dist.shape[1] // 16
    if groups > 4 * wide:
        low = dist[:, :16 * groups].reshape(len(dist), 16, groups).min(axis=1)
        pick = np.argpartition(low, wide - 1, axis=1)[:, :wide]
        some = np.concatenate([(pick[:, None, :] + groups * np.arange(16)[:, None]).reshape(len(dist), -1),
                               np.tile(np.arange(16 * groups, dist.shape[1]), (len(dist), 1))], axis=1)
        return np.take_along_axis(some, nearest_first(np.take_along_axis(dist, some, axis=1), wide), axis=1)
    near = np.argpartition(dist, wide - 1, axis=1)[:, :wide] if wide < dist.shape[1] else np.tile(
        np.arange(dist.shape[1]), (len(dist), 1))
    return np.take_along_axis(near, np.take_along_axis(dist, near, axis=1).argsort(axis=1, kind="stable"), axis=1)


def level_graph(x: np.ndarray, nodes: np.ndarray, degree: int, wide: int = 64, block: int = 256) -> np.ndarray:
    """Neighbour table (all vectors x degree, -1 where empty) of one level.
    ``nodes`` are inserted in the order given, the first one is the entry: a
    node links to diverse ones among the nearest of those before it, and these
    links stay, so that the early nodes' long ones do. The other half of a row
    takes links back from later nodes, thinned the same way."""
    n, half = len(nodes), degree // 2
    own = np.full((n, degree), -1, dtype=np.int32)  # by insertion order
    if n > 1:
        y = x[nodes]
        square = (y * y).sum(axis=1)

        def chosen(near, dist, room):
            z = y[near]
            between = square[near][:, :, None] + square[near][:, None, :] - 2 * z @ z.transpose(0, 2, 1)
            return np.nonzero(diverse(dist, between, room))

        forward = []
        for at in range(1, n, block):
            end = min(at + block, n)
            d = (-2 * y[at:end]) @ y[:end].T
            d += square[:end]
            d += square[at:end, None]
            d[:, at:][np.triu_indices(end - at)] = np.inf  # inserted later
            near = nearest_first(d, wide)
            r, c = chosen(near, np.take_along_axis(d, near, axis=1), half)
            forward.append(np.stack([r + at, near[r, c]], axis=1))
        edges = np.concatenate(forward)
        own[edges[:, 0], np.arange(len(edges)) - np.searchsorted(edges[:, 0], edges[:, 0])] = edges[:, 1]
        d = ((y[edges[:, 0]] - y[edges[:, 1]]) ** 2).sum(axis=1)
        back = edges[np.lexsort((d, edges[:, 1]))][:, ::-1]
        nth = np.arange(len(back)) - np.searchsorted(back[:, 0], back[:, 0])
        dist = np.full((n, wide), np.inf, dtype=y.dtype)
        near = np.zeros((n, wide), dtype=np.int64)
        back, nth = back[nth < wide], nth[nth < wide]
        near[back[:, 0], nth] = back[:, 1]
        dist[back[:, 0], nth] = ((y[back[:, 0]] - y[back[:, 1]]) ** 2).sum(axis=1)
        for at in range(0, n, block):
            r, c = chosen(near[at:at + block], dist[at:at + block], half)
            own[r + at, half + np.arange(len(r)) - np.searchsorted(r, r)] = near[r + at, c]
        own = reachable(y, own)
    table = np.full((len(x), own.shape[1]), -1, dtype=np.int32)
    table[nodes] = np.where(own >= 0, nodes[own], -1)
    return table


def reachable(y: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The table with every node reachable from the first one: a node that no
    path leads to is linked from the nearest reachable node with an empty
    place; where there is none, the table gets one more column."""
    done = np.zeros(len(y), dtype=bool)

    def spread(front: np.ndarray) -> None:
        while len(front):
            done[front] = True
            front = np.unique(table[front])
            front = front[front >= 0]
            front = front[~done[front]]

    spread(np.array([0]))
    while not done.all():
        k = int(np.argmin(done))
        free = np.flatnonzero(done & (table < 0).any(axis=1))
        if not len(free):
            table = np.pad(table, ((0, 0), (0, 1)), constant_values=-1)
            free = np.flatnonzero(done)
        other = free[((y[free] - y[k]) ** 2).sum(axis=1).argmin()]
        table[other, np.argmin(table[other])] = k
        spread(np.array([k]))
    return table


def build(v: np.ndarray, seed: int) -> tuple[np.ndarray, list[np.ndarray], int]:
    """(extended vectors, neighbour tables from the base up, entry node)."""
    norm = (v * v).sum(axis=1)
    x = np.concatenate([v, np.sqrt(np.maximum(norm.max() - norm, 0))[:, None]], axis=1).astype(np.float32)
    level = levels_of(len(x), seed)
    order = np.random.default_rng(seed + 1).permutation(len(x))
    order = order[(-level[order]).argsort(kind="stable")]  # upper nodes come first, so their links are long below, too
    entry = int(order[0])
    tables = [level_graph(x, order[level[order] >= k], DEGREE if k else BASE_DEGREE)
              for k in range(level.max() + 1)]
    return x, tables, entry


def walk(x: np.ndarray, table: np.ndarray, q: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Best-first search of one level for all queries at once, from each
    query's row of ``start`` (distinct nodes, -1 where fewer); per query the
    ``width`` best nodes found, best first."""
    rows = np.arange(len(q))
    seen = np.zeros((len(q), len(x)), dtype=bool)
    best = np.full((len(q), width), -1, dtype=np.int64)
    value = np.full((len(q), width), -np.inf, dtype=np.float32)
    opened = np.ones((len(q), width), dtype=bool)

    def meet(live: np.ndarray, near: np.ndarray) -> None:
        fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
        r, c = np.nonzero(fresh)
        seen[live[r], near[r, c]] = True
        s = np.full(near.shape, -np.inf, dtype=np.float32)
        s[r, c] = (x[near[r, c]] * q[live[r]]).sum(axis=1)
        ids = np.concatenate([best[live], np.where(fresh, near, -1)], axis=1)
        vals = np.concatenate([value[live], s], axis=1)
        done = np.concatenate([opened[live], ~fresh], axis=1)
        order = (-vals).argsort(axis=1, kind="stable")[:, :width]
        best[live] = np.take_along_axis(ids, order, axis=1)
        value[live] = np.take_along_axis(vals, order, axis=1)
        opened[live] = np.take_along_axis(done, order, axis=1)

    meet(rows, start)
    live = rows
    while len(live):
        k = np.where(opened[live], -np.inf, value[live]).argmax(axis=1)
        going = ~opened[live, k]
        live, k = live[going], k[going]
        if not len(live):
            break
        opened[live, k] = True
        meet(live, table[best[live, k]])
    return best


def search(x: np.ndarray, tables: list[np.ndarray], entry: int, q: np.ndarray, width: int,
           upper: int = UPPER_WIDTH) -> np.ndarray:
    """The ``width`` best nodes found for each query (-1 where fewer), best
    first. All nodes that a level finds, up to ``upper``, are where the next
    one starts, so a query is not bound to the cluster it came down in. ``q``
    has the zero component."""
    found = np.full((len(q), 1), entry, dtype=np.int64)
    for k in range(len(tables) - 1, -1, -1):
        found = walk(x, tables[k], q, found, width if k == 0 else min(upper, width))
    return found


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=-1)


def index(vectors: DataFrame, shards: int, seed: int = 1) -> DataFrame:
    """One row per shard and vector length: ``shard, dim, ids, offsets, v,
    tables, entry`` (flat arrays as bytes)."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        v, place = np.unique(np.array(pdf["v"].tolist()), axis=0, return_inverse=True)
        place = place.reshape(-1)
        order = place.argsort(kind="stable")
        ids = pdf["vec_id"].to_numpy()[order]
        offsets = np.concatenate([[0], np.cumsum(np.bincount(place))])
        _, tables, entry = build(v, seed)
        single = v.astype(np.float32)
        if (single == v).all():  # half the bytes for the same values
            v = single
        return pd.DataFrame({
            "shard": pdf["shard"].iloc[:1].to_numpy(), "dim": [v.shape[1]], "ids": [ids.tobytes()],
            "offsets": [offsets.astype(np.int64).tobytes()], "v": [v.tobytes()],
            "tables": [[t.tobytes() for t in tables]], "entry": [entry]})

    schema = "shard int, dim int, ids binary, offsets binary, v binary, tables array<binary>, entry int"
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard", "dim").applyInPandas(one, schema)


def query_blocks(queries: DataFrame, blocks: int) -> DataFrame:
    """``block, dim, ids, q``: the queries of a block as flat arrays."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": pdf["block"].iloc[:1].to_numpy(), "dim": pdf["dim"].iloc[:1].to_numpy(),
                             "qids": [pdf["vec_id"].to_numpy().tobytes()],
                             "q": [np.array(pdf["v"].tolist()).tobytes()]})

    dealt = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block", "dim").applyInPandas(one, "block int, dim int, qids binary, q binary")


class Graph:
    """A row of ``index``, opened."""

    def __init__(self, row):
        self.key = (row.shard, row.dim, row.lane)
        self.ids, self.offsets = np.frombuffer(row.ids, np.int64), np.frombuffer(row.offsets, np.int64)
        size = len(row.v) // (len(self.offsets) - 1) // row.dim
        self.v = np.frombuffer(row.v, f"f{size}").reshape(-1, row.dim).astype(np.float64)
        norm = (self.v * self.v).sum(axis=1)
        self.x = np.concatenate([self.v, np.sqrt(np.maximum(norm.max() - norm, 0))[:, None]], axis=1).astype(np.float32)
        self.tables = [np.frombuffer(t, np.int32).reshape(len(self.x), -1) for t in row.tables]
        self.entry = int(row.entry)


def answer(g: Graph, row, k: int, width: int) -> pd.DataFrame:
    """The ``k`` best of one shard for each query of one block, own id apart."""
    qids, q = np.frombuffer(row.qids, np.int64), np.frombuffer(row.q, np.float64).reshape(-1, row.dim)
    out = []
    for at in range(0, len(q), 256):
        part = q[at:at + 256]
        found = search(g.x, g.tables, g.entry, np.pad(part, ((0, 0), (0, 1))).astype(np.float32), width)
        r, c = np.nonzero(found >= 0)
        node = found[r, c]
        score = exact_scores(g.v[node], part[r])
        # each node stands for its first k + 1 ids: one of them may be the query's own
        copies = np.minimum(g.offsets[node + 1] - g.offsets[node], k + 1)
        pick = np.repeat(g.offsets[node], copies) + np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        hit = pd.DataFrame({"query_id": qids[at:at + 256][np.repeat(r, copies)], "vec_id": g.ids[pick],
                            "score": np.repeat(score, copies)})
        hit = hit[hit["query_id"] != hit["vec_id"]].sort_values(
            ["query_id", "score", "vec_id"], ascending=[True, False, True])
        out.append(hit.groupby("query_id", sort=False).head(k))
    return pd.concat(out)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, width: int = 160,
            shard_rows: int = 65536, block_rows: int = 512, lane_blocks: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` its
    ``k`` nearest other rows of ``vectors`` found (both ``vec_id, embedding``).
    A task opens a shard's graph and passes a lane of ``lane_blocks`` query
    blocks along it."""
    base = shared_table(usable(vectors), "vectors")
    asked = usable(queries)
    shards = max(1, -(-base.count() // shard_rows))
    graphs = shared_table(index(base, shards), "hnsw")
    blocks = max(1, -(-asked.count() // block_rows))
    lanes = max(-(-blocks // lane_blocks), min(blocks, -(-4 // shards)))  # several tasks for a single shard, too
    tasks = min(shards * lanes, 100_000)
    # each block goes to every shard: a stated query set against all rows, in blocks
    spread = (query_blocks(asked, blocks)
              .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
              .withColumn("lane", (F.col("block") % lanes).cast("int")).drop("block"))
    laned = graphs.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    streams = (laned.unionByName(spread, allowMissingColumns=True)
               .repartitionById(tasks, ((F.col("shard") * lanes + F.col("lane")) % tasks).cast("int"))
               .sortWithinPartitions("shard", "dim", "lane", F.col("qids").isNotNull()))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        graph = None
        for pdf in batches:
            for row in pdf.itertuples():
                if row.qids is None:
                    graph = Graph(row)
                elif graph is not None and graph.key == (row.shard, row.dim, row.lane):
                    yield answer(graph, row, k, width)

    found = streams.mapInPandas(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
