"""Toxicity scores from a convolutional text classifier in numpy.

Words are hashed to embedding rows; filters of several widths run over the
whole text, each keeps its maximum, and a logistic layer turns the maxima into
a score. ``train`` learns from every labelled row, whatever its length: rows
are hashed once and dealt to shards by their id, each round every shard's task
goes through all its rows in small batches, starting from the same network, and
Spark averages the changes (a word's by how often each shard changed it). The
raw threshold with the best F1, overall and by language, is chosen on counts of
all scores of a quarter of the rows (by a hash of the id), which are given after
the rounds on the others; then the network learns on, from all rows. The score
is shifted so that the overall choice lies at
``at``; a language's own threshold only decides ``flagged``. ``score`` runs
over all rows in Arrow batches: the product of embeddings and filters is
tabulated once per bucket, so a word costs a few row gathers.

Only the network (at most ``2**bits`` rows) and score counts reach the driver.

Defined results: null and empty texts get the score of a text without words;
without labels of both classes every score is 0. Labels repeated for an id
count as toxic if one is; labels without a document are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from zlib import compress, crc32, decompress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.llm.common import cut_lineage, map_slices, texts_of

#: Words whose responses are held at once in training; rows of a network whose
#: changes travel together.
RUN_WORDS, BLOCK_ROWS = 1 << 15, 512
#: Steps a unit of the raw score is counted in, and the units on either side.
STEPS, REACH = 1000, 60

PUNCTUATION = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalnum() and c != 39),
                              b" " * sum(not chr(c).isalnum() and c != 39 for c in range(128)))


def word_ids(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed ids of all words in one array, and the number per text."""
    hashes: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for k, t in enumerate(texts):
        words = t.lower().encode("utf-8", "replace").translate(PUNCTUATION).split()
        counts[k] = len(words)
        hashes.extend(map(crc32, words))
    ids = np.array(hashes, dtype=np.uint32)
    return ((ids ^ ids >> np.uint32(12)) & np.uint32((1 << bits) - 1)).astype(np.int32), counts


@dataclass
class Network:
    bits: int
    widths: tuple[int, ...]
    slot: np.ndarray  # hash bucket -> row of embed; rare buckets share the last, zero row
    embed: np.ndarray
    filters: list[np.ndarray]  # per width: width x dim x filters
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    shift: float = 0.0
    threshold: float = 0.5
    by_lang: dict[str, float] = field(default_factory=dict)

    def tables(self) -> list[list[np.ndarray]]:
        """Per width and place in the filter: what each bucket adds."""
        return [[self.embed @ w[j] for j in range(len(w))] for w in self.filters]

    def maxima(self, ids: np.ndarray, counts: np.ndarray, tables=None) -> np.ndarray:
        """Texts x all filters: the largest response, never below zero. Each
        text is followed by padding, so filters see its last words and a text
        without words still has a place."""
        tables = tables or self.tables()
        gap = max(self.widths)
        pad = np.full(int(counts.sum()) + gap * len(counts), len(self.embed) - 1, dtype=np.int32)
        starts = np.cumsum(counts + gap) - counts - gap
        pad[np.arange(len(ids)) + np.repeat(np.arange(len(counts)) * gap, counts)] = self.slot[ids]
        parts = []
        for width, table, bias in zip(self.widths, tables, self.bias):
            last = len(pad) - width + 1
            y = table[0][pad[:last]]
            for j in range(1, width):
                y += table[j][pad[j:last + j]]
            # windows from a text's first word to its first padding, none of the next text
            bounds = np.stack([starts, starts + counts + 1], axis=1).reshape(-1)
            top = np.maximum.reduceat(y, bounds[:-1] if bounds[-1] >= last else bounds, axis=0)[::2]
            parts.append(np.maximum(top + bias, 0))
        return np.concatenate(parts, axis=1)

    def logits(self, maxima: np.ndarray) -> np.ndarray:
        return maxima @ self.out + self.out_bias + self.shift


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def start(known: np.ndarray, bits: int, dim: int = 16, filters: int = 16, widths: tuple[int, ...] = (1, 2, 3),
          seed: int = 7) -> Network:
    """An untrained network with a row for each bucket of ``known``."""
    rng = np.random.default_rng(seed)
    slot = np.full(1 << bits, len(known), dtype=np.int32)
    slot[known] = np.arange(len(known))
    net = Network(bits, widths, slot,
                  rng.normal(0, 0.3, (len(known) + 1, dim)).astype(np.float32),
                  [rng.normal(0, 0.3, (w, dim, filters)).astype(np.float32) for w in widths],
                  [np.zeros(filters, np.float32) for _ in widths],
                  rng.normal(0, 0.3, filters * len(widths)).astype(np.float32), 0.0)
    net.embed[-1] = 0
    return net


def peaks(net: Network, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest response of every filter to each text, where it begins, and the
    embedding rows those places are in. A long text is gone through in runs."""
    gap = max(net.widths)
    end = np.full(gap, len(net.embed) - 1, np.int32)
    words = np.concatenate([part for t in texts for part in (net.slot[t], end)])
    sizes = np.array([len(t) for t in texts])
    firsts = np.cumsum(sizes + gap) - sizes - gap
    lasts = firsts + sizes + 1  # up to the first padding
    places = np.concatenate([w[j].T for w in net.filters for j in range(len(w))])
    per = net.filters[0].shape[2]
    top = np.full((len(texts), per * len(net.widths)), -np.inf, np.float32)
    spot = np.zeros(top.shape, np.int64)
    rows = np.arange(top.shape[1])
    for at in range(0, int(lasts[-1]), RUN_WORDS):
        upto = min(at + RUN_WORDS, int(lasts[-1]))
        y = places @ net.embed[words[at:upto + gap - 1]].T
        resp = np.empty((top.shape[1], upto - at), np.float32)
        k = 0
        for f, width in enumerate(net.widths):
            own = resp[f * per:(f + 1) * per]
            own[:] = y[k * per:(k + 1) * per, :upto - at]
            for j in range(1, width):
                own += y[(k + j) * per:(k + j + 1) * per, j:j + upto - at]
            k += width
        for t in range(int(np.searchsorted(lasts, at, side="right")), int(np.searchsorted(firsts, upto))):
            lo = max(int(firsts[t]), at) - at
            here = lo + resp[:, lo:int(lasts[t]) - at].argmax(axis=1)
            value = resp[rows, here]
            more = value > top[t]
            top[t][more], spot[t][more] = value[more], here[more] + at
    return top + np.concatenate(net.bias), spot, words


class Trainer:
    """A network and what its steps need (Adam's moments, the words' sums of
    squared gradients), as one matrix ``state``: the words' rows, then the
    other values in further rows."""

    def __init__(self, net: Network):
        self.net = net
        self.params = [*net.filters, *net.bias, net.out, np.array([net.out_bias], np.float32)]
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.params]
        self.row_scale = np.zeros(len(net.embed), np.float32)
        self.step = np.zeros(1, np.float32)

    def _dense(self) -> list[np.ndarray]:
        return [*self.params, *(x for pair in self.moments for x in pair), self.step]

    def state(self) -> np.ndarray:
        flat = np.concatenate([x.reshape(-1) for x in self._dense()])
        wide = self.net.embed.shape[1] + 1
        rest = np.zeros(-(-len(flat) // wide) * wide, np.float32)
        rest[:len(flat)] = flat
        return np.concatenate([np.column_stack([self.net.embed, np.sqrt(self.row_scale)]), rest.reshape(-1, wide)])

    def load(self, state: np.ndarray) -> None:
        n = len(self.net.embed)
        self.net.embed, self.row_scale = state[:n, :-1].copy(), state[:n, -1] ** 2
        flat, at = state[n:].reshape(-1), 0
        for x in self._dense():
            x[...] = flat[at:at + x.size].reshape(x.shape)
            at += x.size
        self.net.out_bias = float(self.params[-1][0])

    def learn(self, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rate: float) -> np.ndarray:
        """One step of Adam on the logistic loss; returns the rows changed.
        Through max pooling, only the windows that hold a maximum get a gradient."""
        net = self.net
        widths, per = net.widths, net.filters[0].shape[2]
        raw, spot, words = peaks(net, texts)
        act = np.maximum(raw, 0)
        err = ((sigmoid(act @ net.out + net.out_bias) - y) * weight / len(y)).astype(np.float32)
        back = err[:, None] * net.out * (raw > 0)
        grads = [np.zeros_like(w) for w in net.filters]
        rows, row_grads = [], []
        for f, width in enumerate(widths):
            own = slice(f * per, (f + 1) * per)
            for j in range(width):
                at = words[spot[:, own] + j]
                grads[f][j] = np.einsum("bfd,bf->df", net.embed[at], back[:, own])
                rows.append(at.reshape(-1))
                row_grads.append((back[:, own, None] * net.filters[f][j].T).reshape(-1, net.embed.shape[1]))
        grads += [back[:, f * per:(f + 1) * per].sum(axis=0) for f in range(len(widths))]
        grads += [act.T @ err, err.sum(keepdims=True)]
        self.step += 1
        for p, g, (m, v) in zip(self.params, grads, self.moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.999 ** self.step)) + 1e-8)
        net.out_bias = float(self.params[-1][0])
        rows, row_grads = np.concatenate(rows), np.concatenate(row_grads)
        used = (row_grads != 0).any(axis=1) & (rows != len(net.embed) - 1)
        rows, row_grads = rows[used], row_grads[used]
        order = rows.argsort(kind="stable")
        touched, first = np.unique(rows[order], return_index=True)
        if len(touched):
            total = np.add.reduceat(row_grads[order], first, axis=0)
            self.row_scale[touched] += (total ** 2).mean(axis=1)
            net.embed[touched] -= 5 * rate * total / (np.sqrt(self.row_scale[touched])[:, None] + 1e-8)
        return touched


def best_threshold(score: np.ndarray, toxic: np.ndarray, rows: np.ndarray) -> float:
    """The cut with the best F1 between distinct scores, of which ``rows`` rows,
    ``toxic`` of them toxic, have each; midway between two neighbouring scores."""
    order = np.argsort(-score, kind="stable")
    hit, said = np.cumsum(toxic[order]), np.cumsum(rows[order])
    f1 = 2 * hit / (said + toxic.sum())
    k = int(f1.argmax())
    here = score[order[k]]
    below = score[order[k + 1]] if k + 1 < len(order) else here - 1
    return float((here + below) / 2)


def sample(docs: DataFrame, labels: DataFrame, bits: int, max_per_class: int, max_chars: int):
    """Hashed words, label and language of a bounded sample, and the share of
    each class among all labelled rows: for a look at the data, ``train`` takes
    all rows."""
    drawn = (labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic")))
    share = {r["toxic"]: r["count"] for r in drawn.groupBy("toxic").count().collect()}
    order = F.xxhash64("doc_id", F.lit("toxicity"))
    # only labels with a document use up the quota; an id's rows stay together
    sizes = docs.where("doc_id is not null").groupBy("doc_id").agg(
        F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("n"))
    sized = cut_lineage(drawn.join(sizes, "doc_id").where(F.col("n") <= max_chars))
    picked = None
    for y in (0, 1):  # at most max_per_class ids of each
        one = sized.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(max_per_class)
        picked = one if picked is None else picked.unionByName(one)
    picked = picked.select("doc_id", "toxic", "n", order.alias("o")).toPandas().sort_values(["o", "doc_id"])
    if not len(picked):
        return [], np.zeros(0), [], share
    ids = docs.sparkSession.createDataFrame(picked[["doc_id", "toxic"]], "doc_id long, toxic int")
    rows = docs.join(F.broadcast(ids), "doc_id")
    # each class first gets up to half of the characters, then the rest goes in
    # the same order to what was left; an id that does not fit is left out alone
    kept, used, left = [], {0: 0, 1: 0}, []
    for row in zip(picked["doc_id"].tolist(), picked["toxic"].tolist(), picked["n"].tolist()):
        fit_now = used[row[1]] + row[2] <= max_chars // 2
        (kept if fit_now else left).append(row)
        used[row[1]] += row[2] * fit_now
    for row in left:
        if sum(used.values()) + row[2] <= max_chars:
            kept.append(row)
            used[row[1]] += row[2]
    fits = docs.sparkSession.createDataFrame([(row[0],) for row in kept], "doc_id long")

    def hashed(part: pa.RecordBatch) -> pa.RecordBatch:
        own, counts = word_ids(texts_of(part), bits)
        cuts = np.split(own, np.cumsum(counts)[:-1])
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(2), part.column(3), pa.array([c.tobytes() for c in cuts], pa.binary())],
            names=["doc_id", "toxic", "lang", "ids"])

    got = map_slices(rows.join(F.broadcast(fits), "doc_id").select("doc_id", "text", "toxic", "lang"), hashed,
                     "doc_id long, toxic int, lang string, ids binary").toPandas()
    got = got.sort_values("doc_id", kind="stable")
    return ([np.frombuffer(b, np.int32) for b in got["ids"]], got["toxic"].to_numpy(dtype=np.int64),
            got["lang"].tolist(), share)


def opened(ids: bytes) -> np.ndarray:
    return np.frombuffer(decompress(ids), np.int32)


def labelled_rows(docs: DataFrame, labels: DataFrame, bits: int, shard_rows: int) -> DataFrame:
    """``shard, held, toxic, lang, ids``: the hashed words of every row
    that has a label, written once, a shard in one partition; ``held`` rows
    are for the thresholds."""
    known = (labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("toxic")))
    count = known.count()
    shards = max(1, -(-count // shard_rows))
    # a bitmap of the labelled ids' hashes, of bounded size, spares most other
    # rows the way to the join, which decides
    room = min(1 << 27, max(1 << 15, 1 << (16 * count).bit_length()))
    place = F.pmod(F.xxhash64("doc_id", F.lit("label")), F.lit(room)) + 1
    maps = known.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    bits_set = np.zeros(room // 8, np.uint8)
    for r in maps:
        bits_set[(r["k"] - 1) * 4096:r["k"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bits_set)

    def hashed(part: pa.RecordBatch) -> pa.RecordBatch:
        at = part.column(3).to_numpy() - 1
        part = part.filter(pa.array(shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1))
        own, counts = word_ids(texts_of(part), bits)
        cuts = np.split(own, np.cumsum(counts)[:-1])[:part.num_rows]
        return pa.RecordBatch.from_arrays(
            [part.column(0), part.column(2), pa.array([compress(c.tobytes(), 1) for c in cuts], pa.binary())],
            names=["doc_id", "lang", "ids"])

    words = map_slices(docs.where("doc_id is not null").select("doc_id", "text", "lang", place.alias("p")), hashed,
                       "doc_id long, lang string, ids binary")
    # one shuffle brings an id's label before its rows, a shard to one task
    tasks = min(shards, 100_000)
    turn = F.xxhash64("doc_id", F.lit("toxicity"))
    both = words.unionByName(known, allowMissingColumns=True).select(
        F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).cast("int").alias("shard"), "doc_id", "toxic",
        (F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(4)) == 3).alias("held"), "lang", "ids")
    dealt = both.repartitionById(tasks, (F.col("shard") % tasks).cast("int")).sortWithinPartitions(
        "shard", turn, "doc_id", F.col("toxic").isNull(), "lang", "ids")

    def labelled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, label = None, None
        for part in batches:
            labels_here, keep = [], []
            for doc_id, toxic in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                if toxic is not None:
                    last, label = doc_id, toxic
                keep.append(toxic is None and doc_id == last)
                labels_here.append(label)
            out = pa.RecordBatch.from_arrays(
                [part.column(0), part.column(3), pa.array(labels_here, pa.int32()), part.column(4), part.column(5)],
                names=["shard", "held", "toxic", "lang", "ids"])
            yield out.filter(pa.array(keep, pa.bool_()))

    written = cut_lineage(dealt.mapInArrow(labelled, "shard int, held boolean, toxic int, lang string, ids binary"))
    shared.destroy()
    return written


def frequent_buckets(rows: DataFrame, least_texts: int) -> np.ndarray:
    """Buckets whose words are in at least ``least_texts`` texts, in order."""

    def seen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [np.unique(opened(b)) for b in batch.column(0).to_pylist()]
            bucket, texts = np.unique(np.concatenate([np.zeros(0, np.int32), *each]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(texts)], names=["bucket", "texts"])

    counted = rows.select("ids").mapInArrow(seen, "bucket int, texts long").groupBy("bucket").agg(
        F.sum("texts").alias("texts")).where(F.col("texts") >= least_texts)
    return np.sort(counted.select("bucket").toPandas()["bucket"].to_numpy(dtype=np.int64))


def planes(values: np.ndarray) -> bytes:
    """The values' first bytes, then their second ones and so on, compressed:
    those that hold signs and exponents are much alike."""
    return compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def from_planes(data: bytes, kind) -> np.ndarray:
    parts = np.frombuffer(decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(parts.T).view(kind).reshape(-1)


def one_round(rows: DataFrame, plan, words: int, state: np.ndarray, balance: tuple[float, float], number: int,
              batch: int, rate: float) -> np.ndarray:
    """The state after every shard went through its rows once from ``state``:
    each row of it by the mean change, weighted by the steps that changed it.
    ``plan`` is the broadcast network without its ``words`` rows, whose other
    values do not count. Changes of words, and their values in the copy sent to
    the shards, are half floats. No function that is sent holds ``state``: Spark
    would keep each round's copy of it on every executor's disk."""
    wide = state.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast((state[:words].astype(np.float16), state[words:]))

    def whole() -> np.ndarray:
        return np.concatenate([shared.value[0].astype(np.float32), shared.value[1]])

    def kind(changed: np.ndarray):
        return np.float16 if changed[0] < words else np.float32

    def changes(shard: int, trainer: Trainer, steps: np.ndarray) -> Iterator[pa.RecordBatch]:
        steps[words:] = trainer.step[0] - steps[words:]
        changed = np.flatnonzero(steps)
        delta = trainer.state()[changed] - whole()[changed]
        cuts = np.flatnonzero(np.diff(changed // BLOCK_ROWS) | np.diff(changed >= words)) + 1
        groups = list(zip(np.split(changed, cuts), np.split(delta, cuts)))
        if len(changed):
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(r[0]) // BLOCK_ROWS for r, _ in groups], pa.int32()),
                 pa.array([shard] * len(groups), pa.int32()),
                 pa.array([planes(r.astype(np.int32)) for r, _ in groups], pa.binary()),
                 pa.array([planes(steps[r].astype(np.float32)) for r, _ in groups], pa.binary()),
                 pa.array([planes(d.astype(kind(r))) for r, d in groups], pa.binary())],
                names=["block", "shard", "rows", "steps", "delta"])

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import copy

        shard, trainer, steps = None, None, None
        for part in batches:
            owner = part.column(0).to_numpy()
            ids, toxic = part.column(2), part.column(1).to_numpy().astype(np.float64)
            for own in np.split(np.arange(part.num_rows), np.flatnonzero(np.diff(owner)) + 1):
                if not len(own):
                    continue
                if owner[own[0]] != shard:
                    if trainer is not None:
                        yield from changes(shard, trainer, steps)
                    shard = int(owner[own[0]])
                    trainer = Trainer(replace(copy.deepcopy(plan.value), embed=np.zeros((words, wide - 1), np.float32)))
                    trainer.load(whole())
                    steps = np.zeros(sum(map(len, shared.value)))
                    steps[words:] = trainer.step[0]
                own = np.random.default_rng((number, shard)).permutation(own)
                for at in range(0, len(own), batch):
                    pick = own[at:at + batch]
                    texts = [opened(ids[int(k)].as_buffer()) for k in pick]
                    steps[trainer.learn(texts, toxic[pick], np.where(toxic[pick] == 1, *balance), rate)] += 1
        if trainer is not None:
            yield from changes(shard, trainer, steps)

    def mean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums a block's rows as they come, in the order of the shards."""
        block, total = None, None

        def done() -> pa.RecordBatch:
            got = np.flatnonzero(total[:, -1])
            return pa.RecordBatch.from_arrays(
                [pa.array([(got + block * BLOCK_ROWS).astype(np.int32).tobytes()], pa.binary()),
                 pa.array([(total[got, :-1] / total[got, -1:]).astype(np.float32).tobytes()], pa.binary())],
                names=["rows", "delta"])

        for part in batches:
            for one in part.to_pylist():
                if one["block"] != block:
                    if block is not None:
                        yield done()
                    block, total = one["block"], np.zeros((BLOCK_ROWS, wide + 1))
                changed = from_planes(one["rows"], np.int32)
                at = changed - block * BLOCK_ROWS
                weight = from_planes(one["steps"], np.float32).astype(np.float64)[:, None]
                total[at, :-1] += weight * from_planes(one["delta"], kind(changed)).reshape(-1, wide)
                total[at, -1:] += weight
        if block is not None:
            yield done()

    sent = rows.select("shard", "toxic", "ids").mapInArrow(
        learn, "block int, shard int, rows binary, steps binary, delta binary")
    means = sent.repartition("block").sortWithinPartitions("block", "shard").mapInArrow(
        mean, "rows binary, delta binary").collect()
    after = state.copy()
    for r in means:
        after[np.frombuffer(r["rows"], np.int32)] += np.frombuffer(r["delta"], np.float32).reshape(-1, wide)
    shared.destroy()
    return after


def counted_scores(rows: DataFrame, net: Network) -> DataFrame:
    """``lang, bin, toxic, n``: rows and toxic ones by language and raw score,
    in steps of 1 / STEPS, written once."""
    shared = rows.sparkSession.sparkContext.broadcast(net)
    tables: list = []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = shared.value
            if not tables:
                tables.append(own.tables())
            ids = [opened(b) for b in batch.column(2).to_pylist()]
            sizes = np.array([len(t) for t in ids])
            # runs of texts of a bounded number of words; a longer text is one of its own
            ends, first, out = np.cumsum(sizes), 0, []
            while first < len(ids):
                base = ends[first - 1] if first else 0
                last = max(int(np.searchsorted(ends, base + (1 << 17), side="right")), first + 1)
                out.append(own.logits(own.maxima(np.concatenate(ids[first:last]), sizes[first:last], tables[0])))
                first = last
            bins = np.rint(np.clip(np.concatenate([np.zeros(0), *out]), -REACH, REACH) * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(bins), batch.column(0)],
                                             names=["lang", "bin", "toxic"])

    counts = cut_lineage(rows.select("toxic", "lang", "ids").mapInArrow(run, "lang string, bin int, toxic int")
                         .groupBy("lang", "bin").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n")))
    shared.destroy()
    return counts


def train(docs: DataFrame, labels: DataFrame, at: float = 0.3, bits: int = 20, rounds: int = 8,
          more_rounds: int = 3, batch: int = 64, rate: float = 0.01, least_texts: int = 4, shard_rows: int = 16384) -> Network | None:
    """Fit on all labelled rows of ``docs`` (``doc_id, text, lang``), weighed so
    that both classes count the same: ``rounds`` on the rows not held, then
    ``more_rounds`` on all. Only words of at least ``least_texts`` texts get a
    row, so that rare ones cannot be learned by heart."""
    rows = labelled_rows(docs, labels, bits, shard_rows)
    there = {(r["held"], r["toxic"]): r["count"] for r in rows.groupBy("held", "toxic").count().collect()}
    if len({toxic for _, toxic in there}) < 2:
        return None
    apart = len(there) == 4  # else one part has a single class: all rows serve both ends
    net = start(frequent_buckets(rows, least_texts), bits)
    trainer = Trainer(net)
    state = trainer.state()
    plan = docs.sparkSession.sparkContext.broadcast(replace(net, embed=net.embed[:0]))

    def learn(part: DataFrame, halves: tuple, numbers: range) -> None:
        nonlocal state
        clean, toxic = (sum(there.get((held, y), 0) for held in halves) for y in (0, 1))
        balance = (0.5 * (clean + toxic) / toxic, 0.5 * (clean + toxic) / clean)
        for number in numbers:
            state = one_round(part, plan, len(net.embed), state, balance, number, batch, rate)
        trainer.load(state)

    if apart:
        learn(rows.where("not held"), (False,), range(rounds))
    else:
        learn(rows, (False, True), range(rounds))
    counts = counted_scores(rows.where("held") if apart else rows, net)
    if apart:
        learn(rows, (False, True), range(rounds, rounds + more_rounds))
    plan.destroy()
    whole = counts.groupBy("bin").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n")).toPandas().sort_values("bin")

    def cut(pdf: pd.DataFrame) -> float:
        pdf = pdf.sort_values("bin")
        return best_threshold(pdf["bin"].to_numpy() / STEPS, pdf["toxic"].to_numpy(dtype=float),
                              pdf["n"].to_numpy(dtype=float))

    net.shift = float(np.log(at / (1 - at)) - cut(whole))
    net.threshold = at
    enough = counts.where("lang is not null").groupBy("lang").agg(F.sum("toxic").alias("t"), F.sum("n").alias("all")).where(
        "t >= 5 and all - t >= 5").select("lang")
    own = counts.join(enough, "lang").groupBy("lang").applyInPandas(
        lambda pdf: pd.DataFrame({"lang": pdf["lang"].iloc[:1], "cut": [cut(pdf)]}), "lang string, cut double")
    for r in sorted(own.collect()):
        net.by_lang[r["lang"]] = float(sigmoid(r["cut"] + net.shift))
    return net


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """``doc_id, score, flagged`` for every row of ``docs`` (``doc_id, text,
    lang``); ``flagged`` uses the language's threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    schema = "doc_id long, score double, flagged boolean"
    tables: list = []

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        net = shared.value
        if net is None:
            p = np.zeros(part.num_rows)
            cut = np.ones(part.num_rows)
        else:
            if not tables:
                tables.append(net.tables())
            ids, counts = word_ids(texts_of(part), net.bits)
            p = sigmoid(net.logits(net.maxima(ids, counts, tables[0])).astype(np.float64))
            cut = np.array([net.by_lang.get(x, net.threshold) for x in part.column(2).to_pylist()])
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(p), pa.array(p >= cut)],
                                          names=["doc_id", "score", "flagged"])

    return map_slices(docs.select("doc_id", "text", "lang"), run, schema, limit=1 << 20)
