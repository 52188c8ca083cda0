"""Language identification: multinomial naive Bayes over hashed character
n-grams.

``train`` counts hashed 2- and 3-grams of letters per language over all
training rows on Spark (partial counts per task, one grouped sum) and writes the matrix
(languages x buckets). ``predict`` sends the log-probability matrix with the
tasks, a bounded block of languages at a time, and scores each text as the sum
of its n-grams' rows, i.e. sparse counts times matrix, in numpy.

Defined results: a null text, or one without a letter, is ``und`` with score
0; with no training rows everything is ``und``; equal scores go to the
language that sorts first. Only ``doc_id`` and ``text`` are read by
``predict``, so further columns cannot clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.llm.common import fresh, shared_table, sums_by, text_slices, texts_of

UNKNOWN = "und"
_FOLD: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Code point -> lower-case letter, or a space for anything else."""
    if not _FOLD:
        table = np.full(0x110000, 32, dtype=np.uint32)
        for cp in range(0x110000):
            ch = chr(cp)
            if ch.isalpha():
                low = ch.lower()
                table[cp] = ord(low) if len(low) == 1 else cp
        _FOLD.append(table)
    return _FOLD[0]


def gram_ids(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-gram ids of all texts in one array, with each text's start,
    length and whether it has a letter. Texts are set off by two spaces and
    n-grams that begin with two spaces get the neutral id, so none crosses."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    blob = ("  ".join(["", *texts, " "])).encode("utf-32-le", "surrogatepass")
    c = fold_table()[np.frombuffer(blob, dtype=np.uint32)]
    ends = np.cumsum(lengths + 2)
    starts = ends - lengths - 1  # the space before the text belongs to it
    n = len(c) - 2
    c0, c1, c2 = c[:n], c[1:n + 1], c[2:n + 2]
    shift = np.uint32(32 - bits)
    two = c0 * np.uint32(0x9E3779B1) ^ c1 * np.uint32(0x85EBCA6B)
    three = (two ^ c2 * np.uint32(0xC2B2AE35)) * np.uint32(0x27D4EB2F)
    two = (two * np.uint32(0x165667B1)) >> shift
    three = (three >> shift) + np.uint32(1 << bits)
    neutral = (c0 == 32) & (c1 == 32)
    two[neutral] = three[neutral] = 2 << bits
    letters = sums_by((c0 != 32).astype(np.int32), np.minimum(starts, n - 1), lengths + 1)
    return np.stack([two, three]), starts, lengths + 1, letters > 0


@dataclass
class Languages:
    """A block of languages: what goes with the tasks."""

    names: list[str]
    log_prob: np.ndarray  # languages x (2 * buckets + 1), neutral id last
    log_prior: np.ndarray
    bits: int

    def weigh(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each text its best language's place and log probability, the sum
        of all probabilities relative to it, and whether it has a letter."""
        ids, starts, counts, letters = gram_ids(texts, self.bits)
        both = np.empty((len(texts), len(self.names)))
        for k, row in enumerate(self.log_prob):
            per_place = row[ids[0]] + row[ids[1]]
            both[:, k] = sums_by(per_place, starts, counts, dtype=np.float64)
        both += self.log_prior
        best = both.argmax(axis=1)
        top = both[np.arange(len(texts)), best]
        return best, top, np.exp(both - top[:, None]).sum(axis=1), letters


@dataclass
class Model:
    rows: DataFrame  # written: lang, n, log_prob (bytes)
    total: int  # training texts
    starts: list[str]  # first language of each block
    bits: int

    def block(self, k: int) -> Languages:
        own = F.col("lang") >= self.starts[k]
        if k + 1 < len(self.starts):
            own &= F.col("lang") < self.starts[k + 1]
        got = sorted(self.rows.where(own).collect(), key=lambda r: r["lang"].encode())
        width = (2 << self.bits) + 1
        return Languages([r["lang"] for r in got],
                         np.stack([np.frombuffer(r["log_prob"], np.float32) for r in got]).reshape(-1, width),
                         np.log(np.array([r["n"] for r in got], dtype=float) / max(self.total, 1)), self.bits)


def train(docs: DataFrame, bits: int = 16, smoothing: float = 0.1, block_languages: int = 128) -> Model:
    """Fit on all rows of ``docs`` (``text``, ``lang``) with a language and a
    text. The matrix is written with a row per language and used in blocks of
    ``block_languages`` rows, so any number of distinct values will do."""
    size = 2 << bits

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, own in total.items():
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(own[at])],
                    names=["lang", "id", "n"])
            total.clear()

        for batch in batches:
            for part in text_slices(batch):
                langs, texts = part.column(1).to_pylist(), texts_of(part)
                every = sorted(set(langs))
                for at in range(0, len(every), block_languages):
                    names = every[at:at + block_languages]
                    code = {x: k for k, x in enumerate(names)}
                    mine = [k for k, x in enumerate(langs) if x in code]
                    ids, starts, counts, _ = gram_ids([texts[k] for k in mine], bits)
                    owner = np.repeat([code[langs[k]] * (size + 1) for k in mine], counts + 1)
                    inner = slice(1, 1 + len(owner))
                    n = sum(np.bincount(owner + row[inner], minlength=len(names) * (size + 1)) for row in ids)
                    seen = Counter(langs[k] for k in mine)
                    if len(total) + len(names) > 2 * block_languages:
                        yield from sent()
                    for x, own in zip(names, n.reshape(len(names), size + 1)):
                        kept = total.setdefault(x, np.zeros(size + 2, dtype=np.int64))
                        kept[:size] += own[:size]
                        kept[size + 1] += seen[x]
        yield from sent()

    def matrix_row(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros(size + 2)
        counts[pdf["id"].to_numpy()] = pdf["n"].to_numpy()
        log_prob = np.zeros(size + 1, dtype=np.float32)
        grams = counts[:size] + smoothing
        log_prob[:size] = np.log(grams / grams.sum())
        return pd.DataFrame({"lang": [key[0]], "n": [int(counts[size + 1])], "log_prob": [log_prob.tobytes()]})

    counted = (docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
               .select("text", "lang").mapInArrow(count, "lang string, id int, n long")
               .groupBy("lang", "id").agg(F.sum("n").alias("n")))
    # a language has at most 2 * buckets + 1 rows here
    rows = shared_table(counted.groupBy("lang").applyInPandas(matrix_row, "lang string, n long, log_prob binary"), "languages")
    starts, total = [], 0
    for k, r in enumerate(rows.select("lang", "n").orderBy("lang").toLocalIterator()):
        total += r["n"]
        if k % block_languages == 0:
            starts.append(r["lang"])
    return Model(rows, total, starts, bits)


def scored(docs: DataFrame, model: Model, kept: list[str]) -> tuple[DataFrame, str, str]:
    """The columns ``kept`` of every row, its language and score, and the names
    of these two columns. Texts pass one block of languages after another and
    carry the best so far, written between blocks."""
    best, top, mass = (fresh(x, docs.columns) for x in ("best_language", "best_log", "best_mass"))
    state = docs.withColumns({best: F.lit(None).cast("string"), top: F.lit(float("-inf")), mass: F.lit(0.0)})
    added = [best, top, mass]

    def step(state: DataFrame, languages: Languages, columns: list[str]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(languages)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in text_slices(batch):
                    old = [part.column(part.schema.get_field_index(x)) for x in added]
                    k, log, total, letters = shared.value.weigh(texts_of(part))
                    old_log, old_total = (x.to_numpy(zero_copy_only=False) for x in old[1:])
                    new_log = np.maximum(old_log, log)
                    new_total = old_total * np.exp(old_log - new_log) + total * np.exp(log - new_log)
                    name = [(shared.value.names[i] if better else was) if ok else None for i, better, was, ok in
                            zip(k.tolist(), (log > old_log).tolist(), old[0].to_pylist(), letters.tolist())]
                    out = dict(zip(added, (pa.array(name, pa.string()), pa.array(new_log), pa.array(new_total))))
                    yield pa.RecordBatch.from_arrays(
                        [out[x] if x in out else part.column(part.schema.get_field_index(x)) for x in columns], names=columns)

        return state.mapInArrow(run, T.StructType([state.schema[x] for x in columns]))

    for k in range(len(model.starts)):
        last = k + 1 == len(model.starts)
        state = step(state, model.block(k), [*(kept if last else docs.columns), *added])
        if not last:
            state = shared_table(state, "language-scores")
    score = F.when(F.col(best).isNull(), 0.0).otherwise(1.0 / F.col(mass))
    return state.withColumns({top: score, best: F.coalesce(F.col(best), F.lit(UNKNOWN))}).drop(mass), best, top


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row of ``docs``."""
    got, language, score = scored(docs.select("doc_id", "text"), model, ["doc_id"])
    return got.select("doc_id", F.col(language).alias("lang_pred"), F.col(score).alias("score"))


def keep_known(docs: DataFrame, model: Model, min_score: float = 0.5) -> DataFrame:
    """The rows whose language is recognised with at least ``min_score``, all
    columns unchanged."""
    got, language, score = scored(docs, model, docs.columns)
    return got.where((F.col(language) != UNKNOWN) & (F.col(score) >= min_score)).drop(language, score)
