"""Request and response between blocks of documents and hash partitions.

Operators that compare every position of a corpus (n-grams, substrings) would
send one row per position through a shuffle. Here a block of documents sends
one row per hash partition: its distinct keys as a sorted, compressed array.
The partition answers with an array in the same order. A block is a run of
rows of one input task with a bounded number of bytes; its texts are written
once to the shared folder, so that later steps see the same blocks again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from zonelake.llm.common import text_slices

#: Rows between steps: what they are, for which block or partition, arrays
#: as bytes, and numbers that Spark sums.
ROWS = ("kind string, block string, part int, a binary, b binary, c binary, d binary, e binary, "
        "n array<double>")
ARROW_ROWS = pa.schema([("kind", pa.string()), ("block", pa.string()), ("part", pa.int32()),
                        *((k, pa.binary()) for k in "abcde"), ("n", pa.list_(pa.float64()))])


def row(kind: str, block: str, part: int = -1, n: list[float] | None = None, **arrays: bytes) -> dict[str, list]:
    return {"kind": [kind], "block": [block], "part": [part], "n": [n], **{k: [arrays.get(k)] for k in "abcde"}}


def row_batch(*args, **kw) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(row(*args, **kw), schema=ARROW_ROWS)


MIX = np.uint64(0x9E3779B97F4A7C15)


def squeeze(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(a).tobytes())


def unsqueeze(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=dtype)


def squeeze_sorted(a: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit keys as compressed differences; the eight bytes
    of each difference are laid out plane by plane, so high zeros vanish."""
    return squeeze_planes(np.diff(a, prepend=np.uint64(0)))


def unsqueeze_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze_planes(b), dtype=np.uint64)


def squeeze_planes(a: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers, compressed byte plane by byte plane."""
    return squeeze(a.astype("<u8").view(np.uint8).reshape(-1, 8).T)


def unsqueeze_planes(b: bytes) -> np.ndarray:
    planes = unsqueeze(b, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * MIX
    return x ^ x >> np.uint64(29)


def partition_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mixed(keys) >> np.uint64(20)).astype(np.int64) % parts


def blocks(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Runs of rows with about ``limit`` bytes of text, across the Arrow
    batches of a task, each with a fresh name."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in text_slices(batch, limit=max(limit // 4, 1)):
            held.append(part)
            size += part.nbytes
            if size >= limit:
                yield uuid.uuid4().hex, joined(held)
                held, size = [], 0
    if held:
        yield uuid.uuid4().hex, joined(held)


def mapped(df: DataFrame, fn: Callable[[dict], Iterator[dict[str, list]]]) -> DataFrame:
    """``fn`` on each row (a dict) of ``df``, giving rows of ROWS."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = {n: batch.column(i)[k].as_py() for i, n in enumerate(batch.schema.names)}
                for out in fn(one):
                    yield pa.RecordBatch.from_pydict(out, schema=ARROW_ROWS)

    return df.mapInArrow(run, ROWS)


def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def grouped(df: DataFrame, key: str, parts: int, fn: Callable[[dict[str, list]], Iterator[dict[str, list]]],
            schema: str) -> DataFrame:
    """``fn`` on the rows of each value of ``key`` (a dict of column lists).
    Rows stream from a sorted partition, one value's rows at a time."""
    names = df.columns
    arrow = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {n: [] for n in names}

        def emit(rows):
            for out in fn(rows):
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(i)[k].as_py() for i, n in enumerate(names)}
                if held[key] and row[key] != held[key][0]:
                    yield from emit(held)
                    held = {n: [] for n in names}
                for n in names:
                    held[n].append(row[n])
        if held[key]:
            yield from emit(held)

    return df.repartition(parts, key).sortWithinPartitions(key).mapInArrow(run, schema)
