"""Helpers shared by the training-data operators.

Texts reach Python as Arrow batches. ``text_slices`` cuts a batch into runs of
rows whose text stays below a byte bound, so the numpy arrays of an operator
are sized by that bound (or by one text) and not by the batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.session import ensure_checkpoint_dir

SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo ``n``; null stays null."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def held_out(column: str, n: int, remainder: int) -> Column:
    """True where crc32(column as text) mod ``n`` is ``remainder``. A null id
    has no remainder and counts as not held out."""
    return F.coalesce(crc_mod(column, n) == remainder, F.lit(False))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder; later stages reread it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write as Parquet below the shared checkpoint folder and reread it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, columns: Iterable[str]) -> str:
    """``name``, or a longer one that none of ``columns`` has (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def tasks_for(spark: SparkSession) -> int:
    """Partitions for an exchange keyed by a hash: the session's setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_slices(batch: pa.RecordBatch, column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``limit`` bytes of text; a longer text is a
    run of its own."""
    if batch.num_rows == 0:
        return
    col = batch.column(batch.schema.get_field_index(column))
    sizes = pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        base = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, base + limit, side="right")), first + 1)
        yield batch.slice(first, last - first)
        first = last


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts as Python strings, null as the empty string."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def map_slices(df: DataFrame, fn, schema: str, column: str = "text",
               limit: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` where ``fn`` gets one slice and returns a RecordBatch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, column, limit):
                yield fn(part)

    return df.mapInArrow(run, schema)


def sums_by(values: np.ndarray, starts: np.ndarray, counts: np.ndarray,
            ufunc=np.add, empty=0, dtype=None) -> np.ndarray:
    """``ufunc.reduceat`` over runs that may be empty."""
    shape = (len(starts), *values.shape[1:])
    out = np.full(shape, empty, dtype=dtype or values.dtype)
    full = np.flatnonzero(counts)
    if len(full):
        out[full] = ufunc.reduceat(values, starts[full], axis=0, dtype=dtype)
    return out
