"""Words of a batch of texts as flat arrays.

The texts of a slice are laid out as one byte array with a newline after each,
words are runs of bytes outside a table of separators, and every word gets the
number of its exact byte string (Arrow's dictionary), so equal numbers are
equal words. Separators are ASCII, so bytes and characters agree about them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def byte_table(members: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(members)] = True
    return out


def lowered() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


LOWER = lowered()


def laid_out(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, each text followed by a newline, and the texts'
    starts with the end appended. Null counts as empty."""
    texts = column.cast(pa.large_string()).cast(pa.large_binary()).fill_null(b"").to_pylist()
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1, out=starts[1:])
    return np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)[:starts[-1]], starts


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    padded = np.zeros(len(inside) + 2, dtype=np.int8)
    padded[1:-1] = inside
    steps = np.diff(padded)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, inside: np.ndarray) -> pa.DictionaryArray:
    """The byte strings ``data[starts:ends]``, numbered exactly. ``inside``
    marks the bytes that belong to any of them."""
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    flat = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return flat.dictionary_encode()


def owner(position: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Number of the text that each byte position belongs to."""
    return np.searchsorted(starts, position, side="right") - 1


def equal_runs(keys: np.ndarray, same) -> tuple[np.ndarray, np.ndarray] | None:
    """Order of ``keys`` (equal keys by position) and the number of the run of
    equal keys at each place of that order; None if ``same(i, j)`` denies that
    two neighbours of one run are equal (a hash collision)."""
    order = np.argsort(keys, kind="stable")
    fresh = np.ones(len(order), dtype=bool)
    np.not_equal(keys[order[1:]], keys[order[:-1]], out=fresh[1:])
    again = np.flatnonzero(~fresh)
    if not same(order[again], order[again - 1]).all():
        return None
    return order, np.cumsum(fresh) - 1
