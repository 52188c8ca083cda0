"""Quality rules by repetition coverage: how many characters of a text lie in
repeated word n-grams and lines.

A slice of texts becomes flat numpy arrays (``words.py``). A rolling hash over
the word numbers grows by one word per length (h_n[i] = h_(n-1)[i] * B +
x[i+n-1]), windows are sorted by hash, and windows with equal hashes are held
against each other word by word: on a collision the multiplier changes, so
counts are exact. A window marks its words, and a word counts once however many
windows cover it. Everything happens within one text: one map over the table,
no shuffle, memory bounded by a slice of texts or by one long text.

Measures per text, in code points of words:

- ``top_chars[n]`` for n = 2, 3, 4: characters in the occurrences of its most
  frequent n-gram (found twice or more; ties: more characters, then earlier);
- ``dup_chars[n]`` for n = 5 to 10: characters in n-grams that occurred before
  in the text (the first occurrence doesn't count);
- ``dup_line_chars``, ``n_dup_lines``: lines equal to an earlier line.

The verdict compares them with shares of the text's characters (and lines).

Defined results: a null or empty text has no words, zero everywhere, and fails
the base rule (fewer than ``min_words`` words). Repeated rows are judged each
for itself. Only ``doc_id`` and ``text`` are read; extra columns of the input
don't matter. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from zonelake.llm.common import map_slices
from zonelake.llm.words import byte_table, equal_runs, laid_out, owner, runs, strings

SEPARATORS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
TOP, DUP = (2, 3, 4), (5, 6, 7, 8, 9, 10)
#: Largest share, in percent, of a text's word characters (lines: of its lines
#: with a word). Published rules for web text; keys as in ``measures``.
LIMITS = {"top_2": 20, "top_3": 18, "top_4": 16, "dup_5": 15, "dup_6": 14, "dup_7": 13, "dup_8": 12,
          "dup_9": 11, "dup_10": 10, "dup_line_chars": 20, "n_dup_lines": 30}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "dup_line_chars", "n_repeat_words",
          *(f"top_{n}" for n in TOP), *(f"dup_{n}" for n in DUP)]
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)


class Words:
    """The words of a slice: exact numbers, owners and characters."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        self.n_texts = len(starts) - 1
        inside = ~byte_table(SEPARATORS)[data]
        first, end = runs(inside)
        self.text = owner(first, starts)
        self.number = strings(data, first, end, inside).indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # code points: every byte of a word but UTF-8's continuation bytes
        self.points = (inside & (data & 0xC0 != 0x80)).view(np.uint8)
        self.chars = self.between(first)

    def __len__(self) -> int:
        return len(self.number)

    def between(self, first: np.ndarray) -> np.ndarray:
        """Code points of words from each position to the next one given."""
        return np.add.reduceat(self.points, first, dtype=np.int64) if len(first) else np.zeros(0, np.int64)

    def total(self, values: np.ndarray, text: np.ndarray | None = None) -> np.ndarray:
        """Sums of whole numbers per text."""
        return np.bincount(self.text if text is None else text, values, self.n_texts).astype(np.int64)

    def covered(self, at: np.ndarray, n: int) -> np.ndarray:
        """Words that lie in a window of ``n`` words starting at ``at``."""
        step = np.zeros(len(self) + 1, dtype=np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + n, -1)
        return np.cumsum(step[:-1]) > 0


def rolling(words: Words, longest: int, base: int):
    """(n, starts, equal runs) for n = 2 to ``longest``: the windows of n words
    of one text each, grouped by equal words."""
    multiplier = np.uint64(base | 1)
    x = (words.number.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    salt = (words.text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    h = x
    for n in range(2, longest + 1):
        if len(words) < n:
            return
        h = h[:len(words) - n + 1] * multiplier + x[n - 1:]
        starts = np.flatnonzero(words.text[n - 1:] == words.text[:len(h)])
        key = h[starts] ^ salt[starts]
        key = (key ^ key >> np.uint64(32)) * multiplier

        def same(i, j):
            a, b = starts[i], starts[j]
            ok = words.text[a] == words.text[b]
            for k in range(n):
                ok &= words.number[a + k] == words.number[b + k]
            return ok

        yield n, starts, equal_runs(key, same)


def gram_measures(words: Words) -> dict[str, np.ndarray]:
    """Coverage by repeated n-grams, per text."""
    for base in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x9FB21C651E98DF25):
        out = {f"top_{n}": np.zeros(words.n_texts, np.int64) for n in TOP}
        out |= {f"dup_{n}": np.zeros(words.n_texts, np.int64) for n in DUP}
        out["n_repeat_words"] = np.zeros(words.n_texts, np.int64)
        for n, starts, found in rolling(words, max(DUP), base):
            if found is None:
                break
            order, run = found
            count = np.bincount(run)
            first = starts[order[np.cumsum(count) - count]]
            often = count[run] > 1
            if n == 3:
                out["n_repeat_words"] = words.total(words.covered(starts[order[often]], n))
            if n in TOP:
                many = np.flatnonzero(count > 1)
                text, at = words.text[first[many]], first[many]
                chars = sum(words.chars[at + k] for k in range(n))
                best = many[np.lexsort((at, -chars, -count[many], text))]
                text = words.text[first[best]]
                top = np.zeros(len(count), dtype=bool)
                top[best[np.diff(text, prepend=-1) != 0]] = True
                hit = words.covered(starts[order[top[run]]], n)
                out[f"top_{n}"] = words.total(words.chars * hit)
            if n in DUP:
                later = often & (order != order[(np.cumsum(count) - count)[run]])
                out[f"dup_{n}"] = words.total(words.chars * words.covered(starts[order[later]], n))
        else:
            return out
    raise RuntimeError("four multipliers collided on one slice")


def line_measures(data: np.ndarray, starts: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    """Lines with a word, and those equal to an earlier line of their text."""
    breaks = np.flatnonzero(data == 10)
    first = np.concatenate([[0], breaks[:-1] + 1]) if len(breaks) else breaks
    chars = words.between(first)
    number = strings(data, first, breaks, data != 10).indices.to_numpy(zero_copy_only=False).astype(np.int64)
    full = np.flatnonzero(chars > 0)
    text, number, chars = owner(first[full], starts), number[full], chars[full]
    order = np.lexsort((number, text))
    again = np.zeros(len(order), dtype=bool)
    again[order[1:]] = ((number[order[1:]] == number[order[:-1]]) & (text[order[1:]] == text[order[:-1]]))
    return {"n_lines": words.total(np.ones(len(text)), text), "n_dup_lines": words.total(again, text),
            "dup_line_chars": words.total(chars * again, text)}


def measures(column: pa.Array) -> dict[str, np.ndarray]:
    """All counts of ``COUNTS`` for the texts of a column."""
    data, starts = laid_out(column)
    words = Words(data, starts)
    marks = np.flatnonzero(byte_table(SYMBOLS)[data])
    out = {"n_words": words.total(np.ones(len(words))), "word_chars": words.total(words.chars),
           "n_symbols": words.total(np.ones(len(marks)), owner(marks, starts))}
    return out | line_measures(data, starts, words) | gram_measures(words)


def judge(docs: DataFrame, min_words: int = 50, max_repeat_words: int = 50,
          limits: Mapping[str, int] = LIMITS) -> DataFrame:
    """Every document's counts, ``base_failed`` (fewer than ``min_words``
    words, or over ``max_repeat_words`` percent of them in 3-word windows found
    twice or more), ``failed_rules`` (names of ``limits`` that it exceeds) and
    ``kept``."""
    whole = {"n_dup_lines": "n_lines"}

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        m = measures(part.column(1))
        base = (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > max_repeat_words * m["n_words"])
        over = {k: 100 * m[k] > limit * m[whole.get(k, "word_chars")] for k, limit in limits.items()}
        failed = [[k for k in over if over[k][i]] for i in range(part.num_rows)]
        kept = ~base & (np.fromiter(map(len, failed), np.int64, len(failed)) == 0)
        return pa.RecordBatch.from_arrays(
            [part.column(0), *(pa.array(m[c]) for c in COUNTS), pa.array(base),
             pa.array(failed, pa.list_(pa.string())), pa.array(kept)],
            names=["doc_id", *COUNTS, "base_failed", "failed_rules", "kept"])

    return map_slices(docs.select("doc_id", "text"), run,
                      SCHEMA + ", base_failed boolean, failed_rules array<string>, kept boolean")
