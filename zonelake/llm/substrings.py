"""Exact removal of repeated substrings with two-stage suffix sorting.

A byte goes if a string of ``width`` bytes that covers it also starts earlier
(smaller ``doc_id``, or same document, earlier start). Strings are judged on
the input, overlaps count, and matches never cross documents.

1. Every window of ``width`` bytes gets the smallest hash of its 32-grams.
   Equal windows have equal minima, so windows are grouped by it; consecutive
   windows with one minimum form a run, whose bytes are a fragment.
2. Blocks of documents ask the hash partitions which minima occur more than
   once in the corpus; the answer is one bit per distinct minimum.
3. Only fragments of repeated minima leave their block, equal ones once (with
   the earliest place). A partition keeps the distinct fragments and sorts
   their suffixes: suffixes smaller than their successor are sorted directly,
   the others are induced by scanning the buckets of first bytes; adjacent
   common prefixes of ``width`` bytes or more make classes of equal windows,
   and each class's earliest place stays.
4. Blocks turn the answers into byte masks.

Texts are written once to the shared folder and joined by block name, so no
text crosses a shuffle by document; positions travel as compressed arrays. A
passage that a third of all documents share is one fragment per block.

Defined results: null text is empty; texts below ``width`` bytes lose nothing;
a null id sorts before all others; rows with the same id count as documents of
their own, in a fixed order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from zonelake.llm.blocks import (ROWS, blocks, grouped, mapped, partition_of, row, row_batch, squeeze, squeeze_planes,
                                 squeeze_sorted, unsqueeze, unsqueeze_planes, unsqueeze_sorted)
from zonelake.llm.common import shared_table, tasks_for, texts_of

GRAM = 32
SEPARATOR = 0xFF  # never part of UTF-8
_BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)


def sliding(ufunc, a: np.ndarray, span: int) -> np.ndarray:
    """``ufunc`` over each ``span`` values in a row, by doubling."""
    have = 1
    while have * 2 <= span:
        a = ufunc(a[:-have], a[have:])
        have *= 2
    rest = span - have
    return ufunc(a[:len(a) - rest], a[rest:]) if rest else a


def gram_hashes(data: np.ndarray) -> np.ndarray:
    h = _BYTES[data]
    for k, n in enumerate((1, 2, 4, 8, 16)):
        h = h[:-n] * np.uint64(0x9E3779B97F4A7C15 + 2 * k) + h[n:]
        h ^= h >> np.uint64(31)
    return h


def window_runs(data: np.ndarray, lengths: np.ndarray, width: int):
    """(first window, number of windows, minimum, document, self) of each run
    of windows with one minimum, the smallest hash of their 32-grams. ``self``
    tells that the gram may lie twice in a window or in neighbouring windows
    of a run, as in periodic text, so that a run can repeat within itself."""
    none = np.zeros(0, np.int64)
    if len(data) < width:
        return none, none, none.astype(np.uint64), none, none.astype(bool)
    ends, span = np.cumsum(lengths), width - GRAM + 1
    h = gram_hashes(data)
    v = sliding(np.minimum, h, span)
    doc = np.repeat(np.arange(len(lengths)), lengths)[:len(v)]
    good = np.arange(len(v)) + width <= ends[doc]
    # grams that are the minimum of a window, and those followed by the same one
    most = sliding(np.maximum, np.pad(np.where(good, v, 0), span - 1), span)
    lows = np.flatnonzero(h == most)
    twice = (h[lows[1:]] == h[lows[:-1]]) & (np.diff(lows) <= span)
    own = np.unique(h[lows[1:][twice]])
    fresh = np.ones(len(v), dtype=bool)
    fresh[1:] = (v[1:] != v[:-1]) | (doc[1:] != doc[:-1]) | ~good[:-1]
    first = np.flatnonzero(fresh & good)
    stop = np.flatnonzero(np.concatenate([(fresh | ~good)[1:], [True]]) & good) + 1
    # forty bits are enough to group by: more windows than must be may meet
    return first, stop - first, v[first] >> np.uint64(24), doc[first], np.isin(v[first], own)


def suffix_order(s: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` bytes."""
    n = len(s)
    step = np.sign(np.diff(s.astype(np.int16), append=-1))
    at = np.where(step != 0, np.arange(n), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]  # next place where the byte changes
    smaller = step[nearest] > 0  # than the suffix that follows it
    words = packed_words(s, depth)
    order = np.flatnonzero(smaller)
    # direct sort, eight bytes at a time, only within groups that still tie
    group = np.zeros(len(order), dtype=np.int64)
    live = np.arange(len(order))
    for skip in range(0, depth, 8):
        if not len(live):
            break
        key = words[order[live] + skip]
        by = np.lexsort((key, group[live]))
        order[live], key, own = order[live][by], key[by], group[live][by]
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (key[1:] != key[:-1])])
        group[live] = live[np.flatnonzero(new)[np.cumsum(new) - 1]]
        alone = new & np.concatenate([new[1:], [True]])
        live = live[~alone]
    # induce the rest: scan buckets by first byte, each in order
    sorted_small = np.split(order, np.searchsorted(s[order], np.arange(1, 256)))
    larger: list[list[np.ndarray]] = [[] for _ in range(256)]
    larger[s[n - 1]].append(np.array([n - 1]))

    def induce(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        if len(before):
            c = s[before]
            by = c.argsort(kind="stable")
            before, c = before[by], c[by]
            cuts = np.flatnonzero(np.diff(c)) + 1
            for piece, k in zip(np.split(before, cuts), c[np.concatenate([[0], cuts])]):
                larger[k].append(piece)

    out = []
    for c in range(256):
        k = 0
        while k < len(larger[c]):  # grows while it is scanned
            induce(larger[c][k])
            k += 1
        induce(sorted_small[c])
        out += [*larger[c], sorted_small[c]]
        larger[c] = []
    return np.concatenate(out)


def packed_words(s: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes at each place as one big-endian number; zeros follow."""
    padded = np.concatenate([s, np.zeros(depth + 16, np.uint8)])
    w = padded[:len(s) + depth + 8].astype(np.uint64)
    for k in range(1, 8):
        w <<= np.uint64(8)
        w |= padded[k:len(s) + depth + 8 + k]
    return w


def equal_windows(s: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The window ``starts`` in suffix order, and whether each has a common
    prefix of ``width`` bytes with the one before."""
    wanted = np.zeros(len(s), dtype=bool)
    wanted[starts] = True
    order = suffix_order(s, width)
    order = order[wanted[order]]
    words = packed_words(s, width)
    same = np.zeros(len(order), dtype=bool)
    live = np.arange(1, len(order))
    for skip in [*range(0, width - 8, 8), width - 8]:
        live = live[words[order[live] + skip] == words[order[live - 1] + skip]]
    same[live] = True
    return order, same


def earlier_elsewhere(fragments: list[bytes], place: np.ndarray, width: int) -> list[np.ndarray]:
    """Per fragment, for each of its windows, whether an equal window lies
    earlier. ``place`` orders the fragments' first windows: document rank
    times 2^32 plus start."""
    s = np.frombuffer(b"".join(f + b"\xff" for f in fragments), dtype=np.uint8)
    sizes = np.array([len(f) for f in fragments], dtype=np.int64)
    windows = sizes - width + 1
    begin = np.cumsum(sizes + 1) - sizes - 1
    nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = np.repeat(begin, windows) + nth
    rank = np.zeros(len(s), dtype=np.int64)
    rank[starts] = np.repeat(place, windows) + nth
    order, same = equal_windows(s, starts, width)
    classes = np.flatnonzero(~same)
    least = np.minimum.reduceat(rank[order], classes)
    repeated = np.zeros(len(s), dtype=bool)
    repeated[order] = rank[order] > np.repeat(least, np.diff(np.append(classes, len(order))))
    return [repeated[b:b + w] for b, w in zip(begin, windows)]


def repeated_spans(docs: DataFrame, width: int = 100, block_bytes: int = 4 << 20,
                   sort_bytes: int = 4 << 20) -> DataFrame:
    """``doc_id, n_bytes, n_removed, starts, ends, kept_sha256`` for every row
    of ``docs``: the maximal removed runs and the hash of what is left."""
    if width < GRAM + 1:
        raise ValueError(f"width must exceed {GRAM}")
    spark = docs.sparkSession
    parts = tasks_for(spark)

    def by_part(v, own):
        """Distinct minima, where each run's is, whether it occurs more than
        once here, and its partition."""
        keys, inverse, count = np.unique(v, return_inverse=True, return_counts=True)
        many = count > 1
        many[inverse[own]] = True
        return keys, inverse, many, partition_of(keys, parts)

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows in blocks(batches, block_bytes):
            texts = [t.encode("utf-8", "surrogatepass") for t in texts_of(rows)]
            data = np.frombuffer(b"".join(texts), dtype=np.uint8)
            lengths = np.array([len(t) for t in texts], dtype=np.int64)
            ids = rows.column(0).to_numpy(zero_copy_only=False)
            known = rows.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = np.where(known, ids, -(1 << 63)).astype(np.int64)
            yield row_batch("text", name, a=squeeze(data), b=squeeze(lengths), c=squeeze(ids), d=squeeze(known))

    def ask(one: dict) -> Iterator[dict]:
        v, twice = (window_runs(unsqueeze(one["a"], np.uint8), unsqueeze(one["b"], np.int64), width)[k] for k in (2, 4))
        keys, _, many, part = by_part(v, twice)
        for p in np.unique(part):
            own = part == p
            yield row("ask", one["block"], int(p), a=squeeze_sorted(keys[own]), b=squeeze(np.packbits(many[own])))

    table = shared_table(docs.select("doc_id", "text").mapInArrow(split, ROWS), "substring-blocks")

    def which_repeat(rows) -> Iterator[dict]:
        asked = [unsqueeze_sorted(a) for a in rows["a"]]
        many = [np.unpackbits(unsqueeze(b, np.uint8))[:len(k)].astype(bool) for k, b in zip(asked, rows["b"])]
        order = np.concatenate(asked)
        keys, inverse, count = np.unique(order, return_inverse=True, return_counts=True)
        hit = count > 1
        hit[inverse[np.concatenate(many)]] = True
        for name, bits in zip(rows["block"], np.split(hit[inverse], np.cumsum([len(k) for k in asked])[:-1])):
            yield row("repeat", name, rows["part"][0], a=squeeze(np.packbits(bits)))

    repeats = grouped(mapped(table, ask), "part", parts, which_repeat, ROWS)

    def fragments(rows) -> Iterator[dict]:
        at = rows["kind"].index("text")
        name = rows["block"][at]
        data = unsqueeze(rows["a"][at], np.uint8)
        lengths, ids = unsqueeze(rows["b"][at], np.int64), unsqueeze(rows["c"][at], np.int64)
        first, windows, v, doc, twice = window_runs(data, lengths, width)
        keys, inverse, _, part = by_part(v, twice)
        hit = np.zeros(len(keys), dtype=bool)
        for kind, p, a in zip(rows["kind"], rows["part"], rows["a"]):
            if kind == "repeat":
                own = np.flatnonzero(part == p)
                hit[own] = np.unpackbits(unsqueeze(a, np.uint8))[:len(own)]
        kept = np.flatnonzero(hit[inverse])
        first, windows, v, doc, twice, p = (x[kept] for x in (first, windows, v, doc, twice, part[inverse]))
        start = first - (np.cumsum(lengths) - lengths)[doc]
        # equal fragments of the block are sent once, with the earliest place
        by = np.lexsort((start, doc, ids[doc], p))
        buffer = data.tobytes()
        index = np.zeros(len(by), dtype=np.int64)
        lead = np.zeros(len(by), dtype=bool)
        seen: dict[bytes, int] = {}
        out: list[int] = []
        last = -1

        def flush(part_no):
            if out:
                o = np.array(out)
                piece = b"".join(buffer[f:f + w + width - 1] for f, w in zip(first[o].tolist(), windows[o].tolist()))
                yield row("fragments", name, int(part_no), a=squeeze(np.frombuffer(piece, np.uint8)),
                          b=squeeze(windows[o]), c=squeeze_planes(v[o]),
                          d=squeeze(np.stack([ids[doc[o]], doc[o], start[o], twice[o]])))

        for k in by.tolist():
            if p[k] != last:
                yield from flush(last)
                seen, out, last = {}, [], p[k]
            piece = buffer[first[k]:first[k] + windows[k] + width - 1]
            if piece in seen:
                index[k] = seen[piece]
            else:
                index[k] = seen[piece] = len(out)
                lead[k] = True
                out.append(k)
        yield from flush(last)
        yield row("runs", name, a=squeeze(first), b=squeeze(windows), c=squeeze(p), d=squeeze(index), e=squeeze(lead))

    texts = table
    found = shared_table(grouped(texts.unionByName(repeats), "block", parts, fragments, ROWS), "substring-fragments")

    def judge(rows) -> Iterator[dict]:
        piece, minimum, place, twice, sent = [], [], [], [], []
        for k, name in enumerate(rows["block"]):
            windows = unsqueeze(rows["b"][k], np.int64)
            buffer = unsqueeze(rows["a"][k], np.uint8).tobytes()
            ends = np.cumsum(windows + width - 1)
            piece += [buffer[e - w - width + 1:e] for e, w in zip(ends.tolist(), windows.tolist())]
            minimum.append(unsqueeze_planes(rows["c"][k]))
            where = unsqueeze(rows["d"][k], np.int64).reshape(4, -1)
            place += [(i, name, d, s) for i, d, s in where[:3].T.tolist()]
            twice += where[3].tolist()
            sent.append(len(windows))
        minimum = np.concatenate(minimum)
        earliest: dict[bytes, int] = {}
        for k in sorted(range(len(piece)), key=place.__getitem__):
            earliest.setdefault(piece[k], k)
        distinct = np.array(sorted(earliest.values()))
        distinct = distinct[np.argsort(minimum[distinct], kind="stable")]
        group = minimum[distinct]
        fresh = np.concatenate([[True], group[1:] != group[:-1]])
        alone = fresh & np.concatenate([fresh[1:], [True]])
        # a lone fragment can only repeat itself
        kept = ~alone | np.array(twice, dtype=bool)[distinct]
        distinct, fresh = distinct[kept], fresh[kept]
        bits: dict[int, np.ndarray] = {}
        batch: list[int] = []
        size = 0
        for k, new in [*zip(distinct.tolist(), fresh.tolist()), (None, True)]:
            if batch and (k is None or new and size >= sort_bytes):
                docs_in = sorted({place[j][:3] for j in batch})
                rank = {x: r for r, x in enumerate(docs_in)}
                order = np.array([rank[place[j][:3]] << 32 | place[j][3] for j in batch])
                bits.update(zip(batch, earlier_elsewhere([piece[j] for j in batch], order, width)))
                batch, size = [], 0
            if k is not None:
                batch.append(k)
                size += len(piece[k])
        at = 0
        for name, n in zip(rows["block"], sent):
            code = np.ones(n, dtype=np.uint8)  # 1: all windows go
            partial = []
            for j in range(n):
                if earliest[piece[at + j]] == at + j:
                    own = bits.get(at + j)
                    code[j] = 0 if own is None or not own.any() else 2
                    if code[j]:
                        partial.append(own)
            at += n
            yield row("verdict", name, rows["part"][0], a=squeeze(code),
                      b=squeeze(np.packbits(np.concatenate(partial) if partial else np.zeros(0, bool))))

    verdicts = grouped(found.where("kind = 'fragments'"), "part", parts, judge, ROWS)

    def masks(rows) -> Iterator[dict]:
        at, runs = rows["kind"].index("text"), rows["kind"].index("runs")
        data = unsqueeze(rows["a"][at], np.uint8)
        lengths, ids = unsqueeze(rows["b"][at], np.int64), unsqueeze(rows["c"][at], np.int64)
        known = unsqueeze(rows["d"][at], bool)
        first, windows = unsqueeze(rows["a"][runs], np.int64), unsqueeze(rows["b"][runs], np.int64)
        part, index = unsqueeze(rows["c"][runs], np.int64), unsqueeze(rows["d"][runs], np.int64)
        lead = unsqueeze(rows["e"][runs], bool)
        change = np.zeros(len(data) + 1, dtype=np.int32)

        def remove(a, b):  # windows from a to before b
            np.add.at(change, a, 1)
            np.add.at(change, b + width - 1, -1)

        remove(first[~lead], (first + windows)[~lead])
        for kind, p, a, b in zip(rows["kind"], rows["part"], rows["a"], rows["b"]):
            if kind != "verdict":
                continue
            own = np.flatnonzero(lead & (part == p))
            own = own[index[own].argsort()]
            code = unsqueeze(a, np.uint8)
            remove(first[own[code == 1]], (first + windows)[own[code == 1]])
            some = own[code == 2]
            if len(some):
                bits = np.unpackbits(unsqueeze(b, np.uint8))[:windows[some].sum()].astype(np.int8)
                nth = np.arange(len(bits)) - np.repeat(np.cumsum(windows[some]) - windows[some], windows[some])
                spot = (np.repeat(first[some], windows[some]) + nth)[bits == 1]
                remove(spot, spot + 1)
        gone = np.cumsum(change[:-1]) > 0
        begin = np.cumsum(lengths) - lengths
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "starts", "ends", "kept_sha256")}
        for b, n, i, ok in zip(begin.tolist(), lengths.tolist(), ids.tolist(), known.tolist()):
            own = gone[b:b + n]
            edge = np.flatnonzero(np.diff(own.astype(np.int8), prepend=0, append=0))
            out["doc_id"].append(i if ok else None)
            out["n_bytes"].append(n)
            out["n_removed"].append(int(own.sum()))
            out["starts"].append(edge[::2].tolist())
            out["ends"].append(edge[1::2].tolist())
            out["kept_sha256"].append(hashlib.sha256(data[b:b + n][~own].tobytes()).hexdigest())
        yield out

    last = texts.unionByName(found.where("kind = 'runs'")).unionByName(verdicts)
    return grouped(last, "block", parts, masks, "doc_id long, n_bytes long, n_removed long, starts array<long>, "
                                                "ends array<long>, kept_sha256 string")
