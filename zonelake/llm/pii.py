"""Personal data by weak supervision.

Candidates are the spans of four base patterns and of wider ones. Labelers
vote on each candidate (1 personal, -1 not, 0 no opinion): shape and checksum
rules, a gazetteer of top-level domains, and the words around it. Votes of one
kind fall into few patterns; their counts are summed on Spark over all
documents. Expectation-maximisation on those counts estimates each labeler's
reliabilities and the posterior of each vote pattern, and a logistic model
over shape and context features is then trained on the posteriors: the final
span classifier. It decides about the candidates beyond the base ones, which
always stay.

``fit`` reads all texts once and brings only the counted patterns (bounded by
the number of labelers and features) to the driver; ``find`` is one more pass
without a shuffle. Offsets are code points.

Defined results: null and empty texts have no spans; spans of a kind never
overlap (base first, then by start); rows are independent of one another, so
repeated rows and null ids give equal rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.llm.common import map_slices, text_slices, texts_of

KINDS = ("email", "ip", "card", "phone")

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    # a match starts with its first run of digits, or fails from all of them
    "ip": re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: Wider patterns of the candidates beyond the base ones.
WIDE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]+)+"),
    "phone": re.compile(r"(?<![0-9.+(-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9-])"),
    "card": re.compile(r"(?<![0-9.-])[0-9]{4}(?:[./][0-9]{4}){3}(?![0-9])"),
}
#: Common top-level domains.
GAZETTEER = frozenset("com org net edu gov int info io de fr es it uk nl ch at eu us ca jp br example".split())
#: Words that announce a span of the kind, or speak against it.
CONTEXT = {
    "email": frozenset("mail email e-mail contact write reach correo courriel".split()),
    "ip": frozenset("ip address host server addr adresse direccion".split()),
    "card": frozenset("card visa mastercard credit payment karte carte tarjeta".split()),
    "phone": frozenset("phone tel call mobile fax cell telefon telephone telefono".split()),
}
AGAINST = frozenset("version release section isbn issn serial order invoice id build figure".split())
WORD = re.compile(r"[A-Za-z-]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def valid(kind: str, span: str) -> bool:
    """The check that a span of a base pattern must pass."""
    if kind == "ip":
        parts = [p.lstrip("0") for p in span.split(".")]
        return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)
    if kind == "card":
        d = digits_of(span)
        return 14 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 10 <= len(digits_of(span)) <= 15
    return True


EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def email_spans(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost non-overlapping matches of the email pattern, found from
    their @ signs: the run of local characters before it, from the end of the
    match before at the earliest, and a domain right after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1] in LOCAL):
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, by start and kind."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in email_spans(text)]
    for k in (1, 2, 3):
        if k == 3 and "+" not in text or k == 1 and "." not in text:
            continue
        kind = KINDS[k]
        for m in BASE[kind].finditer(text):
            if valid(kind, m.group()):
                out.append((m.start(), k, m.end()))
    return sorted(out)


SPELT_AT = re.compile(r"\(at\)|\[at\]")
SPELT_DOMAIN = re.compile(r" ?[A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]+)+")


def spelt_email_spans(text: str) -> Iterator[tuple[int, int]]:
    """The matches of the wide email pattern, found from their (at), so that a
    long run of local characters is read once."""
    done = 0
    for m in SPELT_AT.finditer(text):
        if m.start() < done:
            continue
        end = m.start() - (text[m.start() - 1:m.start()] == " ")
        start = end
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = SPELT_DOMAIN.match(text, m.end()) if start < end else None
        if domain:
            yield start, domain.end()
            done = domain.end()


def wide_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates beyond the base: clear of every base span."""
    found = []
    for kind, pattern in WIDE.items():
        k = KINDS.index(kind)
        if kind == "email":
            found += [(a, k, b) for a, b in spelt_email_spans(text)] if "at" in text else []
        else:
            found += [(m.start(), k, m.end()) for m in pattern.finditer(text)]
    if not found:
        return []
    starts, ends = [], []  # what the base covers, as disjoint runs
    for s, _, e in base:
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    out, done = [], 0
    for s, k, e in sorted(found):
        before = bisect_left(starts, e) - 1
        if s >= done and (before < 0 or ends[before] <= s):
            out.append((s, k, e))
            done = e
    return out


LABELERS = ("shape", "check", "gazetteer", "context", "against", "edges")


def votes(text: str, start: int, kind: int, end: int) -> tuple[int, ...]:
    """One vote of each labeler."""
    name, span = KINDS[kind], text[start:end]
    near = WORD.findall(text[max(0, start - 40):start].lower()) + WORD.findall(text[end:end + 20].lower())
    d = digits_of(span)
    shape = 1 if BASE[name].fullmatch(span) else -1
    if name == "email":
        check = 1 if 6 <= len(span) <= 80 else -1
        gazetteer = 1 if re.split(r"[.\])]", span)[-1].strip().lower() in GAZETTEER else -1
    elif name == "phone":
        check = 1 if 10 <= len(d) <= 15 else -1
        gazetteer = 1 if span[0] in "+(" else 0
    elif name == "card":
        check = 1 if 14 <= len(d) <= 19 and luhn(d) else -1
        gazetteer = 1 if d[:1] in "3456" else -1
    else:
        check = 1 if valid("ip", span) else -1
        gazetteer = -1 if span.startswith(("0.", "255.")) else 0
    context = 1 if any(w in CONTEXT[name] for w in near) else 0
    against = -1 if any(w in AGAINST for w in near) else 0
    before, after = text[start - 1:start], text[end:end + 1]
    edges = 1 if not before.isalnum() and not after.isalnum() else -1
    return shape, check, gazetteer, context, against, edges


def features(kind: int, vote: tuple[int, ...], span: str) -> tuple[int, ...]:
    """What the span classifier sees: votes and the span's make-up, in a few
    levels each."""
    marks = sum(not c.isalnum() for c in span)
    return (*vote, min(len(digits_of(span)), 20) // 4, min(marks, 8) // 2, min(len(span), 48) // 8)


def design(kind: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Intercept and votes by kind, and the make-up levels, as columns."""
    x = np.concatenate([f[:, :len(LABELERS)], f[:, len(LABELERS):] / 5.0, np.ones((len(f), 1))], axis=1)
    out = np.zeros((len(f), len(KINDS) * x.shape[1]))
    for k in range(len(KINDS)):
        out[kind == k, k * x.shape[1]:(k + 1) * x.shape[1]] = x[kind == k]
    return out


@dataclass
class Model:
    weights: np.ndarray
    reliability: dict[str, np.ndarray]
    at: float = 0.5

    def accepts(self, kind: int, vote: tuple[int, ...], span: str) -> bool:
        x = design(np.array([kind]), np.array([features(kind, vote, span)], dtype=float))
        return bool(1 / (1 + np.exp(-float(x[0] @ self.weights))) >= self.at)


def posteriors(vote: np.ndarray, n: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for two classes and conditionally independent
    labelers with three answers each. Returns P(personal) of each row of
    ``vote`` (weight ``n``) and the answers' probabilities by class. The start
    is the majority of the votes, the prior counts favour agreement."""
    p = 1 / (1 + np.exp(-1.5 * vote.sum(axis=1)))
    table = np.zeros((2, vote.shape[1], 3))
    for _ in range(rounds):
        for c, w in ((0, (1 - p) * n), (1, p * n)):
            for a in (-1, 0, 1):
                table[c, :, a + 1] = ((vote == a) * w[:, None]).sum(axis=0) + (2.0 if a == 2 * c - 1 else 0.5)
            table[c] /= table[c].sum(axis=1, keepdims=True)
        prior = (p * n).sum() / n.sum()
        place = np.arange(vote.shape[1])
        log = [np.log(table[c, place, vote + 1]).sum(axis=1) for c in (0, 1)]
        odds = log[1] - log[0] + np.log((prior + 1e-6) / (1 - prior + 1e-6))
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return p, table


def fit(docs: DataFrame, at: float = 0.5, ridge: float = 1.0) -> Model:
    """Estimate labeler reliabilities and train the span classifier on all
    candidates of ``docs`` (``text``)."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for part in text_slices(batch):
                for t in texts_of(part):
                    base = base_spans(t)
                    for s, k, e in base + wide_spans(t, base):
                        seen[(k, *features(k, votes(t, s, k, e), t[s:e]))] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([list(key) for key in seen], pa.list_(pa.int32())), pa.array(list(seen.values()), pa.int64())],
            names=["key", "n"])

    got = (docs.select("text").mapInArrow(count, "key array<int>, n long")
           .groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").toPandas())
    width = len(LABELERS) + 3
    keys = np.array(got["key"].tolist(), dtype=np.int64).reshape(len(got), width + 1)
    n, kind, f = got["n"].to_numpy(dtype=float), keys[:, 0], keys[:, 1:]
    target, reliability = np.zeros(len(got)), {}
    for k, name in enumerate(KINDS):
        own = np.flatnonzero(kind == k)
        if len(own):
            target[own], reliability[name] = posteriors(f[own, :len(LABELERS)], n[own])
    x = design(kind, f.astype(float))
    w = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps of the ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - target)) + ridge * w
        curve = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return Model(w, reliability, at)


def spans(text: str, model: Model) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base, all) spans of one text as (start, kind, end), in order."""
    base = base_spans(text)
    more = [(s, k, e) for s, k, e in wide_spans(text, base)
            if model.accepts(k, votes(text, s, k, e), text[s:e])]
    return base, sorted(base + more)


def find(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, base, spans`` for every row: arrays of (kind, start, end)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = "array<struct<kind: string, start: int, end: int>>"
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        both = [spans(t, shared.value) for t in texts_of(part)]
        cols = [pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in own] for own in side], kind)
                for side in zip(*both)]
        return pa.RecordBatch.from_arrays([part.column(0), *cols], names=["doc_id", "base", "spans"])

    return map_slices(docs.select("doc_id", "text"), run, f"doc_id long, base {span}, spans {span}")


def mask(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in angle
    brackets; where spans of two kinds overlap, by the first one's for both.
    Other columns, and null texts, stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def masked(text: str) -> str:
        out, done = [], 0
        for s, k, e in spans(text, shared.value)[1]:
            if s >= done:
                out += [text[done:s], f"<{KINDS[k].upper()}>"]
            done = max(done, e)
        return "".join(out) + text[done:]

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        at = part.schema.get_field_index("text")
        texts = [None if t is None else masked(t) for t in part.column(at).to_pylist()]
        return part.set_column(at, "text", pa.array(texts, part.schema.field(at).type))

    return map_slices(docs, run, docs.schema)
