"""Property tests against plain-Python models on generated inputs.

Inputs are generated in Python (seeded), then checked in one Spark job
each: strict parsing against ``json.loads``, canonical text against
``json.dumps(sort_keys=True)``, and request classification against a
plain-Python model of the reference handler's rules."""

import json
import random

import pytest
from pyspark.sql import functions as F

from zonelake.functions import canonical_json, strict_json
from zonelake.operators import ingest as I

N = 400


def _value(rng: random.Random, depth: int = 0):
    r = rng.random()
    if depth > 2 or r < 0.35:
        return rng.choice([
            rng.randint(-10**6, 10**6), rng.choice(["", "a", "source", "data", "é", "x\"y", "sou\\rce"]),
            True, False, None,
        ])
    if r < 0.7:
        keys = rng.sample(["source", "data", "metadata", "a", "b", "z"], rng.randint(0, 4))
        return {k: _value(rng, depth + 1) for k in keys}
    return [_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]


def _mutate(rng: random.Random, text: str) -> str:
    op = rng.randint(0, 4)
    if op == 0 and text:
        return text[: rng.randint(0, len(text) - 1)]
    if op == 1:
        return text + rng.choice([" x", "}", "]", ",1", " "])
    if op == 2:
        return rng.choice(["[", "{", "", " ", "nul", "tru"]) + text
    return text


def _texts(seed: int):
    rng = random.Random(seed)
    out = []
    for _ in range(N):
        t = json.dumps(_value(rng), ensure_ascii=False)
        out.append(_mutate(rng, t) if rng.random() < 0.4 else t)
    return out


def _py_parse(text):
    try:
        return True, json.loads(text)
    except ValueError:
        return False, None


def test_strict_json_agrees_with_python(spark):
    texts = _texts(1)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r for r in df.select("i", strict_json("t").isNotNull().alias("ok"),
                                     canonical_json(strict_json("t")).alias("c")).collect()}
    for i, t in enumerate(texts):
        ok, v = _py_parse(t)
        assert got[i].ok == ok, t
        if ok:
            want = None if v is None else json.dumps(v, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
            assert got[i].c == want, t


def _handler_model(body):
    """Plain-Python model of the reference handler's status rules."""
    text = "{}" if body is None else body
    try:
        v = json.loads(text)
    except ValueError:
        return 400
    try:
        if "source" not in v or "data" not in v:
            return 400
        src = v["source"]
    except TypeError:
        return 500
    if not isinstance(src, str):
        return 500
    if src == "":
        return 400  # our rule
    return 200


@pytest.mark.parametrize("seed", [2, 3])
def test_classification_agrees_with_handler_model(spark, seed):
    texts = _texts(seed) + [None]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "request_id string, body string")
    got = {r.request_id: r.status_code for r in I.classify(df, received_at=None).select("request_id", "status_code").collect()}
    for i, t in enumerate(texts):
        assert got[str(i)] == _handler_model(t), t
    assert F is not None
