"""Column helpers: strict JSON parsing, ISO timestamps, canonical text."""

import pytest
from pyspark.sql import functions as F

from zonelake.functions import canonical_json, is_python_isoformat, kind, strict_json


@pytest.mark.parametrize("text,ok", [
    ('{"a":1}', True), ("[1,2]", True), ('"s"', True), ("null", True), ("5", True),
    ('{"a":1} tail', False), ('{"a":1}}', False), ('1,"c":2', False), ("", False), ('{"a":1', False),
    ('{"a":1,"a":2}', False),
])
def test_strict_json(spark, text, ok):
    r = spark.createDataFrame([(text,)], "t string").select(strict_json("t").isNotNull().alias("ok")).first()
    assert r.ok is ok


@pytest.mark.parametrize("text,ok", [
    ("2025-11-25T10:00:00", True), ("2025-11-25", True), ("2025-11-25 10:00:00.123456", True),
    ("2025-11-25T10:00:00+01:00", True), ("2025-11-25T10:00:00Z", True), ("20251125T100000", True),
    ("2025-11-25T10", True), ("2025-02-30", False), ("2025-11-25T24:00:00", False),
    ("25/11/2025", False), ("2025", False), ("2025-11", False), ("10:00:00", False), ("bad", False),
])
def test_python_isoformat(spark, text, ok):
    r = spark.createDataFrame([(text,)], "t string").select(is_python_isoformat("t").alias("ok")).first()
    assert r.ok is ok


def test_canonical_json_sorts_and_normalises(spark):
    df = spark.createDataFrame([('{"b": 2.50, "a": "5"}',), ("null",)], "t string")
    got = [r.c for r in df.select(canonical_json(F.try_parse_json("t")).alias("c")).collect()]
    assert got == ['{"a":"5","b":2.5}', None]


def test_kind(spark):
    df = spark.createDataFrame([('{"a":1}',), ("[1]",), ("1",), ("1.5",), ('"x"',), ("true",), ("null",)], "t string")
    got = [r.k for r in df.select(kind(F.try_parse_json("t")).alias("k")).collect()]
    assert got == ["OBJECT", "ARRAY", "BIGINT", "DECIMAL", "STRING", "BOOLEAN", "VOID"]


def test_isoformat_agrees_with_python(spark):
    import datetime as dt

    from zonelake.functions.time import is_python_isoformat

    texts = ["2025-11-25", "2025-11-25\n", "2025-11-25T10:0000", "2025-11-25T100000", "20251125T10:00", "2025-1125",
             "2025-02-29", "2024-02-29", "0000-01-01", "2025-11-25T10", "2025-11-25 10:00:00.5", "2025-11-25T10:00:00Z",
             "2025-11-25T10:00:00+05:30", "2025-11-25T10:00:00+0530", "2025-11-25T24:01", "2025-11-25T10:60",
             "2025-13-01", "2025-11-31", "2025-11-25T10:00:00,123", "", "x", "2025-11-25T", "20240230"]

    def python(text):
        try:
            dt.datetime.fromisoformat(text)
            return True
        except ValueError:
            return False

    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.ok for r in rows.select("t", is_python_isoformat("t").alias("ok")).collect()}
    assert got == {t: python(t) for t in texts}
