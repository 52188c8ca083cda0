"""I1-I7 and D1 on hand-written request bodies (the reference's four
end-to-end scenarios plus every defect class)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from zonelake.operators import ingest as I

TS = dt.datetime(2024, 1, 2, 3, 4, 5, 1)

CASES = [
    # body, status, error
    ('{"source":"iot_sensor_0","data":{"temperature":21.5},"metadata":{"v":1}}', 200, None),
    ('{"source":"api_logs","data":{"x":1}}', 200, None),
    ('{"data":{"x":1}}', 400, I.ERR_MISSING_FIELDS),
    ('{"source":"a"}', 400, I.ERR_MISSING_FIELDS),
    ('{"source":"a","data":1', 400, I.ERR_INVALID_JSON),
    ('{"source":"a","data":1} tail', 400, I.ERR_INVALID_JSON),
    ("", 400, I.ERR_INVALID_JSON),
    ("[1, 2]", 400, I.ERR_MISSING_FIELDS),
    ('["source", "data"]', 500, I.ERR_INTERNAL),
    ('"only text"', 400, I.ERR_MISSING_FIELDS),
    ('"source and data"', 500, I.ERR_INTERNAL),
    ("5", 500, I.ERR_INTERNAL),
    ("true", 500, I.ERR_INTERNAL),
    ("null", 500, I.ERR_INTERNAL),
    ('{"source":null,"data":1}', 500, I.ERR_INTERNAL),
    ('{"source":5,"data":1}', 500, I.ERR_INTERNAL),
    ('{"source":"","data":1}', 400, I.ERR_EMPTY_SOURCE),
    ('{"source":"a","data":null}', 200, None),
    (None, 400, I.ERR_MISSING_FIELDS),
]


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(str(i), b, TS) for i, (b, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "request_id string, body string, received_at timestamp_ntz")
    return {r.request_id: r for r in I.classify(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_status_and_error(classified, i):
    body, status, error = CASES[i]
    r = classified[str(i)]
    assert (r.status_code, r.error) == (status, error), body


def test_accepted_envelope(spark, classified):
    r = classified["0"]
    assert r.key == "source=iot_sensor_0/year=2024/month=01/day=02/20240102_030405_000001.json"
    assert r.ingestion_timestamp == "2024-01-02T03:04:05.000001"
    assert (r.year, r.month, r.day) == ("2024", "01", "02")
    # Absent metadata defaults to {}; explicit null stays null.
    assert str(classified["1"].metadata) == "{}"


def test_metadata_null_kept(spark):
    df = spark.createDataFrame([('{"source":"a","data":1,"metadata":null}',)], "body string")
    r = I.classify(df, received_at=None).first()
    assert r.status_code == 200 and str(r.metadata) == "null"


def test_accepted_and_outcomes_split(spark):
    rows = [(str(i), b, TS) for i, (b, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "request_id string, body string, received_at timestamp_ntz")
    got = I.ingest(df)
    assert got.accepted.count() == sum(1 for _, s, _ in CASES if s == 200)
    assert got.outcomes.count() == len(CASES)
    assert got.outcomes.columns == list(I.OUTCOME_COLUMNS)


def test_batch_items_and_limits(spark):
    bodies = [
        ("b1", '[{"source":"a","data":1},{"data":2},{"source":"b","data":3}]'),
        ("b2", '[{"source":"a","data":1},{"source":"a","data":2},{"source":"a","data":3},{"source":"a","data":4}]'),
        ("b3", '{"source":"a","data":1}'),
        ("b4", "[]"),
    ]
    df = spark.createDataFrame([(k, b, TS) for k, b in bodies], "request_id string, body string, received_at timestamp_ntz")
    items = I.batch_classify(df, max_items=3)
    per = {(r.request_id, r.item): r.status_code for r in items.collect()}
    assert per == {("b1", 0): 200, ("b1", 1): 400, ("b1", 2): 200, ("b2", None): 413, ("b3", None): 200, ("b4", None): 400}
    summary = {r.request_id: r for r in I.batch_summary(items).collect()}
    assert (summary["b1"].items, summary["b1"].accepted, summary["b1"].status_code) == (3, 2, 207)
    assert summary["b2"].status_code == 413
    assert summary["b3"].status_code == 200


def test_filter_on_status_keeps_plan_small(spark):
    """A filter on the result must not be pushed into the classification
    expression (the generator keeps it above)."""
    df = spark.createDataFrame([(b,) for b, _, _ in CASES if b is not None], "body string")
    plan = I.accepted(I.classify(df, received_at=None))._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 200_000
    assert F is not None
