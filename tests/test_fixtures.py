"""Requests by the rules they meet, and the edge rows of FIXTURES.md §4."""

import datetime as dt
import itertools
import json

import pytest
from pyspark.sql import functions as F

from zonelake.operators import curate as C
from zonelake.operators import ingest as I
from zonelake.operators import process as P
from zonelake.operators import validate as V
from zonelake.plans import queries as Q
from zonelake.sources import io

TS = dt.datetime(2025, 11, 25, 10, 0, 0, 123456)

# Every combination of what the rules look at. A missing part is MISSING.
MISSING = object()
SOURCES = {"text": "north", "digits": "0456", "space": "a b", "null": None, "number": 5, "list": ["x"], "empty": "", "none": MISSING}
DATA = {"object": {"x": 1}, "nested": {"x": {"y": [1, {"z": None}]}}, "array": [1, "a"], "text": "5", "number": 5,
        "real": 2.5, "flag": False, "null": None, "none": MISSING}
METADATA = {"object": {"m": 1}, "null": None, "none": MISSING}


def status_of(source, data):
    """The rules: both keys must be there, the source must be text."""
    if source is MISSING or data is MISSING or source == "":
        return 400
    return 200 if isinstance(source, str) else 500


def bodies():
    for (s, source), (d, data), (m, metadata) in itertools.product(SOURCES.items(), DATA.items(), METADATA.items()):
        parts = {"source": source, "data": data, "metadata": metadata}
        yield f"{s}-{d}-{m}", {k: v for k, v in parts.items() if v is not MISSING}, status_of(source, data)


def test_every_combination_end_to_end(spark, tmp_path):
    requests = list(bodies())
    rows = [(i, json.dumps(b), TS) for i, b, _ in requests]
    df = spark.createDataFrame(rows, "request_id string, body string, received_at timestamp_ntz")
    got = I.ingest(df)
    assert {r.request_id: r.status_code for r in got.outcomes.collect()} == {i: s for i, _, s in requests}
    io.write_raw(got.accepted, str(tmp_path / "raw"))
    raw = io.read_raw(spark, str(tmp_path / "raw"))
    processed = P.process(raw, processing_time="2025-11-25 11:00:00")
    # of the accepted ones, a null payload goes and copies with other metadata count once
    kept = {(b["source"], json.dumps(b["data"])) for _, b, s in requests if s == 200 and b["data"] is not None}
    assert processed.count() == len(kept)
    totals = {r.source: r.total_records for r in C.source_statistics(processed).collect()}
    assert totals == {source: len(DATA) - 2 for source in ("north", "0456", "a b")}
    # of copies the one with metadata stays, and an absent one is {}
    assert {r.quality_score for r in processed.collect()} == {100}


VALIDATION_EDGES = {
    "device_id_int": ('{"source":"iot_sensor","data":{"device_id":1,"timestamp":"t","readings":{}}}', "invalid"),
    "device_id_null": ('{"source":"iot_sensor","data":{"device_id":null,"timestamp":"t","readings":{}}}', "invalid"),
    "temp_true": ('{"source":"iot_sensor","data":{"device_id":"d","timestamp":"t","readings":{"temperature":true}}}',
                  "invalid"),
    "data_array": ('{"source":"iot_sensor","data":[1]}', "invalid"),
    "no_schema": ('{"source":"iot_sensor_0","data":{"anything":[1,2]}}', "valid"),
    "no_source": ('{"data":{"x":1}}', "valid"),
    "ts_year": ('{"data":1,"ingestion_timestamp":"2025"}', "invalid"),
    "ts_time": ('{"data":1,"ingestion_timestamp":"10:00:00"}', "invalid"),
    "ts_z": ('{"data":1,"ingestion_timestamp":"2025-11-25T10:00:00Z"}', "valid"),
    "ts_date": ('{"data":1,"ingestion_timestamp":"2025-11-25"}', "valid"),
    "ts_null": ('{"data":1,"ingestion_timestamp":null}', "error"),
    "ts_number": ('{"data":1,"ingestion_timestamp":5}', "error"),
}


def test_validation_edges(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in VALIDATION_EDGES.items()], "key string, text string")
    got = {r.key: r for r in V.validate(df).collect()}
    for k, (_, status) in VALIDATION_EDGES.items():
        assert got[k].status == status, k
    assert got["data_array"].errors == ["Schema validation failed: [1] is not of type 'object'"]
    assert got["no_source"].source == "unknown"


def _raw(spark, rows):
    df = spark.createDataFrame(rows, "ingestion_timestamp string, source string, data string")
    return df.select("ingestion_timestamp", "source", F.lit(None).cast("variant").alias("metadata"),
                     F.try_parse_json("data").alias("data"),
                     F.lit("2025").alias("year"), F.lit("11").alias("month"), F.lit("25").alias("day"))


def test_process_edges(spark, tmp_path):
    t = "2025-11-25T10:00:00.000000"
    out = P.process(_raw(spark, [
        (t, "s", '{"j":1}'), (t, "s", '{"k":1}'),            # different payloads: two rows
        (t, "s", '{"a":1,"b":2}'), (t, "s", '{"b":2,"a":1}'),  # key order: one row
        (t, "0456", '{"x":1}'),
        ("2025-11-25T11:00:00.000000", "s", '{"a":1,"b":2}'),  # same data, other time
        ("garbage", "s", '{"z":1}'),                           # no event time
    ]), processing_time="2025-11-26 00:00:00")
    assert out.count() == 6
    io.write_processed(P.valid_rows(out), str(tmp_path / "p"))
    back = io.read_processed(spark, str(tmp_path / "p"))
    assert "0456" in {r.source for r in back.collect()}
    dup = Q.duplicate_records(back, 2025, 11).collect()
    assert {r.duplicate_count for r in dup} == {2} and len(dup) == 2
    # NULL event time: in source statistics, absent from hourly metrics.
    stats = {r.source: r.total_records for r in C.source_statistics(out).collect()}
    hourly = C.hourly_metrics(out).filter(F.col("source") == "s").agg(F.sum("events_per_hour")).first()[0]
    assert stats["s"] == 5 and hourly == 4


def test_week_over_week_edges(spark):
    rows = [
        ("a", 2025, 11, 30, 3),   # Sunday -> week of Monday 2025-11-24
        ("a", 2025, 12, 1, 0),    # next week, 0 records
        ("a", 2025, 12, 8, 4),    # previous week 0 -> NULL percent
    ]
    daily = spark.createDataFrame(rows, "source string, year int, month int, day int, record_count bigint")
    got = {str(r.week_start): r for r in Q.week_over_week(daily).collect()}
    assert set(got) == {"2025-11-24", "2025-12-01", "2025-12-08"}
    assert got["2025-11-24"].prev_week_records is None and got["2025-11-24"].percent_change is None
    assert got["2025-12-01"].percent_change == -100.0
    assert got["2025-12-08"].prev_week_records == 0 and got["2025-12-08"].percent_change is None


@pytest.mark.parametrize("minutes,stale", [(60, False), (61, True)])
def test_freshness_boundary(spark, minutes, stale):
    as_of = dt.datetime(2025, 11, 25, 12, 0, 0)
    last = (as_of - dt.timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%S.%f")
    df = spark.createDataFrame([(last, "s", 2025, 11)], "ingestion_timestamp string, source string, year int, month int")
    assert (Q.freshness(df, 2025, 11, as_of).count() == 1) is stale
