"""V1-V11, D6 on hand-written documents."""

import pytest

from zonelake.operators import validate as V

DOCS = {
    "ok": ('{"ingestion_timestamp":"2024-01-01T00:00:00","source":"iot_sensor",'
           '"data":{"device_id":"d","timestamp":"t","readings":{"temperature":1.5,"humidity":3}}}',
           "valid", None, None),
    "req": ('{"source":"iot_sensor","data":{"timestamp":"t","readings":{}}}',
            "invalid", ["Schema validation failed: 'device_id' is a required property"], None),
    # Shallowest error wins: a missing required key beats a wrong type below.
    "depth": ('{"source":"iot_sensor","data":{"device_id":5,"timestamp":"t"}}',
              "invalid", ["Schema validation failed: 'readings' is a required property"], None),
    "nested": ('{"source":"iot_sensor","data":{"device_id":"d","timestamp":"t","readings":{"temperature":"warm"}}}',
               "invalid", ["Schema validation failed: 'warm' is not of type 'number'"], None),
    "bool_not_number": ('{"source":"iot_sensor","data":{"device_id":"d","timestamp":"t","readings":{"humidity":true}}}',
                        "invalid", ["Schema validation failed: True is not of type 'number'"], None),
    "null_present": ('{"source":"api_events","data":{"event_type":"e","user_id":null,"timestamp":"t"}}',
                     "invalid", ["Schema validation failed: None is not of type 'string'"], None),
    "two_errors": ('{"source":"api_events","data":{"user_id":"u"},"ingestion_timestamp":"bad"}',
                   "invalid", ["Schema validation failed: 'event_type' is a required property",
                               "Invalid timestamp format"], None),
    "no_data": ('{"source":"x"}', "invalid", ["Missing 'data' field"], None),
    "no_schema": ('{"source":"iot_sensors","data":[1]}', "valid", None, None),
    "basic_iso": ('{"data":1,"ingestion_timestamp":"20240101T101010"}', "valid", None, None),
    "ts_number": ('{"data":1,"ingestion_timestamp":5}', "error", None, "fromisoformat: argument must be str"),
    "list_source": ('{"source":["x"],"data":1}', "error", None, "unhashable type: 'list'"),
    "array_doc": ("[1]", "error", None, "'list' object has no attribute 'get'"),
    "bad_json": ("nope", "error", None, V.ERR_INVALID_JSON),
}


@pytest.fixture(scope="module")
def results(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in DOCS.items()], "key string, text string")
    return {r.key: r for r in V.validate(df).collect()}


@pytest.mark.parametrize("key", list(DOCS))
def test_document(results, key):
    _, status, errors, error = DOCS[key]
    r = results[key]
    assert (r.status, r.errors, r.error) == (status, errors, error)


def test_source_defaults(results):
    assert results["basic_iso"].source == "unknown"
    assert results["ok"].source == "iot_sensor"


def test_alerts_only_for_invalid(spark):
    df = spark.createDataFrame([(k, v[0]) for k, v in DOCS.items()], "key string, text string")
    res = V.validate(df)
    alerts = {r.key: r for r in V.alerts(res).collect()}
    assert set(alerts) == {k for k, v in DOCS.items() if v[1] == "invalid"}
    assert alerts["no_data"].message == 'Validation failed for no_data\nErrors: [\n  "Missing \'data\' field"\n]'
    assert alerts["no_data"].subject == V.ALERT_SUBJECT
    summary = {r.status: r.documents for r in V.summary(res).collect()}
    assert sum(summary.values()) == len(DOCS)
    m = V.metrics(res).collect()
    assert sum(r.valid + r.invalid + r.errors for r in m) == len(DOCS)
