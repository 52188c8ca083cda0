"""Schema rules as rows, printed values, drift, versions and quality rules."""

import json

import pytest
from pyspark.sql import functions as F

from zonelake.functions.pytext import json_string, py_json, py_str
from zonelake.operators import evolution as E
from zonelake.operators import quality as Qa
from zonelake.operators import rules as R
from zonelake.operators import validate as V
from zonelake.schemas import SOURCE_MATCHES, SOURCE_SCHEMAS

VALUES = [{"a": [1, 2.5, None, True, "it's"], "b": {"z": 1, "a": 'x"y'}}, "both ' and \"", "back\\slash", "tab\t\n\r",
          "\x00\x1f\x7f\x85\xa0\xad", "é日本😀", "​ \U000e0001", [], {}, [[[]]], {"k\n'": "v"}, False, None,
          1e16, 1.5e16, 1e15, 123456789.25, 1e7, 0.0001, 0.00012, 0.00001, 1.5e-7, 1e100, -2.5e-9, -0.0, 10**20, 3.0,
          4.06764177207672e18, -1.2374210169419553e18]


def test_values_print_as_in_python(spark):
    rows = [(json.dumps(v, ensure_ascii=bool(i % 2)), v if isinstance(v, str) else None) for i, v in enumerate(VALUES)]
    got = spark.createDataFrame(rows, "t string, s string").select(
        py_json("t").alias("r"), json_string("s").alias("j"), py_str("s").alias("s")).collect()
    for v, r in zip(VALUES, got):
        assert r.r == repr(v)
        if isinstance(v, str):
            assert (r.s, r.j) == (repr(v), json.dumps(v))


def documents(spark, *rows):
    return spark.createDataFrame([(str(i), json.dumps(d)) for i, d in enumerate(rows)], "key string, text string")


def test_schema_lookup_prefers_exact_then_longest_prefix_then_regex(spark):
    schemas = {n: {"type": "object", "required": [n]} for n in ("exact", "long", "short", "pattern", "unused")}
    matches = [("exact", "exact", "dev_1"), ("short", "prefix", "dev"), ("long", "prefix", "dev_"),
               ("pattern", "regex", "^(dev|lab)"), ("long", "prefix", "日本_"), ("unused", "regex", "^never$")]
    want = {"dev_1": "exact", "dev_2": "long", "device": "short", "lab": "pattern", "日本_x": "long", "other": None}
    rules = R.rule_set(schemas, matches)
    got = V.validate(documents(spark, *({"source": s, "data": {}} for s in want)), rules=rules).collect()
    for r in got:
        need = want[r.source]
        assert r.errors == (None if need is None else [f"Schema validation failed: '{need}' is a required property"])


def test_rule_sets_are_tables(spark, tmp_path):
    rules = R.rule_set(SOURCE_SCHEMAS, SOURCE_MATCHES)
    R.write_rules(spark, rules, str(tmp_path / "rules"))
    back = R.read_rules(spark, str(tmp_path / "rules"))
    assert sorted(back.matches) == sorted(rules.matches) and sorted(back.rules) == sorted(rules.rules)
    with pytest.raises(ValueError):
        R.rule_set({"x": {"pattern": "a"}})
    with pytest.raises(ValueError):
        R.rule_set(SOURCE_SCHEMAS, [("iot_sensor", "suffix", "x")])
    with pytest.raises(ValueError):
        R.rule_set({"x": {"required": ["both ' and \""]}})


def test_all_errors_in_order_and_the_best_one(spark):
    deep = {"type": "object", "properties": {"a": {"type": "object", "properties": {"b": {"type": "integer"}}},
                                             "it's": {"type": "array"}}, "required": ["c"]}
    doc = {"source": "s", "ingestion_timestamp": "x", "data": {"a": {"b": 1.5}, "it's": {"q": ["'", 2.50]}}}
    r = V.validate(documents(spark, doc, {**doc, "data": {"a": {"b": 2.0}, "it's": [], "c": 1}}), schemas={"s": deep})
    bad, good = r.orderBy("key").collect()
    head = "Schema validation failed: "
    assert bad.all_errors == [head + "1.5 is not of type 'integer'", head + "{'q': [\"'\", 2.5]} is not of type 'array'",
                              head + "'c' is a required property", "Invalid timestamp format"]
    # the shallowest path wins
    assert bad.errors == [head + "'c' is a required property", "Invalid timestamp format"]
    assert good.all_errors == ["Invalid timestamp format"]


def test_split_keeps_every_document(spark, tmp_path):
    docs = documents(spark, {"source": "api_events", "data": []}, {"source": "x", "data": 1, "ingestion_timestamp": "2025-01-02"},
                     {"source": "x"}, [1], {"data": None, "metadata": {"m": 1}, "ingestion_timestamp": "2025-01-02T03:04:05"})
    path = str(tmp_path / "out")
    V.write_split(V.validate(docs, keep=("text",)), path)
    got = {s: {r.key: r.text for r in V.read_split(spark, path, s).collect()} for s in ("valid", "invalid", "error")}
    assert {s: sorted(v) for s, v in got.items()} == {"valid": ["1", "4"], "invalid": ["0", "2"], "error": ["3"]}
    assert {k: t for v in got.values() for k, t in v.items()} == {r.key: r.text for r in docs.collect()}
    moved = V.valid_envelopes(V.read_split(spark, path, "valid")).orderBy("source").collect()
    assert [(r.source, r.ingestion_timestamp, r.day) for r in moved] == [
        ("unknown", "2025-01-02T03:04:05.000000", "02"), ("x", "2025-01-02T00:00:00.000000", "02")]


def payloads(spark, source, *values):
    df = spark.createDataFrame([(source, json.dumps(v)) for v in values], "source string, t string")
    return df.select("source", F.lit("2025-01-01T00:00:00").alias("ingestion_timestamp"), F.try_parse_json("t").alias("data"))


def plain_paths(value, path="$"):
    kinds = {dict: "OBJECT", list: "ARRAY", str: "STRING", bool: "BOOLEAN", type(None): "VOID", int: "BIGINT", float: "DECIMAL"}
    yield path, kinds[type(value)]
    if isinstance(value, dict):
        for k, v in value.items():
            yield from plain_paths(v, Qa.member(path, k))
    if isinstance(value, list):
        for v in value:
            yield from plain_paths(v, f"{path}[*]")


@pytest.mark.parametrize("levels", [1, 3])
def test_paths_of_any_depth(spark, levels):
    from collections import Counter

    deep = {"a": {"b": {"c": {"d": {"e": [{"f": [[1, "x"], []]}]}}}}, "odd key": {"it's": 1}, "é": None}
    values = [deep, {"a": 1.5}, [1, [2]], "text", None, {}, {"a": {"b": True}}]
    got = {(r.path, r.kind): r["values"] for r in Qa.payload_paths(payloads(spark, "s", *values), levels=levels).collect()}
    assert got == Counter(p for v in values for p in plain_paths(v))


def test_nested_drift(spark):
    rows = payloads(spark, "iot_sensor_7", {"device_id": "d", "timestamp": "t", "readings": {"temperature": "warm", "extra": [1]}})
    got = {(r.source, r.path): (r.change, r.breaking)
           for r in Qa.schema_diff(Qa.payload_paths(rows), SOURCE_SCHEMAS, SOURCE_MATCHES).collect()}
    mine = {p: c for (s, p), c in got.items() if s == "iot_sensor_7"}
    assert mine == {"$.readings.temperature": ("type_changed", True), "$.readings.humidity": ("removed", True),
                    "$.readings.extra": ("added", False), "$.readings.extra[*]": ("added", False)}
    assert got["api_events", "$.user_id"] == ("removed", True)


def test_versions_and_types(spark, tmp_path):
    old = payloads(spark, "s", {"a": 1, "b": "x", "c": {"d": 1}, "n": 1}, {"a": 2, "b": "y", "c": {"d": 2}, "n": 2})
    new = payloads(spark, "s", {"a": 1.5, "b": 7, "e": [1, 2.5], "n": None}, {"a": 2, "b": "z", "e": [], "n": 3})
    table = str(tmp_path / "versions")
    paths = {1: Qa.payload_paths(old), 2: Qa.payload_paths(new)}
    for v in (1, 2, 2):  # a version written again is replaced
        E.write_version(paths[v], table, v)
    versions = E.read_versions(spark, table)
    got = {r.path: (r.change, r.breaking) for r in E.version_changes(versions, 1, 2).collect()}
    assert got == {"$.a": ("widened", False), "$.b": ("type_changed", True), "$.c": ("removed", True), "$.c.d": ("removed", True),
                   "$.e": ("added", False), "$.e[*]": ("added", False), "$.n": ("nullable", False)}
    seen = {(r.path, r.kind): (r.first_version, r.last_version) for r in E.first_seen(versions).collect()}
    assert seen["$.a", "BIGINT"] == (1, 2) and seen["$.c", "OBJECT"] == (1, 1) and seen["$.e", "ARRAY"] == (2, 2)

    types = {v: E.payload_type(p) for v, p in paths.items()}
    assert types[1] == "struct<`a`:bigint,`b`:string,`c`:struct<`d`:bigint>,`n`:bigint>"
    merged = E.payload_type(paths[1].unionByName(paths[2]))
    assert merged == "struct<`a`:double,`b`:variant,`c`:struct<`d`:bigint>,`e`:array<double>,`n`:bigint>"
    for v, rows in ((1, old), (2, new)):
        E.write_typed(rows, types[v], str(tmp_path / "typed"), v)
    back = E.read_merged(spark, str(tmp_path / "typed"), types, merged)
    rows = sorted((r[0], r[1], r[2] or "", r[3] or 0, r[4] or [], r[5] or 0) for r in back.select(
        "version", "data.a", F.to_json("data.b"), "data.c.d", "data.e", "data.n").collect())
    assert rows == [(1, 1.0, '"x"', 1, [], 1), (1, 2.0, '"y"', 2, [], 2), (2, 1.5, "7", 0, [1.0, 2.5], 0), (2, 2.0, '"z"', 0, [], 3)]


def test_objects_with_data_as_keys_stay_variant(spark):
    paths = Qa.payload_paths(payloads(spark, "s", *({"id": k, "by": {f"k{k}": 1}} for k in range(30))))
    assert E.payload_type(paths, max_members=20) == "struct<`by`:variant,`id`:bigint>"


def test_discovered_table_is_in_the_catalog(spark, tmp_path):
    raw = payloads(spark, "s", {"a": 1, "b": "x"}, {"a": "one", "b": None}, {"c": [True]})
    table = E.register_discovered(spark, "discovered_test", raw, E.payload_type(Qa.payload_paths(raw)), str(tmp_path / "t"))
    assert "discovered_test" in {t.name for t in spark.catalog.listTables()}
    got = spark.sql("SELECT to_json(data.a) AS a, data.b, data.c, ingestion_date FROM discovered_test").collect()
    assert sorted((r.a or "", r.b or "", r.c or []) for r in got) == [("", "", [True]), ('"one"', "", []), ("1", "x", [])]
    assert str(got[0].ingestion_date) == "2025-01-01" and table.count() == 3
    spark.sql("DROP TABLE discovered_test")


def test_quality_rules_are_data(spark):
    rows = [("s", "2025-01-01", "2025-01-01 05:00:00", "valid"), ("s", "2025-01-02T00:00:00", "2025-01-04 00:00:00", "invalid"),
            (None, None, "2025-01-01 00:00:00", "error")]
    records = spark.createDataFrame(rows, "source string, ingestion_timestamp string, p string, status string").selectExpr(
        "source", "ingestion_timestamp", "status", "cast(p as timestamp_ntz) AS processing_timestamp",
        "date'2025-01-01' AS partition_date", "parse_json('{}') AS data", "cast(null AS variant) AS metadata")
    rules = [*Qa.quality_rules(), Qa.QualityRule("range", "source", "length(source) < 5", 1.0)]
    got = {(r.source, r.measure, r.field): (r.passed, r.missed) for r in Qa.quality_metrics(records, rules).collect()}
    assert got["s", "accuracy", "data"] == (1, False) and got["s", "consistency", "ingestion_timestamp"] == (1, True)
    assert got["s", "timeliness", "processing_timestamp"] == (1, True) and got[None, "completeness", "source"] == (0, True)
    assert got["s", "range", "source"] == (2, False) and got["s", "completeness", "metadata"] == (0, True)
    assert Qa.quality_alerts(Qa.quality_metrics(records, rules)).count() == sum(m for _, m in got.values())
    failed = {r.status: r.failed_rules for r in Qa.failing_records(records, rules).collect()}
    assert failed["valid"] == ["completeness:metadata"]
    assert failed["invalid"] == ["completeness:metadata", "accuracy:data", "consistency:ingestion_timestamp",
                                 "timeliness:processing_timestamp"]
