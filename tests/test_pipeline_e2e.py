"""End to end over files: request bodies -> ingest -> raw zone -> process
(twice, incremental) -> curate -> catalog tables -> SQL."""

from pyspark.sql import functions as F

from zonelake import schemas as S
from zonelake.operators import curate as C
from zonelake.operators import process as P
from zonelake.plans import jobs
from zonelake.sources import io
from zonelake.sources.tables import events_to_requests, load


def test_files_end_to_end(spark, sf_small, tmp_path):
    root = str(tmp_path)
    events = load(spark, sf_small, "events")
    requests = events_to_requests(events).withColumn("request_id", F.col("event_id").cast("string"))
    jobs.ingest_job(requests, f"{root}/raw", f"{root}/outcomes")

    outcomes = spark.read.parquet(f"{root}/outcomes")
    n_events = events.count()
    assert outcomes.count() == n_events
    raw = io.read_raw(spark, f"{root}/raw")
    n_ok = outcomes.filter("status_code = 200").count()
    assert raw.count() == n_ok
    # Partition columns keep their declared types and zero padding.
    assert dict(raw.dtypes)["month"] == "string"
    assert raw.filter(F.length("month") != 2).count() == 0

    counts = jobs.process_job(spark, f"{root}/raw", f"{root}/processed", f"{root}/quarantine", processing_time="2024-02-01 00:00:00")
    processed = io.read_processed(spark, f"{root}/processed")
    n_proc = processed.count()
    assert counts["initial"] == n_ok
    assert counts["after_null_filter"] <= n_ok
    assert counts["after_dedup"] == n_proc
    # A second run over the same raw zone adds nothing.
    jobs.process_job(spark, f"{root}/raw", f"{root}/processed", f"{root}/quarantine", processing_time="2024-02-02 00:00:00")
    assert io.read_processed(spark, f"{root}/processed").count() == n_proc

    jobs.curate_job(spark, f"{root}/processed", f"{root}/curated")
    daily = io.read_curated(spark, f"{root}/curated/daily_summary", S.DAILY_SUMMARY)
    stats = io.read_curated(spark, f"{root}/curated/source_statistics", S.SOURCE_STATISTICS)
    hourly = io.read_curated(spark, f"{root}/curated/hourly_metrics", S.HOURLY_METRICS)
    total = n_proc
    assert daily.agg(F.sum("record_count")).first()[0] == total
    assert stats.agg(F.sum("total_records")).first()[0] == total
    assert hourly.agg(F.sum("events_per_hour")).first()[0] == total
    # Same values as the in-memory plan.
    direct = C.source_statistics(processed).collect()
    assert sorted(map(tuple, direct)) == sorted(map(tuple, stats.collect()))

    jobs.register_zones(spark, f"{root}/raw", f"{root}/processed", f"{root}/curated", prefix="e2e_")
    n_sql = spark.sql("SELECT count(*) FROM e2e_processed_data WHERE quality_score >= 80").first()[0]
    assert n_sql == total
    assert spark.sql("SELECT count(*) FROM e2e_raw_data").first()[0] == n_ok


def test_legacy_layout_pretty_printed(spark, tmp_path):
    """B1/B2: the reference's layout (bare source folder, one indented
    object per file) reads with multiLine and path-derived partitions."""
    import json
    import os

    docs = [
        ("iot_sensor_0", "2025", "11", "25", {"ingestion_timestamp": "2025-11-25T10:00:00.000001",
                                              "source": "iot_sensor_0", "metadata": {},
                                              "data": {"device_id": "d", "v": 5}}),
        ("api_logs", "2025", "11", "26", {"ingestion_timestamp": "2025-11-26T11:00:00",
                                          "source": "api_logs", "metadata": None, "data": {"x": "5"}}),
    ]
    for src, y, m, d, obj in docs:
        folder = tmp_path / src / f"year={y}" / f"month={m}" / f"day={d}"
        os.makedirs(folder)
        (folder / "20251125_100000_000001.json").write_text(json.dumps(obj, indent=2))
    raw = io.read_raw(spark, str(tmp_path), layout="legacy")
    rows = {r.source: r for r in raw.collect()}
    assert rows["iot_sensor_0"].year == "2025" and rows["api_logs"].day == "26"
    out = {r.source: r for r in P.process(raw, processing_time="2025-12-01 00:00:00").collect()}
    # metadata {} counts as present (100), explicit null as absent (80).
    assert out["iot_sensor_0"].quality_score == 100
    assert out["api_logs"].quality_score == 80
    # "5" stays a string in the canonical payload text.
    assert out["api_logs"].data == '{"x":"5"}'


def test_read_raw_text_and_validate(spark, tmp_path):
    from zonelake.operators import validate as V

    folder = tmp_path / "source=iot_sensor" / "year=2025" / "month=11" / "day=25"
    os.makedirs(folder)
    (folder / "a.json").write_text('{\n  "source": "iot_sensor",\n  "data": {"device_id": "d"}\n}')
    (folder / "b.json").write_text("not json")
    res = {r.key: r for r in V.validate(io.read_raw_text(spark, str(tmp_path))).collect()}
    assert set(res) == {"source=iot_sensor/year=2025/month=11/day=25/a.json",
                        "source=iot_sensor/year=2025/month=11/day=25/b.json"}
    a = res["source=iot_sensor/year=2025/month=11/day=25/a.json"]
    assert a.status == "invalid"
    assert a.errors == ["Schema validation failed: 'timestamp' is a required property"]
    assert res["source=iot_sensor/year=2025/month=11/day=25/b.json"].status == "error"


import os  # noqa: E402


def test_validate_job_alerts_per_run(spark, tmp_path):
    folder = tmp_path / "raw" / "source=iot_sensor" / "year=2025" / "month=11" / "day=25"
    os.makedirs(folder)
    (folder / "a.json").write_text('{"source": "iot_sensor", "data": {"device_id": "d"}}')
    (folder / "b.json").write_text('{"source": "x", "data": 1}')
    root = str(tmp_path)
    r1 = jobs.validate_job(spark, f"{root}/raw", f"{root}/results", f"{root}/alerts")
    r2 = jobs.validate_job(spark, f"{root}/raw", f"{root}/results", f"{root}/alerts")
    alerts = spark.read.parquet(f"{root}/alerts")
    assert alerts.count() == 2  # one invalid document, once per run
    assert {r.run_id for r in alerts.collect()} == {r1, r2}
    assert spark.read.parquet(f"{root}/results").filter(F.col("status") == "valid").count() == 2
