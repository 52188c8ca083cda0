"""P1-P7 and C1-C4 on hand-written raw rows, plus the invariants between
the zone tables on the driver's data."""

import pytest
from pyspark.sql import functions as F

from zonelake import schemas as S
from zonelake.operators import curate as C
from zonelake.operators import process as P
from zonelake.plans.lake import Lake
from zonelake.sources import io

ROWS = [
    # ingestion_timestamp, source, metadata, data
    ("2024-01-01T10:00:00.000001", "s1", '{"u":1}', '{"b":2,"a":1}'),
    ("2024-01-01T10:00:00.000001", "s1", None, '{"a":1,"b":2}'),      # duplicate of the first (same canonical data)
    ("2024-01-01T10:30:00.000000", "s1", "{}", '{"x":"5"}'),          # {} counts as metadata
    ("2024-01-01T11:00:00.000000", "s1", None, '{"x":5}'),            # 5 and "5" differ
    ("2024-01-02T00:00:00.000000", "s2", None, "null"),               # JSON null data: dropped
    (None, "s2", None, '{"a":1}'),                                    # no timestamp: dropped
    ("2024-01-02T01:00:00.000000", None, None, '{"a":1}'),            # no source: dropped
    ("not a time", "s2", None, '{"a":1}'),                            # kept, quarantined
]


def _raw(spark):
    df = spark.createDataFrame(ROWS, "ingestion_timestamp string, source string, metadata string, data string")
    return df.select(
        "ingestion_timestamp", "source",
        F.try_parse_json("metadata").alias("metadata"), F.try_parse_json("data").alias("data"),
        F.lit("2024").alias("year"), F.lit("01").alias("month"), F.lit("01").alias("day"),
    )


def test_process_rules(spark):
    counts = P.StageCounts()
    out = P.process(_raw(spark), processing_time="2024-01-03 00:00:00", hash_mode="md5", counts=counts)
    rows = out.collect()
    assert counts.get() == {"initial": 8, "after_null_filter": 5, "after_dedup": 4}
    by = {(r.ingestion_timestamp, r.data): r for r in rows}
    first = by[("2024-01-01T10:00:00.000001", '{"a":1,"b":2}')]
    # Deterministic survivor: the copy with metadata.
    assert first.metadata == '{"u":1}' and first.quality_score == 100
    assert by[("2024-01-01T10:30:00.000000", '{"x":"5"}')].quality_score == 100
    assert by[("2024-01-01T11:00:00.000000", '{"x":5}')].quality_score == 80
    assert (first.year, first.month, first.day) == (2024, 1, 1)
    bad = [r for r in rows if r.ingestion_timestamp == "not a time"]
    assert len(bad) == 1 and bad[0].ingestion_date is None
    assert P.quarantine(out).count() == 1 and P.valid_rows(out).count() == 3
    assert out.columns == list(S.PROCESSED.fieldNames())


def test_dedup_is_partial_aggregate(spark):
    out = P.process(_raw(spark), processing_time="2024-01-03 00:00:00")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # map-side combine before the shuffle
    assert "Window" not in plan


def test_curate_invariants(spark, sf_small):
    lake = Lake(spark, sf_small)
    processed = lake.processed
    n = processed.count()
    cur = C.curate(processed)
    assert cur.daily_summary.agg(F.sum("record_count")).first()[0] == n
    assert cur.source_statistics.agg(F.sum("total_records")).first()[0] == n
    assert cur.hourly_metrics.agg(F.sum("events_per_hour")).first()[0] == n
    # Roll-ups equal direct aggregates.
    direct = {r.source: r for r in C.source_statistics(processed).collect()}
    for r in cur.source_statistics.collect():
        d = direct[r.source]
        assert (r.total_records, r.first_seen, r.last_seen) == (d.total_records, d.first_seen, d.last_seen)
        assert abs(r.avg_quality - d.avg_quality) < 1e-9
    assert cur.hourly_metrics.filter(F.col("hour_end") != F.col("hour_start") + F.expr("INTERVAL 1 HOUR")).count() == 0


def test_process_is_idempotent_on_own_keys(spark, sf_small):
    lake = Lake(spark, sf_small)
    once = P.valid_rows(lake.processed)
    again = P.exclude_existing(once, once)
    assert again.count() == 0


def test_denormalize_broadcasts_small_side(spark, sf_small):
    lake = Lake(spark, sf_small)
    d = C.denormalize(lake.processed, lake.source_statistics)
    assert d.count() == lake.processed.count()
    d.write.format("noop").mode("overwrite").save()
    # AQE measured the five-row side and switched to a broadcast join.
    final = d._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final
    checked = C.denormalize(lake.processed, lake.source_statistics)
    assert "BroadcastHashJoin" in checked._jdf.queryExecution().executedPlan().toString()


def test_job_keeps_undated_rows_and_counts_them(spark, tmp_path):
    from zonelake.plans.jobs import process_job

    rows = [("2025-11-25T10:00:00", "s", '{"a":1}'), ("2025-11-25T10:00:00", "s", '{"a":1}'),
            ("garbage", "s", '{"b":1}'), ("2025-11-25T11:00:00", "s", None)]
    raw = spark.createDataFrame(rows, "ingestion_timestamp string, source string, data string").select(
        "ingestion_timestamp", "source", F.lit(None).cast("variant").alias("metadata"),
        F.try_parse_json("data").alias("data"), F.lit("2025").alias("year"), F.lit("11").alias("month"),
        F.lit("25").alias("day"))
    paths = [str(tmp_path / n) for n in ("raw", "processed", "quarantine")]
    io.write_raw(raw, paths[0])
    counts = process_job(spark, *paths, processing_time="2025-11-26 00:00:00")
    assert counts.pop("run_id").startswith("r")
    assert counts == {"initial": 4, "after_null_filter": 3, "after_dedup": 2, "quarantined": 1}
    assert io.read_processed(spark, paths[1]).count() == 1
    assert [r.ingestion_timestamp for r in spark.read.parquet(paths[2]).collect()] == ["garbage"]
    again = process_job(spark, *paths, processing_time="2025-11-27 00:00:00")
    assert again["initial"] == 4 and again["quarantined"] == 0
    assert io.read_processed(spark, paths[1]).count() == spark.read.parquet(paths[2]).count() == 1


def test_ledger_reads_each_raw_file_once(spark, tmp_path, monkeypatch):
    from zonelake.plans import jobs

    def raw(rows):
        return spark.createDataFrame(rows, "ingestion_timestamp string, source string, data string").select(
            "ingestion_timestamp", "source", F.lit(None).cast("variant").alias("metadata"),
            F.try_parse_json("data").alias("data"), F.lit("2025").alias("year"), F.lit("11").alias("month"),
            F.lit("25").alias("day"))

    paths = [str(tmp_path / n) for n in ("raw", "processed", "quarantine")]
    run = lambda: jobs.process_job(spark, *paths, ledger_path=str(tmp_path / "ledger"))
    sizes = lambda: (io.read_processed(spark, paths[1]).count(), spark.read.parquet(paths[2]).count())
    io.write_raw(raw([("2025-11-25T10:00:00", "s", '{"a":1}'), ("garbage", "s", '{"b":1}')]), paths[0])
    first = run()
    assert (first["initial"], first["quarantined"], sizes()) == (2, 1, (1, 1))
    assert run()["initial"] == 0 and sizes() == (1, 1)
    io.write_raw(raw([("2025-11-25T11:00:00", "t", '{"a":2}'), ("2025-11-25T10:00:00", "s", '{"a":1}'),
                      ("rubbish", "s", '{"b":1}')]), paths[0])
    # a run that dies before its ledger entry is repeated under the same id and adds nothing twice
    with monkeypatch.context() as m:
        m.setattr(jobs.io, "write_processed", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run()
    third = run()
    assert third["initial"] == 3 and third["run_id"] != first["run_id"] and sizes() == (2, 2)
    assert run()["initial"] == 0 and sizes() == (2, 2)


def test_rollups_keep_rows_with_a_date_but_no_time(spark):
    rows = [("2025-11-25T10:00:00", "s", 100, 2025, 11, 25), ("2025-11-25Tgarbage", "s", 80, 2025, 11, 25)]
    processed = spark.createDataFrame(
        rows, "ingestion_timestamp string, source string, quality_score int, year int, month int, day int")
    out = C.curate(processed)
    assert out.source_statistics.first().total_records == C.source_statistics(processed).first().total_records == 2
    assert out.daily_summary.first().record_count == 2
    assert [r.events_per_hour for r in out.hourly_metrics.collect()] == [1]


def test_processing_time_is_utc_in_any_session_zone(spark):
    import datetime as dt

    from zonelake.functions.time import utc_now

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        now = spark.range(1).select(utc_now().alias("t")).first().t
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert abs(now - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(minutes=5)
