"""Batch jobs over zone folders: ingest -> raw, raw -> processed,
processed -> curated, and landed documents -> validation results.

Each job is one Spark plan per output with explicit schemas; stage counts
come from ``observe`` during the write instead of extra actions.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake import schemas as S
from zonelake.operators import curate as C
from zonelake.operators import ingest as I
from zonelake.operators import process as P
from zonelake.operators import validate as V
from zonelake.operators.rules import RuleSet
from zonelake.session import KEEP_OBSERVED_PLAN, ensure_checkpoint_dir, scoped_conf, scratch_path
from zonelake.sources import io


def ingest_job(requests: DataFrame, raw_path: str, outcomes_path: str) -> None:
    """Classify request bodies; land accepted envelopes in the raw zone and
    every outcome in an outcomes table (Parquet, partitioned by status).

    The classified rows are checkpointed in the shared folder for the two
    writes, so the bodies are read and parsed once."""
    ensure_checkpoint_dir(requests.sparkSession)
    c = I.classify(requests).checkpoint()
    io.write_raw(I.accepted(c), raw_path)
    I.outcomes(c).write.mode("append").partitionBy("status_code").parquet(outcomes_path)


LEDGER = "path string, length bigint, run_id string"


def new_files(spark: SparkSession, raw_path: str, ledger_path: str) -> DataFrame:
    """Raw files (``path, length``) that no run in the ledger has consumed."""
    files = io.list_files(spark, raw_path)
    if io.exists(spark, ledger_path):
        files = files.join(spark.read.schema(LEDGER).parquet(ledger_path), "path", "left_anti")
    return files


def process_job(spark: SparkSession, raw_path: str, processed_path: str, quarantine_path: str,
                layout: str = "hive", incremental: bool = True, processing_time=None,
                hash_mode: str = "sha256", ledger_path: str | None = None) -> dict:
    """Raw -> processed in one pass. The cleaned rows are staged once in the
    shared checkpoint folder; rows whose timestamp has no date go to
    ``quarantine_path`` (below the run's id), the others to the processed zone.
    With ``incremental`` the rows already in either are left out (B6), so a
    rerun adds nothing.

    With ``ledger_path`` (hive layout) a run reads only the raw files that no
    earlier run has consumed and records them there last, which commits it. A
    run that failed before is repeated with the same files and the same id. The
    list of new files reaches the driver, as Spark's own file index does.

    Returns the stage counts (P7), of which ``quarantined`` are the rows set
    apart by this run, and the ``run_id``."""
    if ledger_path is not None:
        if layout != "hive":
            raise ValueError("the run ledger needs the hive layout")
        files = new_files(spark, raw_path, ledger_path).orderBy("path").collect()
        run_id = "r" + hashlib.sha256("\n".join(f"{r['path']} {r['length']}" for r in files).encode()).hexdigest()[:16]
        if not files:
            return {"initial": 0, "after_null_filter": 0, "after_dedup": 0, "quarantined": 0, "run_id": run_id}
        raw = io.read_raw_files(spark, raw_path, [r["path"] for r in files])
    else:
        raw, run_id = io.read_raw(spark, raw_path, layout=layout), "r" + uuid.uuid4().hex[:16]
    counts = P.StageCounts()
    out = P.process(raw, processing_time=processing_time, hash_mode=hash_mode, counts=counts)
    staged_path = scratch_path(spark, "process")
    with scoped_conf(spark, KEEP_OBSERVED_PLAN):
        out.write.parquet(staged_path)
    staged = spark.read.schema(out.schema).parquet(staged_path)
    good, apart = P.valid_rows(staged), P.quarantine(staged)
    mine = f"{quarantine_path}/run_id={run_id}"
    if incremental and io.exists(spark, processed_path):
        good = P.exclude_existing(good, io.read_processed(spark, processed_path))
    if incremental and io.exists(spark, quarantine_path):
        earlier = spark.read.schema(T.StructType([*S.PROCESSED.fields, T.StructField("run_id", T.StringType())])).parquet(
            quarantine_path).where(F.col("run_id") != run_id)
        # P1 leaves no null in these keys
        apart = apart.join(earlier.select(*P.DEDUP_KEYS), list(P.DEDUP_KEYS), "left_anti")
    apart.write.mode("overwrite").parquet(mine)
    io.write_processed(good, processed_path)
    result = {**counts.get(), "quarantined": spark.read.schema(S.PROCESSED).parquet(mine).count(), "run_id": run_id}
    if ledger_path is not None:
        spark.createDataFrame([(r["path"], r["length"], run_id) for r in files], LEDGER).coalesce(1).write.mode(
            "append").parquet(ledger_path)
    io.discard(spark, staged_path)
    return result


def curate_job(spark: SparkSession, processed_path: str, curated_root: str) -> None:
    """C4: the three curated tables from one scan of the processed zone.

    The hourly base aggregate (one row per source and hour, small) is
    checkpointed to the session's checkpoint folder, so the three writes
    share one scan and survive a lost executor."""
    ensure_checkpoint_dir(spark)
    processed = io.read_processed(spark, processed_path)
    base = C.hourly_base(processed).checkpoint(eager=True)
    out = C.curate(processed, base=base)
    root = curated_root.rstrip("/")
    io.write_daily_summary(out.daily_summary, f"{root}/daily_summary")
    io.write_source_statistics(out.source_statistics, f"{root}/source_statistics")
    io.write_hourly_metrics(out.hourly_metrics, f"{root}/hourly_metrics")


def validate_job(spark: SparkSession, raw_path: str, results_path: str, alerts_path: str | None = None,
                 run_id: str | None = None, rules: RuleSet | None = None) -> str:
    """Validate every landed file in one pass; results with their
    documents go below ``run_id=<id>/status=<status>/``, alert rows below
    ``run_id=<id>/``, made from this run's invalid ones. Both folders are
    replaced when a run is repeated. Returns the run id."""
    run_id = run_id or "r" + uuid.uuid4().hex[:12]
    mine = f"{results_path}/run_id={run_id}"
    V.write_split(V.validate(io.read_raw_text(spark, raw_path), rules=rules, keep=("text",)), mine)
    if alerts_path:
        invalid = V.read_split(spark, mine, "invalid")
        V.alerts(invalid).write.mode("overwrite").parquet(f"{alerts_path}/run_id={run_id}")
    return run_id


def register_zones(spark: SparkSession, raw_path: str, processed_path: str, curated_root: str,
                   prefix: str = "") -> None:
    """Catalog tables for the five zone tables, partitions repaired."""
    root = curated_root.rstrip("/")
    io.register_table(spark, f"{prefix}raw_data", raw_path, S.RAW_TABLE, S.RAW_PARTITIONS, fmt="json")
    io.register_table(spark, f"{prefix}processed_data", processed_path, S.PROCESSED, S.PROCESSED_PARTITIONS)
    io.register_table(spark, f"{prefix}daily_summary", f"{root}/daily_summary", S.DAILY_SUMMARY,
                      ("source", "year", "month"))
    io.register_table(spark, f"{prefix}source_statistics", f"{root}/source_statistics", S.SOURCE_STATISTICS)
    io.register_table(spark, f"{prefix}hourly_metrics", f"{root}/hourly_metrics", S.HOURLY_METRICS, ("source",))
