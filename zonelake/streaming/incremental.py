"""Structured Streaming forms of the jobs.

* ``process_stream`` (P9): the raw zone as a file stream; each micro-batch is
  processed and appended to the processed zone. The checkpoint records which
  raw files were consumed, so a rerun reads only new files; rows already in
  the target are left out (``exclude_existing``), which also makes a retried
  micro-batch idempotent.
* ``dedup_stream`` (X2): streaming deduplication with bounded state.
* ``hourly_metrics_stream`` (X3): windowed counts with a watermark.
* ``ingest_stream`` (X1): request files -> raw zone + outcomes.
* ``validate_stream`` (X1): landed documents -> results by status + alerts.

Checkpoints must live in shared storage (the session's
``spark.checkpoint.dir`` on a cluster).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from zonelake import schemas as S
from zonelake.functions.time import parse_ts, utc_naive
from zonelake.operators import ingest as I
from zonelake.operators import process as P
from zonelake.operators import validate as V
from zonelake.operators.rules import RuleSet
from zonelake.session import ensure_checkpoint_dir
from zonelake.sources import io


def _trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval or "1 minute")


def _event_time(text: str):
    """Watermarks need TIMESTAMP (session-zone) values; the session zone is
    UTC, so the naive UTC text maps one to one."""
    return parse_ts(text).cast("timestamp")


def raw_stream(spark: SparkSession, raw_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The raw zone (hive layout, JSON lines) as a file stream with the
    declared schema; partition columns come from the folder names."""
    r = spark.readStream.schema(S.RAW_TABLE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.json(raw_path).select(*S.RAW_TABLE.fieldNames())


def process_stream(spark: SparkSession, raw_path: str, processed_path: str, checkpoint: str,
                   quarantine_path: str, processing_time=None, hash_mode: str = "sha256", available_now: bool = True,
                   interval: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Incremental raw -> processed. Rows without a date go to
    ``quarantine_path``, one folder per micro-batch that a retry replaces.
    Returns the started query (with ``available_now`` it stops by itself
    once all present files are done)."""
    ensure_checkpoint_dir(spark)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = P.process(batch, processing_time=processing_time, hash_mode=hash_mode).checkpoint()
        _replace_batch(P.quarantine(rows), quarantine_path, batch_id)
        out = P.valid_rows(rows)
        if io.exists(spark, processed_path):
            out = P.exclude_existing(out, io.read_processed(spark, processed_path))
        io.write_processed(out, processed_path)

    w = raw_stream(spark, raw_path, max_files_per_trigger).writeStream.foreachBatch(write_batch)
    w = w.option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def dedup_stream(canonical: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Drop repeated (ingestion_timestamp, source, record_hash) rows of
    a canonicalised stream, keeping state only within the watermark. A copy
    arriving later than the watermark is not recognised (the batch form
    stays the reference result)."""
    return (
        canonical.withColumn("_event_ts", _event_time("ingestion_timestamp"))
        .withWatermark("_event_ts", watermark)
        .dropDuplicatesWithinWatermark(list(P.DEDUP_KEYS))
        .drop("_event_ts")
    )


def hourly_metrics_stream(processed: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """One-hour windows per source over a processed stream, emitted once
    the watermark passes the window end (append mode)."""
    return (
        processed.withColumn("_event_ts", _event_time("ingestion_timestamp"))
        .withWatermark("_event_ts", watermark)
        .groupBy(F.window("_event_ts", "1 hour").alias("w"), "source")
        .agg(F.count(F.lit(1)).alias("events_per_hour"), F.avg("quality_score").alias("avg_quality"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("hour_start"),
            F.col("w.end").cast("timestamp_ntz").alias("hour_end"),
            "events_per_hour", "avg_quality", "source",
        )
    )


def ingest_stream(spark: SparkSession, requests_path: str, raw_path: str, outcomes_path: str, checkpoint: str,
                  available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """One request body per file in ``requests_path``; accepted
    envelopes go to the raw zone, every outcome to ``outcomes_path``, both
    below ``batch_id=<n>``, which a retried micro-batch replaces: read the
    raw zone as ``raw_path/batch_id=*``. The classified rows are
    checkpointed for the two writes."""
    ensure_checkpoint_dir(spark)
    stream = spark.readStream.text(requests_path, wholetext=True).select(
        F.col("value").alias("body"),
        F.col("_metadata.file_path").alias("request_id"),
        utc_naive("_metadata.file_modification_time").alias("received_at"),
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        c = I.classify(batch).checkpoint()
        io.write_raw(I.accepted(c), f"{raw_path}/batch_id={batch_id}", mode="overwrite")
        _replace_batch(I.outcomes(c), outcomes_path, batch_id)

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def validate_stream(documents: DataFrame, results_path: str, alerts_path: str, checkpoint: str, rules: RuleSet | None = None,
                    available_now: bool = True, interval: str | None = None) -> StreamingQuery:
    """A stream of landed documents (``key, text``) validated; each
    micro-batch is evaluated once and checkpointed, then written as results with
    their documents (below ``batch_id=<n>/status=<s>``) and as alert rows for
    the invalid ones. Both folders of a batch are replaced when it is retried,
    so a failure between the writes gives no alert twice."""
    ensure_checkpoint_dir(documents.sparkSession)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        results = V.validate(batch, rules=rules, keep=("text",)).checkpoint()
        V.write_split(results, f"{results_path}/batch_id={batch_id}")
        _replace_batch(V.alerts(results), alerts_path, batch_id)

    w = documents.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, available_now, interval).start()


def _replace_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
