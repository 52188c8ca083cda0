"""Registered queries for ingestion, validation, data quality and
monitoring. Every input is derived from the driver's tables (``events``
become request bodies and landed documents), so the work grows with them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake import schemas as S
from zonelake.functions.json import NUMBER_KINDS, canonical_json, field, kind, strict_json, variant_string
from zonelake.operators import curate as C
from zonelake.operators import evolution as Ev
from zonelake.operators import ingest as I
from zonelake.operators import monitor as M
from zonelake.operators import quality as Qa
from zonelake.operators import validate as V
from zonelake.operators.process import process
from zonelake.operators.rules import rule_set
from zonelake.plans.jobs import curate_job, process_job
from zonelake.plans.lake import AS_OF, Lake
from zonelake.plans.registry import register
from zonelake.schemas import SOURCE_MATCHES, SOURCE_SCHEMAS
from zonelake.session import scratch_path
from zonelake.sources import io
from zonelake.sources.tables import (
    VALIDATION_TEMPLATES, events_to_batches, events_to_documents, events_to_requests, flawed_raw)
from zonelake.streaming.incremental import process_stream, validate_stream


#: Some sources, not all, are silent for two hours by then.
ALARM_AS_OF = "2024-01-31 01:45:00"


def _requests(lake: Lake) -> DataFrame:
    return events_to_requests(lake.table("events")).withColumn("request_id", F.col("event_id").cast("string"))


# ------------------------------------------------------------- ingestion


@register("ingest_outcomes")
def _ingest_outcomes(lake: Lake) -> DataFrame:
    """Status, error, key, source and time of every request body."""
    return I.ingest(_requests(lake)).outcomes


# ------------------------------------------------------------ validation


def _validation(lake: Lake, keep: tuple = ()) -> DataFrame:
    """Landed documents against the registered schemas, which devices' sources
    meet by prefix."""
    rules = rule_set(SOURCE_SCHEMAS, SOURCE_MATCHES)
    return V.validate(events_to_documents(lake.table("events")), rules=rules, keep=keep)


@register("validation_results")
def _validation_results(lake: Lake) -> DataFrame:
    """V1-V9: one result per landed document."""
    return _validation(lake)


@register("validation_summary")
def _validation_summary(lake: Lake) -> DataFrame:
    """Documents per status."""
    return V.summary(_validation(lake))


@register("validation_alerts")
def _validation_alerts(lake: Lake) -> DataFrame:
    """Alert rows for invalid documents."""
    return V.alerts(_validation(lake))


@register("validation_metrics")
def _validation_metrics(lake: Lake) -> DataFrame:
    """Validation outcomes per source and hour."""
    return V.metrics(_validation(lake))


def _batches(lake: Lake, max_items: int | None) -> DataFrame:
    return I.batch_classify(events_to_batches(lake.table("events")), max_items=max_items)


@register("batch_ingest")
def _batch_ingest(lake: Lake) -> DataFrame:
    """Per batch request: items, accepted, rejected, overall status."""
    return I.batch_summary(_batches(lake, None))


@register("batch_outcomes")
def _batch_outcomes(lake: Lake) -> DataFrame:
    """One outcome per batch item."""
    return I.outcomes(_batches(lake, None))


@register("batch_ingest_limited")
def _batch_ingest_limited(lake: Lake) -> DataFrame:
    """D1 with a size limit (two items), which rejects larger batches."""
    return I.batch_summary(_batches(lake, 2))


# ------------------------------------------------- quality and discovery


def _document_payloads(lake: Lake) -> DataFrame:
    """(source, data) of the landed documents (source NULL unless a
    string; ``schema_diff`` keeps only sources with a schema)."""
    d = strict_json(F.col("text"))
    docs = events_to_documents(lake.table("events")).select(d.alias("_d"))
    return docs.select(
        variant_string(field("_d", "source")).alias("source"), field("_d", "data").alias("data")
    )


@register("schema_discovery")
def _schema_discovery(lake: Lake) -> DataFrame:
    """Merged payload schema per source of the events raw zone."""
    return Qa.discover_schema(lake.raw)


@register("field_profile")
def _field_profile(lake: Lake) -> DataFrame:
    """Payload fields and kinds per source of the documents raw zone."""
    return Qa.field_profile(lake.document_raw)


@register("schema_diff")
def _schema_diff(lake: Lake) -> DataFrame:
    """D3: landed payloads, at every depth, against the source schemas."""
    return Qa.schema_diff(Qa.payload_paths(_document_payloads(lake)), SOURCE_SCHEMAS, SOURCE_MATCHES)


def _quality_records(lake: Lake) -> DataFrame:
    """Landed documents as envelope records with their validation status, the
    date of the folder they lie in, and a processing time that is up to 35
    hours after the landing time in their name."""
    name = F.regexp_extract("key", r"/([0-9]{8}_[0-9]{6})_[0-9]+_([0-9]+)\.json$", 1)
    d = _validation(lake, keep=("text",)).select(
        "key", "source", "status", strict_json(F.col("text")).alias("_d"),
        F.to_timestamp_ntz(name, F.lit("yyyyMMdd_HHmmss")).alias("_landed"),
        F.regexp_extract("key", r"_([0-9]+)\.json$", 1).cast("long").alias("_number"))
    landed, number = F.col("_landed"), F.col("_number")
    return d.select(
        "source", variant_string(field("_d", "ingestion_timestamp")).alias("ingestion_timestamp"),
        field("_d", "metadata").alias("metadata"), field("_d", "data").alias("data"), "status",
        F.to_date(landed).alias("partition_date"),
        F.timestamp_add("HOUR", number % 36, landed).alias("processing_timestamp"), "key")


@register("quality_metrics")
def _quality_metrics(lake: Lake) -> DataFrame:
    """Seven rules of four measures per source and day."""
    return Qa.quality_metrics(_quality_records(lake), Qa.quality_rules())


@register("quality_alerts")
def _quality_alerts(lake: Lake) -> DataFrame:
    """Sources and days that miss the least share of a rule."""
    return Qa.quality_alerts(Qa.quality_metrics(_quality_records(lake), Qa.quality_rules()))


@register("quality_failures")
def _quality_failures(lake: Lake) -> DataFrame:
    """Every failing record with the rules it fails."""
    return Qa.failing_records(_quality_records(lake), Qa.quality_rules()).select(
        "key", F.array_join("failed_rules", ",").alias("failed_rules"))


@register("denormalized")
def _denormalized(lake: Lake) -> DataFrame:
    """Processed rows with their source statistics, which are written
    first and read back as the curated table."""

    path = scratch_path(lake.spark, "source_statistics")
    io.write_source_statistics(lake.source_statistics, path)
    return C.denormalize(lake.processed, lake.spark.read.schema(S.SOURCE_STATISTICS).parquet(path))


def _sensor_payloads(lake: Lake, *templates: int) -> DataFrame:
    """Raw records of the landed documents made by some templates."""
    docs = events_to_documents(lake.table("events").where((F.col("event_id") % VALIDATION_TEMPLATES).isin(*templates)))
    d = docs.select(strict_json(F.col("text")).alias("_d"))
    row = F.struct(
        variant_string(field("_d", "ingestion_timestamp")).alias("ingestion_timestamp"),
        F.regexp_replace(variant_string(field("_d", "source")), "^iot_sensor_[0-9]$", "iot_sensor").alias("source"),
        field("_d", "data").alias("data"))
    # through ``inline``, so that a filter on the source is not pushed into the parsing
    return d.select(F.inline(F.array(row)))


#: Templates of two generations of traffic: the second has text and objects
#: for temperatures, numbers for users, lists of tags and missing members.
GENERATIONS = {1: (0, 3), 2: (1, 2, 4, 10)}


@register("schema_versions")
def _schema_versions(lake: Lake) -> DataFrame:
    """D3: two versions of the payload schemas written to the version table,
    and the changes between them."""
    path = scratch_path(lake.spark, "schema_versions")
    for version, templates in GENERATIONS.items():
        Ev.write_version(Qa.payload_paths(_sensor_payloads(lake, *templates)), path, version)
    return Ev.version_changes(Ev.read_versions(lake.spark, path), 1, 2)


@register("merged_versions")
def _merged_versions(lake: Lake) -> DataFrame:
    """D3: typed files of two versions, each written with its own payload type,
    read under the merged type."""
    spark, path = lake.spark, scratch_path(lake.spark, "typed")
    parts = {v: _sensor_payloads(lake, *t).where("source = 'iot_sensor'") for v, t in GENERATIONS.items()}
    paths = {v: Qa.payload_paths(p) for v, p in parts.items()}
    types = {v: Ev.payload_type(p) for v, p in paths.items()}
    for v, rows in parts.items():
        Ev.write_typed(rows, types[v], path, v)
    merged = Ev.payload_type(paths[1].unionByName(paths[2]))
    rows = Ev.read_merged(spark, path, types, merged)
    return _sensor_totals(rows, "version")


def _sensor_totals(rows: DataFrame, by: str) -> DataFrame:
    temperature = F.col("data.readings.temperature")
    return rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("records"), F.count("data.device_id").alias("devices"),
        F.sum("data.readings.humidity").alias("humidity"),
        F.count_if(kind(temperature) == "STRING").alias("text_temperatures"),
        F.count_if(kind(temperature).isin(*NUMBER_KINDS)).alias("number_temperatures"),
        F.sum(F.coalesce(F.size("data.readings.tags"), F.lit(0)).cast("long")).alias("tags"))


@register("discovered_table")
def _discovered_table(lake: Lake) -> DataFrame:
    """A source with conflicting kinds registered as a catalog table from
    its discovered schema, and read back through the table."""
    path = scratch_path(lake.spark, "discovered")
    raw = _sensor_payloads(lake, 0, 1, 2, 10).where("source = 'iot_sensor'")
    ddl = Ev.payload_type(Qa.payload_paths(raw))
    table = Ev.register_discovered(lake.spark, path.rsplit("/", 1)[1].replace("-", "_"), raw, ddl, path)
    return _sensor_totals(table, "ingestion_date")


@register("validated_outputs")
def _validated_outputs(lake: Lake) -> DataFrame:
    """V9: validated documents in one split write, each output read back, and
    the valid ones moved on through raw -> processed."""
    path = scratch_path(lake.spark, "validated")
    V.write_split(_validation(lake, keep=("text",)), path)
    outputs = {s: V.read_split(lake.spark, path, s) for s in ("valid", "invalid", "error")}
    moved = process(V.valid_envelopes(outputs["valid"]), processing_time="2024-02-01 00:00:00")
    rows = [df.select(F.lit(s).alias("output"), "source", F.length("text").alias("chars"),
                      F.size(F.coalesce("all_errors", F.array())).alias("errors")) for s, df in outputs.items()]
    rows.append(moved.select(F.lit("processed").alias("output"), "source", F.lit(0).alias("chars"), F.lit(0).alias("errors")))
    return reduce(DataFrame.unionByName, rows).groupBy("output", "source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("chars").alias("chars"), F.sum("errors").alias("errors"))


@register("streaming_validation")
def _streaming_validation(lake: Lake) -> DataFrame:
    """Landed documents as a stream, each micro-batch validated once and
    written as results by status and as alerts."""
    spark, root = lake.spark, scratch_path(lake.spark, "streaming_validation")
    docs = events_to_documents(lake.table("events"))
    docs.repartition(3, "key").write.parquet(f"{root}/landed")
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/landed")
    validate_stream(stream, f"{root}/results", f"{root}/alerts", f"{root}/checkpoint",
                    rules=rule_set(SOURCE_SCHEMAS, SOURCE_MATCHES)).awaitTermination()
    results = spark.read.parquet(f"{root}/results").select("status", F.length("text").alias("chars"))
    sent = spark.read.parquet(f"{root}/alerts").select(F.lit("alert").alias("status"), F.length("message").alias("chars"))
    return results.unionByName(sent).groupBy("status").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("chars").alias("chars"))


@register("accepted_envelopes")
def _accepted_envelopes(lake: Lake) -> DataFrame:
    """The raw records of accepted requests, with the metadata default,
    the time stamp and the partition values, landed and read back."""
    path = scratch_path(lake.spark, "accepted")
    io.write_raw(I.accepted(I.classify(_requests(lake))), path)
    return io.read_raw(lake.spark, path).select(
        "source", "ingestion_timestamp", canonical_json("metadata").alias("metadata"), canonical_json("data").alias("data"),
        "year", "month", "day")


@register("curated_tables")
def _curated_tables(lake: Lake) -> DataFrame:
    """The job's three written tables, read back."""
    root = scratch_path(lake.spark, "curated")
    io.write_processed(lake.processed, f"{root}/processed")
    curate_job(lake.spark, f"{root}/processed", f"{root}/curated")
    read = lambda name, schema: io.read_curated(lake.spark, f"{root}/curated/{name}", schema)
    daily = read("daily_summary", S.DAILY_SUMMARY)
    hourly = read("hourly_metrics", S.HOURLY_METRICS)
    stats = read("source_statistics", S.SOURCE_STATISTICS)
    day = F.make_date("year", "month", "day").cast("string")
    none = F.lit(None).cast("string")
    return (daily.select(F.lit("daily").alias("output"), "source", day.alias("period"), F.col("record_count").alias("records"),
                         F.col("avg_quality_score").alias("quality"), F.col("first_ingestion").alias("first"))
            .unionByName(hourly.select(F.lit("hourly").alias("output"), "source", F.col("hour_start").cast("string").alias("period"),
                                       F.col("events_per_hour").alias("records"), F.col("avg_quality").alias("quality"),
                                       none.alias("first")))
            .unionByName(stats.select(F.lit("source").alias("output"), "source", none.alias("period"),
                                      F.col("total_records").alias("records"), F.col("avg_quality").alias("quality"),
                                      F.col("first_seen").alias("first"))))


@register("quarantine")
def _quarantine(lake: Lake) -> DataFrame:
    """The raw zone with broken timestamps, missing payloads and
    exact copies, through the batch job with its run ledger: the first days,
    the same again (nothing new), then the rest; rows per output and
    partition."""
    root = scratch_path(lake.spark, "quarantine")
    raw = flawed_raw(lake.raw.drop("_processing_ts"))
    for part in (F.col("day") <= "20", F.lit(False), F.col("day") > "20"):
        io.write_raw(raw.where(part), f"{root}/raw")
        process_job(lake.spark, f"{root}/raw", f"{root}/processed", f"{root}/quarantine", ledger_path=f"{root}/ledger",
                    processing_time="2024-02-01 00:00:00")
    kept = io.read_processed(lake.spark, f"{root}/processed")
    apart = lake.spark.read.schema(S.PROCESSED).parquet(f"{root}/quarantine").select(*S.PROCESSED.fieldNames())
    rows = kept.withColumn("output", F.lit("processed")).unionByName(apart.withColumn("output", F.lit("quarantine")))
    return rows.groupBy("output", "source", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("records"), F.sum("quality_score").alias("score"))


@register("curate_totals")
def _curate_totals(lake: Lake) -> DataFrame:
    """C4: records per source in each of the three curated outputs, from rows
    of which some have a date but no readable time."""
    rows = lake.processed.withColumn("ingestion_timestamp", F.when(
        F.substring("ingestion_timestamp", 18, 2) < "10",
        F.concat(F.substring("ingestion_timestamp", 1, 10), F.lit("Tgarbage"))).otherwise(F.col("ingestion_timestamp")))
    out = C.curate(rows)
    parts = (("daily", out.daily_summary, "record_count"), ("source", out.source_statistics, "total_records"),
             ("hourly", out.hourly_metrics, "events_per_hour"))
    totals = [df.groupBy("source").agg(F.sum(n).alias("records")).withColumn("output", F.lit(name))
              for name, df, n in parts]
    return totals[0].unionByName(totals[1]).unionByName(totals[2])


# ------------------------------------------------------------ monitoring


def _outcomes(lake: Lake) -> DataFrame:
    return I.ingest(_requests(lake)).outcomes


@register("request_metrics")
def _request_metrics(lake: Lake) -> DataFrame:
    """M2: requests, 4xx and 5xx per hour."""
    return M.request_metrics(_outcomes(lake))


@register("request_last_hour")
def _request_last_hour(lake: Lake) -> DataFrame:
    """M2: the hour before AS_OF."""
    return M.last_hour(_outcomes(lake), AS_OF)


@register("error_alarms")
def _error_alarms(lake: Lake) -> DataFrame:
    """Windows breaching the error rules, an hour long so that the
    tables' event rate reaches the thresholds."""
    return M.error_alarms(_outcomes(lake), window="1 hour")


@register("freshness_alarms")
def _freshness_alarms(lake: Lake) -> DataFrame:
    """Sources silent for more than two hours at ALARM_AS_OF."""
    return M.freshness_alarms(lake.processed, ALARM_AS_OF)


# ------------------------------------------------------------- streaming


@register("incremental_process")
def _incremental_process(lake: Lake) -> DataFrame:
    """The raw zone is landed in two overlapping parts (days 1-20, then
    days 10 on), so that the second run meets rows already there; after each
    part an ``availableNow`` stream processes the new files into the
    processed zone. Result: rows per processed partition and a sum over
    their fingerprints, which must equal the batch job's."""

    spark = lake.spark
    root = scratch_path(spark, "incremental")
    raw = lake.raw.drop("_processing_ts")
    for part in (F.col("day") <= "20", F.col("day") >= "10"):
        io.write_raw(raw.filter(part), f"{root}/raw")
        process_stream(spark, f"{root}/raw", f"{root}/processed", f"{root}/checkpoint",
                       f"{root}/quarantine", processing_time="2024-02-01 00:00:00").awaitTermination()
    return io.read_processed(spark, f"{root}/processed").groupBy("source", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.conv(F.substring("record_hash", 1, 8), 16, 10).cast("long")).alias("content"),
    )
