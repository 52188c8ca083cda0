"""The driver's tables as lake inputs.

``events`` becomes the raw envelope (and request bodies, and raw documents
for validation); ``documents`` becomes a second, text-heavy raw source. Every
mapping is a projection, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.functions.time import iso_text, raw_partition_values


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events_metadata_text(events: DataFrame) -> Column:
    # Four users in five carry metadata; the rest have none (quality 80).
    return F.when(F.col("user_id") % 5 != 0, F.to_json(F.struct("user_id")))


def events_to_raw(events: DataFrame) -> DataFrame:
    """Raw envelope from ``events``: event time is the ingestion time, the
    event type the source, ``props`` the payload.

    Carries ``_processing_ts`` (start of the next day) for a fixed,
    varying processing lag."""
    ts = F.col("ts").cast("timestamp_ntz")
    return events.select(
        iso_text(ts).alias("ingestion_timestamp"),
        F.col("event_type").alias("source"),
        F.try_parse_json(_events_metadata_text(events)).alias("metadata"),
        F.try_parse_json("props").alias("data"),
        *raw_partition_values(ts),
        F.date_add(F.to_date(ts), 1).cast("timestamp_ntz").alias("_processing_ts"),
    )


def documents_to_raw(documents: DataFrame) -> DataFrame:
    """Raw envelope from ``documents``: one record per document, landed
    ``doc_id`` seconds after 2024-01-01 00:00, payload
    ``{doc_id, lang, text}``."""
    ts = F.timestamp_add("SECOND", F.col("doc_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    payload = F.to_json(F.struct("doc_id", "lang", "text"))
    return documents.select(
        iso_text(ts).alias("ingestion_timestamp"),
        F.col("source"),
        F.parse_json(F.to_json(F.struct(F.col("lang").alias("lang")))).alias("metadata"),
        F.try_parse_json(payload).alias("data"),
        *raw_partition_values(ts),
        F.date_add(F.to_date(ts), 1).cast("timestamp_ntz").alias("_processing_ts"),
    )


def flawed_raw(raw: DataFrame) -> DataFrame:
    """``raw`` with defects by the second of its timestamp: every row of
    second 07 twice more as an exact copy, second 13 without a payload,
    second 21 with unreadable timestamp text."""
    second = F.substring("ingestion_timestamp", 18, 2)
    broken = raw.withColumn("data", F.when(second != "13", F.col("data"))).withColumn(
        "ingestion_timestamp",
        F.when(second == "21", F.concat(F.lit("no time "), F.col("ingestion_timestamp"))).otherwise(
            F.col("ingestion_timestamp")))
    copies = F.when(second == "07", F.array(F.lit(1), F.lit(2), F.lit(3))).otherwise(F.array(F.lit(1)))
    return broken.withColumn("_copy", F.explode(copies)).drop("_copy")


# Request-body templates made from each event. Every event becomes exactly
# one body; the template is chosen by ``event_id % 12`` so that all defect
# classes occur in every slice of the table. Fixed templates:
#   0  full envelope with metadata            -> 200
#   1  envelope without metadata              -> 200
#   2  no source                              -> 400 missing fields
#   3  truncated JSON                         -> 400 invalid JSON
#   4  valid JSON followed by text            -> 400 invalid JSON
#   5  JSON array body                        -> 400 missing fields
#   6  JSON number body                       -> 500
#   7  JSON null body                         -> 500
#   8  source is null                         -> 500
#   9  source is a number                     -> 500
#  10  source is the empty string             -> 400 (our rule)
#  11  data is null                           -> 200 (removed later by P1)
BODY_TEMPLATES = 12


def events_to_requests(events: DataFrame) -> DataFrame:
    """Request bodies (``body``, ``received_at``) built from ``events``."""
    # The event type as a JSON string literal (escaped by to_json).
    src = F.regexp_extract(F.to_json(F.array("event_type")), r"^\[(.*)\]$", 1)
    props = F.col("props")
    meta = F.to_json(F.struct("user_id"))
    sel = F.col("event_id") % BODY_TEMPLATES

    def obj(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    body = (
        F.when(sel == 0, obj('{"source":', src, ',"data":', props, ',"metadata":', meta, "}"))
        .when(sel == 1, obj('{"source":', src, ',"data":', props, "}"))
        .when(sel == 2, obj('{"data":', props, "}"))
        .when(sel == 3, obj('{"source":', src, ',"data":', props))
        .when(sel == 4, obj('{"source":', src, ',"data":', props, "} trailing"))
        .when(sel == 5, obj("[", props, "]"))
        .when(sel == 6, F.col("user_id").cast("string"))
        .when(sel == 7, F.lit("null"))
        .when(sel == 8, obj('{"source":null,"data":', props, "}"))
        .when(sel == 9, obj('{"source":', F.col("user_id").cast("string"), ',"data":', props, "}"))
        .when(sel == 10, obj('{"source":"","data":', props, "}"))
        .otherwise(obj('{"source":', src, ',"data":null}'))
    )
    return events.select(
        F.col("event_id"),
        body.alias("body"),
        F.col("ts").cast("timestamp_ntz").alias("received_at"),
    )


# Raw documents for the validator, one per event, chosen by
# ``event_id % 16``. Fixed templates (source, payload):
#   0  iot_sensor, complete reading              -> valid
#   1  iot_sensor, device_id missing             -> invalid (required)
#   2  iot_sensor, temperature is a string       -> invalid (type, depth 2)
#   3  api_events, complete                      -> valid
#   4  api_events, user_id is a number           -> invalid (type, depth 1)
#   5  event type as source (no schema)          -> valid
#   6  no data field                             -> invalid (missing data)
#   7  bad ingestion_timestamp text              -> invalid (timestamp)
#   8  ingestion_timestamp is a number           -> error
#   9  document is a JSON array                  -> error
#  10  iot_sensor_<0-2>, complete, metadata      -> valid (schema by prefix)
#  11  iot_sensor_<0-2>, four errors, quotes,
#      containers and reals to print             -> invalid
#  12  no source                                 -> valid ('unknown')
#  13  api_events, payload is an array           -> invalid (type, depth 0)
#  14  source is null, no schema                 -> valid (source NULL)
#  15  iot_sensor_<0-2>, temperature is an
#      object, bad timestamp                     -> invalid (two errors)
VALIDATION_TEMPLATES = 16


def events_to_documents(events: DataFrame) -> DataFrame:
    """Raw JSON documents (``key``, ``text``) built from ``events``."""
    sel = F.col("event_id") % VALIDATION_TEMPLATES
    ts_text = iso_text(F.col("ts"))
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    dev = q(F.concat(F.lit("dev-"), F.col("user_id").cast("string")))
    uid = F.col("user_id").cast("string")
    temp = F.col("value").cast("string")
    hum = (F.col("event_id") % 100).cast("string")
    device = F.concat(F.lit("iot_sensor_"), (F.col("event_id") % 3).cast("string"))

    def obj(*parts) -> Column:
        return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])

    head = lambda source: obj('{"ingestion_timestamp":', q(ts_text), ',"source":"', source, '"')
    text = (
        F.when(sel == 0, obj(head("iot_sensor"), ',"data":{"device_id":', dev, ',"timestamp":', q(ts_text),
                             ',"readings":{"temperature":', temp, ',"humidity":', hum, "}}}"))
        .when(sel == 1, obj(head("iot_sensor"), ',"data":{"timestamp":', q(ts_text), ',"readings":{"humidity":', hum, "}}}"))
        .when(sel == 2, obj(head("iot_sensor"), ',"data":{"device_id":', dev, ',"timestamp":', q(ts_text),
                            ',"readings":{"temperature":"warm"}}}'))
        .when(sel == 3, obj(head("api_events"), ',"data":{"event_type":', q(F.col("event_type")), ',"user_id":', q(uid),
                            ',"timestamp":', q(ts_text), "}}"))
        .when(sel == 4, obj(head("api_events"), ',"data":{"event_type":', q(F.col("event_type")), ',"user_id":', uid,
                            ',"timestamp":', q(ts_text), "}}"))
        .when(sel == 5, obj(head(F.col("event_type")), ',"data":', F.col("props"), "}"))
        .when(sel == 6, obj(head(F.col("event_type")), "}"))
        .when(sel == 7, obj('{"ingestion_timestamp":', q(F.date_format(F.col("ts").cast("timestamp_ntz"), "dd/MM/yyyy HH:mm")),
                            ',"source":"', F.col("event_type"), '","data":', F.col("props"), "}"))
        .when(sel == 8, obj('{"ingestion_timestamp":', F.col("event_id").cast("string"), ',"source":"', F.col("event_type"),
                            '","data":', F.col("props"), "}"))
        .when(sel == 10, obj(head(device), ',"metadata":{"batch":', uid, '},"data":{"device_id":', dev, ',"timestamp":', q(ts_text),
                             ',"readings":{"temperature":', temp, ',"humidity":', hum, ',"tags":["a",', hum, "]}}}"))
        .when(sel == 11, obj(head(device), ',"data":{"readings":{"humidity":true,"temperature":"it\'s ', hum, '"},"device_id":["it\'s",',
                             temp, ',null,{"z":1.50,"a":"é"}]}}'))
        .when(sel == 12, obj('{"ingestion_timestamp":', q(ts_text), ',"data":', F.col("props"), "}"))
        .when(sel == 13, obj(head("api_events"), ',"data":[', F.col("props"), ",", hum, "]}"))
        .when(sel == 14, obj('{"ingestion_timestamp":', q(ts_text), ',"source":null,"data":', F.col("props"), "}"))
        .when(sel == 15, obj('{"ingestion_timestamp":"soon","source":"', device, '","data":{"device_id":', dev, ',"timestamp":', q(ts_text),
                             ',"readings":{"temperature":{"value":', hum, ',"unit":"°C"},"humidity":', hum, "}}}"))
        .otherwise(obj("[", F.col("props"), "]"))
    )
    key = F.concat(
        F.lit("source="), F.col("event_type"), F.lit("/"),
        F.date_format(F.col("ts").cast("timestamp_ntz"), "'year='yyyy'/month='MM'/day='dd'/'yyyyMMdd_HHmmss_SSSSSS"),
        F.lit("_"), F.col("event_id").cast("string"), F.lit(".json"),
    )
    return events.select(key.alias("key"), text.alias("text"))


# Batch request bodies made from each event, by ``event_id % 3``. Fixed
# templates (items):
#   0  [full envelope, envelope without source]   -> 207 (one accepted)
#   1  full envelope, not a batch                 -> 200
#   2  three full envelopes                       -> 413 when the limit is 2
BATCH_TEMPLATES = 3


def events_to_batches(events: DataFrame) -> DataFrame:
    """Batch request bodies (``request_id``, ``body``, ``received_at``)."""
    src = F.regexp_extract(F.to_json(F.array("event_type")), r"^\[(.*)\]$", 1)
    full = F.concat(F.lit('{"source":'), src, F.lit(',"data":'), F.col("props"), F.lit("}"))
    nosrc = F.concat(F.lit('{"data":'), F.col("props"), F.lit("}"))
    sel = F.col("event_id") % BATCH_TEMPLATES
    body = (
        F.when(sel == 0, F.concat(F.lit("["), full, F.lit(","), nosrc, F.lit("]")))
        .when(sel == 1, full)
        .otherwise(F.concat(F.lit("["), full, F.lit(","), full, F.lit(","), full, F.lit("]")))
    )
    return events.select(
        F.col("event_id").cast("string").alias("request_id"),
        body.alias("body"),
        F.col("ts").cast("timestamp_ntz").alias("received_at"),
    )
