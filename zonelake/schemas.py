"""Table schemas for the three zones.

Schemas are always passed explicitly on read: inference costs an extra pass
over the input and turns partition values such as ``0456`` into integers.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw zone: one JSON object per record, payload kept as VARIANT so that the
# JSON text "5" and the number 5 stay different values.
RAW_ENVELOPE = T.StructType(
    [
        T.StructField("ingestion_timestamp", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("metadata", T.VariantType()),
        T.StructField("data", T.VariantType()),
    ]
)

# Raw partition columns are zero-padded strings (year=2024/month=01/day=05).
RAW_PARTITIONS = ("source", "year", "month", "day")

RAW_TABLE = T.StructType(
    list(RAW_ENVELOPE.fields)
    + [
        T.StructField("year", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("day", T.StringType()),
    ]
)

# Processed zone: canonical JSON text for payloads (readable by any Parquet
# engine), integer partitions.
PROCESSED = T.StructType(
    [
        T.StructField("ingestion_timestamp", T.StringType()),
        T.StructField("metadata", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("processing_timestamp", T.TimestampNTZType()),
        T.StructField("record_hash", T.StringType()),
        T.StructField("ingestion_date", T.DateType()),
        T.StructField("quality_score", T.IntegerType()),
        T.StructField("source", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
    ]
)

PROCESSED_PARTITIONS = ("source", "year", "month", "day")

DAILY_SUMMARY = T.StructType(
    [
        T.StructField("day", T.IntegerType()),
        T.StructField("record_count", T.LongType()),
        T.StructField("avg_quality_score", T.DoubleType()),
        T.StructField("first_ingestion", T.StringType()),
        T.StructField("last_ingestion", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

SOURCE_STATISTICS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("total_records", T.LongType()),
        T.StructField("avg_quality", T.DoubleType()),
        T.StructField("first_seen", T.StringType()),
        T.StructField("last_seen", T.StringType()),
    ]
)

HOURLY_METRICS = T.StructType(
    [
        T.StructField("hour_start", T.TimestampNTZType()),
        T.StructField("hour_end", T.TimestampNTZType()),
        T.StructField("events_per_hour", T.LongType()),
        T.StructField("avg_quality", T.DoubleType()),
        T.StructField("source", T.StringType()),
    ]
)

INGEST_OUTCOMES = T.StructType(
    [
        T.StructField("status_code", T.IntegerType()),
        T.StructField("error", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
    ]
)

VALIDATION_RESULTS = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("errors", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)

# Registered payload schemas (a JSON-Schema subset: type, required,
# properties). They must equal the reference's rules.
SOURCE_SCHEMAS = {
    "iot_sensor": {
        "type": "object",
        "required": ["device_id", "timestamp", "readings"],
        "properties": {
            "device_id": {"type": "string"},
            "timestamp": {"type": "string"},
            "readings": {
                "type": "object",
                "properties": {
                    "temperature": {"type": "number"},
                    "humidity": {"type": "number"},
                },
            },
        },
    },
    "api_events": {
        "type": "object",
        "required": ["event_type", "user_id", "timestamp"],
        "properties": {
            "event_type": {"type": "string"},
            "user_id": {"type": "string"},
            "timestamp": {"type": "string"},
        },
    },
}

# Which sources the schemas are for, as (schema, match, pattern). Devices send
# ``iot_sensor_<n>``; the reference looks up exact names only.
SOURCE_MATCHES = (
    ("iot_sensor", "exact", "iot_sensor"),
    ("iot_sensor", "prefix", "iot_sensor_"),
    ("api_events", "exact", "api_events"),
)
