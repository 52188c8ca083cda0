"""Health measures (M1-M3) and alarm rules (D7) as table jobs.

The reference reads these from cloud metrics; here they are aggregates over
the zone folders and the ingestion outcomes table. Window aggregates are
grouped by a time bucket, so each is one partial aggregation and a shuffle
of small partial rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.functions.util import ts_literal

# The alarm thresholds of the reference's monitoring setup.
INGEST_ERROR_THRESHOLD = 5      # more than 5 errors in 5 minutes
SERVER_ERROR_THRESHOLD = 10     # more than 10 server errors in 5 minutes
FRESHNESS_ALARM_MINUTES = 120   # no data for more than 2 hours
ALARM_WINDOW = "5 minutes"


def zone_inventory(spark: SparkSession, zones: dict[str, str], glob: str | None = None) -> DataFrame:
    """M1: per zone, object count and total bytes, from a recursive file
    listing (file contents are not read: only ``path`` and ``length`` are
    selected)."""
    out = None
    for zone, path in zones.items():
        r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        if glob:
            r = r.option("pathGlobFilter", glob)
        df = r.load(path).select(F.lit(zone).alias("zone"), "length")
        out = df if out is None else out.unionByName(df)
    return out.groupBy("zone").agg(
        F.count(F.lit(1)).alias("objects"), F.sum("length").alias("bytes")
    )


def file_inventory(df: DataFrame, label: str) -> DataFrame:
    """M1 from a scan's file metadata: files and bytes behind a DataFrame
    read from files (``_metadata`` column)."""
    files = df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s")).distinct()
    return files.agg(F.lit(label).alias("zone"), F.count(F.lit(1)).alias("objects"), F.sum("s").alias("bytes"))


def catalog_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """M3: tables of a catalog database."""
    q = "SHOW TABLES" + (f" IN {database}" if database else "")
    return spark.sql(q)


def request_metrics(outcomes: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """M2: requests, client errors (4xx) and server errors (5xx) per time
    bucket. The handler answers 500 itself, so the platform's error count
    misses these; counting outcomes does not."""
    w = F.window("ts", bucket)
    return outcomes.groupBy(w.alias("w")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if((F.col("status_code") >= 400) & (F.col("status_code") < 500)).alias("client_errors"),
        F.count_if(F.col("status_code") >= 500).alias("server_errors"),
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "requests", "client_errors", "server_errors",
    )


def last_hour(outcomes: DataFrame, as_of) -> DataFrame:
    """M2 as the monitor reports it: the hour before ``as_of``."""
    t = ts_literal(as_of)
    recent = outcomes.filter((F.col("ts") >= t - F.expr("INTERVAL 1 HOUR")) & (F.col("ts") < t))
    return recent.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if((F.col("status_code") >= 400) & (F.col("status_code") < 500)).alias("client_errors"),
        F.count_if(F.col("status_code") >= 500).alias("server_errors"),
    )


def error_alarms(outcomes: DataFrame, ingest_threshold: int = INGEST_ERROR_THRESHOLD,
                 server_threshold: int = SERVER_ERROR_THRESHOLD, window: str = ALARM_WINDOW) -> DataFrame:
    """Five-minute windows that breach an error rule. Both rules count
    outcomes with status >= 500 (see ``request_metrics``); one row per
    breached rule and window."""
    per = outcomes.groupBy(F.window("ts", window).alias("w")).agg(
        F.count_if(F.col("status_code") >= 500).alias("errors")
    )
    rules = F.array(
        F.struct(F.lit("ingest_errors").alias("rule"), F.lit(ingest_threshold).alias("threshold")),
        F.struct(F.lit("server_errors").alias("rule"), F.lit(server_threshold).alias("threshold")),
    )
    return (
        per.select("w", "errors", F.inline(rules))
        .filter(F.col("errors") > F.col("threshold"))
        .select(
            "rule", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
            F.col("errors").alias("value"), "threshold",
        )
    )


def freshness_alarms(processed: DataFrame, as_of, max_minutes: int = FRESHNESS_ALARM_MINUTES) -> DataFrame:
    """Sources without data for more than ``max_minutes`` at ``as_of``."""
    last = processed.groupBy("source").agg(F.max("ingestion_timestamp").alias("last_data_received"))
    silent = F.timestamp_diff("MINUTE", F.col("last_data_received").try_cast("timestamp_ntz"), ts_literal(as_of))
    return last.select(
        F.lit("no_data").alias("rule"), "source", "last_data_received", silent.alias("value"),
        F.lit(max_minutes).alias("threshold"),
    ).filter(F.col("value") > max_minutes)
