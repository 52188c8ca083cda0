"""The analytical query library (Q1-Q15).

Each query is a function of the zone tables and its parameters; ``as_of``
stands in for ``CURRENT_TIMESTAMP`` so results are reproducible. Row-level
queries with a limit get a unique tie-break so the limit is deterministic.
Partition predicates are plain column comparisons on the partition columns,
so on a partitioned table they become ``PartitionFilters`` (pruning) and
the rest reach the Parquet reader as ``PushedFilters``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonelake.functions.json import canonical_json
from zonelake.functions.time import parse_ts
from zonelake.functions.util import ts_literal


def _pad2(v: int) -> str:
    return f"{int(v):02d}"


def _raw_day(raw: DataFrame, year: int, month: int, day: int | None = None) -> DataFrame:
    cond = (F.col("year") == str(year)) & (F.col("month") == _pad2(month))
    if day is not None:
        cond = cond & (F.col("day") == _pad2(day))
    return raw.filter(cond)


def _processed_month(processed: DataFrame, year: int, month: int) -> DataFrame:
    return processed.filter((F.col("year") == year) & (F.col("month") == month))


# ---------------------------------------------------------------- raw zone


def recent_raw(raw: DataFrame, year: int, month: int, day: int, limit: int = 10) -> DataFrame:
    """Q1: raw rows of one day (latest first), limit 10. Payloads are
    returned as canonical JSON text."""
    rows = _raw_day(raw, year, month, day).select(
        "source",
        "ingestion_timestamp",
        canonical_json("data").alias("data"),
        canonical_json("metadata").alias("metadata"),
    )
    return rows.orderBy(F.col("ingestion_timestamp").desc_nulls_last(), F.col("source").asc_nulls_last(), F.col("data").asc_nulls_last()).limit(limit)


def records_by_source(raw: DataFrame) -> DataFrame:
    """Q2: per source: record_count, first_ingestion, last_ingestion."""
    return (
        raw.groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.min("ingestion_timestamp").alias("first_ingestion"),
            F.max("ingestion_timestamp").alias("last_ingestion"),
        )
        .orderBy(F.col("record_count").desc())
    )


def ingestion_rate_by_hour(raw: DataFrame, year: int, month: int) -> DataFrame:
    """Q3: events per hour and source in one month, latest hour first."""
    hour = F.date_trunc("HOUR", parse_ts("ingestion_timestamp")).cast("timestamp_ntz")
    return (
        _raw_day(raw, year, month)
        .groupBy(hour.alias("hour"), "source")
        .agg(F.count(F.lit(1)).alias("events_per_hour"))
        .orderBy(F.col("hour").desc_nulls_last(), F.col("events_per_hour").desc())
    )


def raw_by_source(raw: DataFrame, source: str, year: int, month: int, limit: int = 10) -> DataFrame:
    """Q14: all raw columns of one source and month, limit 10."""
    rows = _raw_day(raw, year, month).filter(F.col("source") == source).select(
        "ingestion_timestamp",
        "source",
        canonical_json("metadata").alias("metadata"),
        canonical_json("data").alias("data"),
        "year",
        "month",
        "day",
    )
    return rows.orderBy(F.col("ingestion_timestamp").asc_nulls_last(), F.col("data").asc_nulls_last()).limit(limit)


# ---------------------------------------------------------- processed zone


def processed_high_quality(processed: DataFrame, year: int, month: int, day: int,
                           min_score: int = 80, limit: int = 100) -> DataFrame:
    """Q4: processed rows of one day with quality_score >= 80, limit 100."""
    rows = processed.filter(
        (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day)
        & (F.col("quality_score") >= min_score)
    ).select("source", "ingestion_timestamp", "processing_timestamp", "quality_score", "data")
    return rows.orderBy(*(F.col(c).asc_nulls_last() for c in ("ingestion_timestamp", "source", "data"))).limit(limit)


def quality_by_source(processed: DataFrame, year: int, month: int, high: int = 90) -> DataFrame:
    """Q5: per source: avg/min/max score, count, rows with score >= 90."""
    return (
        _processed_month(processed, year, month)
        .groupBy("source")
        .agg(
            F.avg("quality_score").alias("avg_quality"),
            F.min("quality_score").alias("min_quality"),
            F.max("quality_score").alias("max_quality"),
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(F.col("quality_score") >= high).alias("high_quality_records"),
        )
        .orderBy(F.col("avg_quality").desc())
    )


def processing_lag(processed: DataFrame, year: int, month: int) -> DataFrame:
    """Q6: average whole seconds from ingestion to processing, per source."""
    lag = F.timestamp_diff("SECOND", parse_ts("ingestion_timestamp"), F.col("processing_timestamp").cast("timestamp_ntz"))
    return (
        _processed_month(processed, year, month)
        .groupBy("source")
        .agg(F.avg(lag).alias("avg_processing_lag_seconds"), F.count(F.lit(1)).alias("record_count"))
        .orderBy(F.col("avg_processing_lag_seconds").desc())
    )


def freshness(processed: DataFrame, year: int, month: int, as_of, max_minutes: int = 60) -> DataFrame:
    """Q11: sources whose latest record is more than ``max_minutes`` old."""
    last = F.max("ingestion_timestamp")
    return (
        _processed_month(processed, year, month)
        .groupBy("source")
        .agg(last.alias("last_data_received"))
        .withColumn(
            "minutes_since_last_data",
            F.timestamp_diff("MINUTE", parse_ts("last_data_received"), ts_literal(as_of)),
        )
        .filter(F.col("minutes_since_last_data") > max_minutes)
        .orderBy(F.col("minutes_since_last_data").desc())
    )


def data_volume(processed: DataFrame) -> DataFrame:
    """Q12: per source and month: record count and payload size in MB
    (characters of the canonical JSON text / 1024 / 1024, 2 decimals)."""
    return (
        processed.groupBy("source", "year", "month")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.round(F.sum(F.length("data")).cast("double") / 1024.0 / 1024.0, 2).alias("data_size_mb"),
        )
        .orderBy(F.col("data_size_mb").desc())
    )


def duplicate_records(processed: DataFrame, year: int, month: int, top: int = 100) -> DataFrame:
    """Q13: the ``top`` most duplicated record hashes with their timestamps.

    The reference returns one row per hash with ``ARRAY_AGG`` of the
    timestamps; a hash can hold a large share of all rows, so collecting it
    into one array would put an unbounded group in one task. Here the hot
    hashes are ranked from partial counts (combined map-side), the top
    ``top`` (a bounded set) are broadcast back, and the timestamps come out
    as rows: ``record_hash, duplicate_count, ingestion_timestamp``, one row
    per duplicate. Ties at the cut are broken by ``record_hash``."""
    month_rows = _processed_month(processed, year, month).select("record_hash", "ingestion_timestamp")
    counts = month_rows.groupBy("record_hash").agg(F.count(F.lit(1)).alias("duplicate_count"))
    top_hashes = counts.filter(F.col("duplicate_count") > 1).orderBy(
        F.col("duplicate_count").desc(), F.col("record_hash")
    ).limit(top)
    # at most ``top`` rows of 64 characters
    return month_rows.join(F.broadcast(top_hashes), "record_hash").select(
        "record_hash", "duplicate_count", "ingestion_timestamp"
    ).orderBy(F.col("duplicate_count").desc(), "record_hash", F.col("ingestion_timestamp").asc_nulls_last())


def source_quality(processed: DataFrame, year: int, month: int) -> DataFrame:
    """Q15: per source, in one month: record count and average quality."""
    of_month = processed.filter((F.col("year") == year) & (F.col("month") == month))
    return of_month.groupBy("source").agg(
        F.count(F.lit(1)).alias("record_count"), F.avg("quality_score").alias("avg_quality")
    ).orderBy(F.col("source").asc_nulls_last())


# ------------------------------------------------------------ curated zone


def daily_report(daily_summary: DataFrame, year: int, month: int) -> DataFrame:
    """Q7: daily summary rows of one month, latest day first."""
    return (
        daily_summary.filter((F.col("year") == year) & (F.col("month") == month))
        .select("source", "year", "month", "day", "record_count", "avg_quality_score",
                "first_ingestion", "last_ingestion")
        .orderBy(F.col("year").desc(), F.col("month").desc(), F.col("day").desc(), F.col("record_count").desc())
    )


def source_overview(source_statistics: DataFrame) -> DataFrame:
    """Q8: source statistics with the number of days between first and last
    record."""
    return source_statistics.select(
        "source",
        "total_records",
        "avg_quality",
        "first_seen",
        "last_seen",
        F.datediff(F.try_to_date("last_seen"), F.try_to_date("first_seen")).alias("days_active"),
    ).orderBy(F.col("total_records").desc())


def hourly_trend(hourly_metrics: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Q9: hourly metrics of the ``hours`` hours before ``as_of``."""
    since = ts_literal(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")
    return (
        hourly_metrics.filter(F.col("hour_start") >= since)
        .select("hour_start", "source", "events_per_hour", "avg_quality")
        .orderBy(F.col("hour_start").desc(), F.col("events_per_hour").desc())
    )


def week_over_week(daily_summary: DataFrame) -> DataFrame:
    """Q10: weekly records per source (weeks start on Monday), the previous
    week's records and the percent change (NULL for a first week or a
    previous week of 0), rounded to 2 decimals."""
    week = F.trunc(F.make_date("year", "month", "day"), "week")
    weekly = daily_summary.groupBy("source", week.alias("week_start")).agg(
        F.sum("record_count").alias("weekly_records")
    )
    w = Window.partitionBy("source").orderBy("week_start")
    prev = F.lag("weekly_records", 1).over(w)
    return weekly.select(
        "source",
        "week_start",
        "weekly_records",
        prev.alias("prev_week_records"),
        F.round(F.lit(100.0) * (F.col("weekly_records") - prev) / F.nullif(prev, F.lit(0)), 2).alias("percent_change"),
    ).orderBy("source", F.col("week_start").desc())
