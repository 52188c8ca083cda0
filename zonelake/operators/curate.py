"""Processed -> curated.

The three curated tables come from one hourly base aggregate: one scan of the
processed table and one shuffle, partially aggregated on the map side.
Daily summary and source statistics roll the base up further; the roll-ups
run over a table that is already small (one row per source and hour).
Averages are carried as exact integer sums and counts so roll-ups give the
same value as a direct ``avg``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.functions.time import hour_floor, parse_ts


def hourly_base(processed: DataFrame) -> DataFrame:
    """Per source, date partition and hour: row count, score sum, first and
    last timestamp text. ``hour_start`` is NULL when the timestamp text does
    not parse."""
    return processed.groupBy(
        "source", "year", "month", "day", hour_floor(parse_ts("ingestion_timestamp")).alias("hour_start")
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("quality_score").alias("score_sum"),
        F.min("ingestion_timestamp").alias("first_ts"),
        F.max("ingestion_timestamp").alias("last_ts"),
    )


def _daily_from_base(base: DataFrame) -> DataFrame:
    return base.groupBy("source", "year", "month", "day").agg(
        F.sum("n").alias("n"),
        F.sum("score_sum").alias("score_sum"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    )


def _daily_summary_columns(daily: DataFrame) -> DataFrame:
    return daily.select(
        "day",
        F.col("n").alias("record_count"),
        (F.col("score_sum") / F.col("n")).alias("avg_quality_score"),
        F.col("first_ts").alias("first_ingestion"),
        F.col("last_ts").alias("last_ingestion"),
        "source",
        "year",
        "month",
    )


def _source_statistics_from_daily(daily: DataFrame) -> DataFrame:
    return daily.groupBy("source").agg(
        F.sum("n").alias("total_records"),
        (F.sum("score_sum") / F.sum("n")).alias("avg_quality"),
        F.min("first_ts").alias("first_seen"),
        F.max("last_ts").alias("last_seen"),
    )


def _hourly_from_base(base: DataFrame) -> DataFrame:
    return (
        base.filter(F.col("hour_start").isNotNull())
        .groupBy("source", "hour_start")
        .agg(F.sum("n").alias("n"), F.sum("score_sum").alias("score_sum"))
        .select(
            "hour_start",
            (F.col("hour_start") + F.expr("INTERVAL 1 HOUR")).alias("hour_end"),
            F.col("n").alias("events_per_hour"),
            (F.col("score_sum") / F.col("n")).alias("avg_quality"),
            "source",
        )
    )


def daily_summary(processed: DataFrame) -> DataFrame:
    """Per source and day: record_count, avg_quality_score,
    first_ingestion, last_ingestion (min/max of the timestamp text)."""
    daily = processed.groupBy("source", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("quality_score").alias("score_sum"),
        F.min("ingestion_timestamp").alias("first_ts"),
        F.max("ingestion_timestamp").alias("last_ts"),
    )
    return _daily_summary_columns(daily)


def source_statistics(processed: DataFrame) -> DataFrame:
    """Per source: total_records, avg_quality, first_seen, last_seen.
    Rolled up from a daily aggregate (two-level aggregation)."""
    daily = processed.groupBy("source", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("quality_score").alias("score_sum"),
        F.min("ingestion_timestamp").alias("first_ts"),
        F.max("ingestion_timestamp").alias("last_ts"),
    )
    return _source_statistics_from_daily(daily)


def hourly_metrics(processed: DataFrame) -> DataFrame:
    """One-hour tumbling windows per source: hour_start, hour_end,
    events_per_hour, avg_quality. Rows whose timestamp does not parse are
    left out."""
    hour = hour_floor(parse_ts("ingestion_timestamp"))
    return (
        processed.select("source", "quality_score", hour.alias("hour_start"))
        .filter(F.col("hour_start").isNotNull())
        .groupBy("source", "hour_start")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("quality_score").alias("score_sum"))
        .select(
            "hour_start",
            (F.col("hour_start") + F.expr("INTERVAL 1 HOUR")).alias("hour_end"),
            F.col("n").alias("events_per_hour"),
            (F.col("score_sum") / F.col("n")).alias("avg_quality"),
            "source",
        )
    )


class Curated(NamedTuple):
    daily_summary: DataFrame
    source_statistics: DataFrame
    hourly_metrics: DataFrame


def curate(processed: DataFrame, base: DataFrame | None = None) -> Curated:
    """C4: the three curated tables from one base aggregate.

    Pass ``base`` (``hourly_base(processed)``, persisted or read back from a
    written table) to share one scan of the processed zone among the three
    outputs."""
    if base is None:
        base = hourly_base(processed)
    daily = _daily_from_base(base)
    return Curated(
        daily_summary=_daily_summary_columns(daily),
        source_statistics=_source_statistics_from_daily(daily),
        hourly_metrics=_hourly_from_base(base),
    )


def denormalize(processed: DataFrame, stats: DataFrame) -> DataFrame:
    """Processed rows with their source statistics (left join on source).

    ``stats`` should be the written source statistics (a curated table): the
    size of its files then decides about a broadcast before any shuffle of
    the processed rows. A larger one stays a shuffle join, where AQE splits
    a hot source's partition."""
    s = stats.select(
        "source",
        F.col("total_records").alias("source_total_records"),
        F.col("avg_quality").alias("source_avg_quality"),
        F.col("first_seen").alias("source_first_seen"),
        F.col("last_seen").alias("source_last_seen"),
    )
    return processed.join(s, "source", "left")
