"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each reading the driver's tables end to end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonelake.plans import queries as Q
from zonelake.plans.lake import AS_OF, DAY, MONTH, RAW_SOURCE, YEAR, Lake

Builder = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Builder] = {}


def register(name: str):
    def deco(fn: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Lake(spark, sf_dir))

        build.__name__ = name
        build.__doc__ = fn.__doc__
        _REGISTRY[name] = build
        return fn

    return deco


def registered() -> dict[str, Builder]:
    # Import the modules that register further queries.
    from zonelake.plans import registry_extra  # noqa: F401

    return dict(_REGISTRY)


# ----------------------------------------------------- zones and curation


@register("processed")
def _processed(lake: Lake) -> DataFrame:
    """The processed table."""
    return lake.processed


@register("daily_summary")
def _daily_summary(lake: Lake) -> DataFrame:
    """C1."""
    return lake.daily_summary


@register("source_statistics")
def _source_statistics(lake: Lake) -> DataFrame:
    """C2."""
    return lake.source_statistics


@register("hourly_metrics")
def _hourly_metrics(lake: Lake) -> DataFrame:
    """C3."""
    return lake.hourly_metrics


# ------------------------------------------------------------ Q1 - Q15


@register("recent_raw")
def _recent_raw(lake: Lake) -> DataFrame:
    """Q1."""
    return Q.recent_raw(lake.during(YEAR, MONTH, DAY).raw, YEAR, MONTH, DAY)


@register("records_by_source")
def _records_by_source(lake: Lake) -> DataFrame:
    """Q2."""
    return Q.records_by_source(lake.raw)


@register("ingestion_rate_by_hour")
def _ingestion_rate_by_hour(lake: Lake) -> DataFrame:
    """Q3."""
    return Q.ingestion_rate_by_hour(lake.during(YEAR, MONTH).raw, YEAR, MONTH)


@register("processed_high_quality")
def _processed_high_quality(lake: Lake) -> DataFrame:
    """Q4."""
    return Q.processed_high_quality(lake.during(YEAR, MONTH, DAY).processed, YEAR, MONTH, DAY)


@register("quality_by_source")
def _quality_by_source(lake: Lake) -> DataFrame:
    """Q5."""
    return Q.quality_by_source(lake.during(YEAR, MONTH).processed, YEAR, MONTH)


@register("processing_lag")
def _processing_lag(lake: Lake) -> DataFrame:
    """Q6."""
    return Q.processing_lag(lake.during(YEAR, MONTH).processed, YEAR, MONTH)


@register("daily_report")
def _daily_report(lake: Lake) -> DataFrame:
    """Q7."""
    return Q.daily_report(lake.during(YEAR, MONTH).daily_summary, YEAR, MONTH)


@register("source_overview")
def _source_overview(lake: Lake) -> DataFrame:
    """Q8."""
    return Q.source_overview(lake.source_statistics)


@register("hourly_trend_24h")
def _hourly_trend(lake: Lake) -> DataFrame:
    """Q9."""
    return Q.hourly_trend(lake.hourly_metrics, AS_OF)


@register("week_over_week")
def _week_over_week(lake: Lake) -> DataFrame:
    """Q10."""
    return Q.week_over_week(lake.daily_summary)


@register("freshness")
def _freshness(lake: Lake) -> DataFrame:
    """Q11."""
    return Q.freshness(lake.during(YEAR, MONTH).processed, YEAR, MONTH, AS_OF)


@register("data_volume")
def _data_volume(lake: Lake) -> DataFrame:
    """Q12 over the events source."""
    return Q.data_volume(lake.processed)


@register("document_volume")
def _document_volume(lake: Lake) -> DataFrame:
    """Q12 over the documents source (long payloads, 20 sources)."""
    return Q.data_volume(lake.document_processed)


@register("duplicate_records")
def _duplicate_records(lake: Lake) -> DataFrame:
    """Q13."""
    return Q.duplicate_records(lake.during(YEAR, MONTH).processed, YEAR, MONTH)


@register("raw_by_source")
def _raw_by_source(lake: Lake) -> DataFrame:
    """Q14."""
    return Q.raw_by_source(lake.during(YEAR, MONTH).raw, RAW_SOURCE, YEAR, MONTH)


@register("source_quality")
def _source_quality(lake: Lake) -> DataFrame:
    """Q15."""
    return Q.source_quality(lake.during(YEAR, MONTH).processed, YEAR, MONTH)
