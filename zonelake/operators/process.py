"""Raw -> processed.

``process`` is one lazy plan: null filter, canonical payload text,
fingerprint, deduplication, date partitions and quality score. The only
shuffle is the deduplication; it is a grouped aggregate, so every map task
combines its own copies before the shuffle and a key holding a third of all
rows still arrives as one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from zonelake.functions.json import canonical_json, fingerprint
from zonelake.functions.time import parse_date, utc_now
from zonelake.functions.util import ts_literal

DEDUP_KEYS = ("ingestion_timestamp", "source", "record_hash")

PROCESSED_COLUMNS = (
    "ingestion_timestamp",
    "metadata",
    "data",
    "processing_timestamp",
    "record_hash",
    "ingestion_date",
    "quality_score",
    "source",
    "year",
    "month",
    "day",
)


def _processing_time(raw: DataFrame, processing_time) -> Column:
    if processing_time is None:
        return utc_now()
    if isinstance(processing_time, str) and processing_time in raw.columns:
        return F.col(processing_time).cast("timestamp_ntz")
    return ts_literal(processing_time)


def canonicalize(raw: DataFrame, processing_time=None, hash_mode: str = "sha256") -> DataFrame:
    """Drop rows without data, source or timestamp; canonical JSON
    text for data and metadata; processing time; record hash.

    ``data`` that is JSON null counts as missing (the reference's reader
    turns it into NULL)."""
    # Filter on the VARIANT (cheap null tests) before serialising, so the
    # optimizer does not copy the canonical-text expression into the filter.
    kept = raw.filter(
        F.col("data").isNotNull() & ~F.is_variant_null("data")
        & F.col("source").isNotNull() & F.col("ingestion_timestamp").isNotNull()
    )
    df = kept.select(
        F.col("ingestion_timestamp").cast("string").alias("ingestion_timestamp"),
        F.col("source").cast("string").alias("source"),
        canonical_json("metadata").alias("metadata"),
        F.to_json("data").alias("data"),
        _processing_time(raw, processing_time).alias("processing_timestamp"),
    )
    return df.withColumn("record_hash", fingerprint("data", hash_mode))


def deduplicate(df: DataFrame, keys=DEDUP_KEYS) -> DataFrame:
    """One row per (ingestion_timestamp, source, record_hash).

    The survivor is deterministic: the copy with the smallest metadata text,
    metadata NULL last, then the earliest processing time. Implemented as a
    grouped ``min`` over a struct, which Spark aggregates partially on the
    map side (skew-safe), rather than a window, which would sort a hot key
    inside one task."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [F.col("metadata").isNull().alias("_meta_null")] if "metadata" in rest else []
    best = F.min(F.struct(*order, *[F.col(c) for c in rest])).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])


def add_partitions(df: DataFrame) -> DataFrame:
    """P5: ingestion date and integer year/month/day. Unparsable timestamps
    give NULL (see ``quarantine``)."""
    d = parse_date("ingestion_timestamp")
    return (
        df.withColumn("ingestion_date", d)
        .withColumn("year", F.year(d))
        .withColumn("month", F.month(d))
        .withColumn("day", F.dayofmonth(d))
    )


def add_quality_score(df: DataFrame) -> DataFrame:
    """100 when metadata is present (``{}`` included), else 80."""
    return df.withColumn("quality_score", F.when(F.col("metadata").isNotNull(), F.lit(100)).otherwise(F.lit(80)))


class StageCounts:
    """The three stage counts of the reference (initial, after the null
    filter, after dedup), gathered with ``observe`` during the one write
    instead of three extra actions over the input."""

    def __init__(self):
        self._raw = Observation()
        self._out = Observation()

    def observe_raw(self, raw: DataFrame) -> DataFrame:
        kept = (F.col("data").isNotNull() & ~F.is_variant_null("data")
                & F.col("source").isNotNull() & F.col("ingestion_timestamp").isNotNull())
        return raw.observe(self._raw, F.count(F.lit(1)).alias("initial"),
                           F.count_if(kept).alias("after_null_filter"))

    def observe_out(self, df: DataFrame) -> DataFrame:
        return df.observe(self._out, F.count(F.lit(1)).alias("after_dedup"))

    def get(self) -> dict:
        return {**self._raw.get, **self._out.get}


def process(raw: DataFrame, processing_time=None, hash_mode: str = "sha256",
            counts: StageCounts | None = None) -> DataFrame:
    """P1-P6 as one plan; returns the processed schema (rows with an
    unparsable timestamp included, with NULL partitions).

    ``processing_time``: None for ``current_timestamp()``, a column name of
    ``raw``, a datetime/ISO text, or a Column. ``counts`` (P7) is filled in
    when the returned plan runs."""
    src = counts.observe_raw(raw) if counts is not None else raw
    df = canonicalize(src, processing_time, hash_mode)
    df = deduplicate(df)
    df = add_partitions(df)
    df = add_quality_score(df)
    out = df.select(*PROCESSED_COLUMNS)
    return counts.observe_out(out) if counts is not None else out


def valid_rows(processed: DataFrame) -> DataFrame:
    return processed.filter(F.col("ingestion_date").isNotNull())


def quarantine(processed: DataFrame) -> DataFrame:
    """Rows whose ingestion timestamp has no date; kept apart instead of
    landing in a NULL partition."""
    return processed.filter(F.col("ingestion_date").isNull())


NEW_ROW_KEYS = ("source", "year", "month", "day", "ingestion_timestamp", "record_hash")


PARTITION_KEYS = ("source", "year", "month", "day")


def exclude_existing(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of ``batch`` not yet in the processed table ``existing``
    (dedup across runs; the reference dedups within one run only).

    The target is first restricted to the partitions the batch touches (a
    semi-join with the batch's distinct partition values, a small side, so
    dynamic partition pruning cuts the scan of ``existing`` to those
    partitions), then the batch is anti-joined with it on the dedup key plus
    the partition columns. ``batch`` must hold valid rows only
    (``valid_rows``): no key column is NULL there."""
    keys = list(NEW_ROW_KEYS)
    parts = list(PARTITION_KEYS)
    touched = batch.select(*parts).distinct()
    target = existing.select(*keys).join(touched, parts, "left_semi")
    return batch.join(target, keys, "left_anti")
