"""The zone tables of one scale-factor directory, as lazy plans.

``Lake`` turns the driver's tables into the raw, processed and curated zones
(see ``sources.tables`` for the mapping). Nothing is materialised: each
property is a DataFrame whose plan starts at the Parquet scan, so a query
over a curated table still reads, processes and aggregates the whole events
table, and Catalyst prunes the columns a query does not use.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.functions.time import period
from zonelake.operators.curate import daily_summary, hourly_metrics, source_statistics
from zonelake.operators.process import process
from zonelake.sources.tables import documents_to_raw, events_to_raw, load

# Fixed query parameters for the driver's tables (events span 2024-01-01 ..
# 2024-01-30). AS_OF replaces CURRENT_TIMESTAMP; at 00:30 on Jan 31 some
# sources are stale for more than 60 minutes and some are not.
YEAR = 2024
MONTH = 1
DAY = 15
AS_OF = "2024-01-31 00:30:00"
RAW_SOURCE = "click"


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str, hash_mode: str = "sha256",
                 span: tuple[str, str] | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.hash_mode = hash_mode
        self.span = span

    def during(self, year: int, month: int, day: int | None = None) -> Lake:
        """The lake of one month or day. A predicate on year, month and day,
        which are derived from the time, becomes a range of the time itself,
        which the scan can use to skip files and row groups. (Copies share
        their time, so deduplication within a range is that of the whole.)"""
        return Lake(self.spark, self.sf_dir, self.hash_mode, period(year, month, day))

    def table(self, name: str) -> DataFrame:
        df = load(self.spark, self.sf_dir, name)
        if self.span and name == "events":
            start, end = (F.lit(t).cast("timestamp_ntz") for t in self.span)
            df = df.where((F.col("ts") >= start) & (F.col("ts") < end))
        return df

    @cached_property
    def raw(self) -> DataFrame:
        return events_to_raw(self.table("events"))

    @cached_property
    def processed(self) -> DataFrame:
        return process(self.raw, processing_time="_processing_ts", hash_mode=self.hash_mode)

    @cached_property
    def document_raw(self) -> DataFrame:
        return documents_to_raw(self.table("documents"))

    @cached_property
    def document_processed(self) -> DataFrame:
        return process(self.document_raw, processing_time="_processing_ts", hash_mode=self.hash_mode)

    @cached_property
    def daily_summary(self) -> DataFrame:
        return daily_summary(self.processed)

    @cached_property
    def source_statistics(self) -> DataFrame:
        return source_statistics(self.processed)

    @cached_property
    def hourly_metrics(self) -> DataFrame:
        return hourly_metrics(self.processed)
