"""Zone readers and writers.

Schemas are always given: no inference pass over the input, and partition
values keep their declared types (raw ``year=2024`` stays the text
``'2024'``, a source named ``0456`` stays ``'0456'``).

Partitioned writes use a rebalance on the partition columns rather than a
plain ``repartition``: each partition value then lands in few files, and
when one value holds a large share of the rows, AQE splits its shuffle
partition across several tasks (and files) instead of one task writing it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake import schemas as S

LEGACY_PARTITION_RE = r"/year=(\d{4})/month=(\d{2})/day=(\d{2})/"


# ------------------------------------------------------------------ readers


def read_raw(spark: SparkSession, path: str, layout: str = "hive", multiline: bool = False) -> DataFrame:
    """The raw zone as ``RAW_TABLE`` rows.

    ``hive``: our layout ``source=<x>/year=YYYY/month=MM/day=DD/*.json``,
    JSON lines. ``legacy``: the reference's layout ``<x>/year=…/…`` with one
    pretty-printed object per file; read with ``multiLine`` and recursive
    lookup, partitions taken from the file path (partition discovery fails
    on that layout as soon as there are two sources)."""
    if layout == "hive":
        return (
            spark.read.schema(S.RAW_TABLE)
            .option("multiLine", multiline)
            .json(path)
            .select(*S.RAW_TABLE.fieldNames())
        )
    if layout == "legacy":
        df = (
            spark.read.schema(S.RAW_ENVELOPE)
            .option("multiLine", True)
            .option("recursiveFileLookup", True)
            .json(path)
        )
        p = F.col("_metadata.file_path")
        return df.select(
            *S.RAW_ENVELOPE.fieldNames(),
            F.regexp_extract(p, LEGACY_PARTITION_RE, 1).alias("year"),
            F.regexp_extract(p, LEGACY_PARTITION_RE, 2).alias("month"),
            F.regexp_extract(p, LEGACY_PARTITION_RE, 3).alias("day"),
        )
    raise ValueError(f"unknown raw layout {layout!r}")


def read_raw_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file, ``key`` (path below ``path``) and
    ``text`` (whole file), for validation. ``wholetext`` must be passed as
    an argument: as an option it is overridden and files are read line by
    line."""
    root = path.rstrip("/") + "/"
    df = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    fp = F.col("_metadata.file_path")
    # file_path is a URI (file:/…); keep the part below the root.
    rel = F.regexp_replace(fp, r"^.*?" + _regex_escape(root.split(":", 1)[-1]), "")
    return df.select(rel.alias("key"), F.col("value").alias("text"))


def _regex_escape(s: str) -> str:
    import re

    return re.escape(s)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """S3: the processed zone with its declared schema."""
    return spark.read.schema(S.PROCESSED).parquet(path).select(*S.PROCESSED.fieldNames())


def read_curated(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_raw_files(spark: SparkSession, root: str, files: list[str]) -> DataFrame:
    """S1 for some files of the raw zone ``root`` (hive layout)."""
    return spark.read.schema(S.RAW_TABLE).option("basePath", root).json(files).select(*S.RAW_TABLE.fieldNames())


def list_files(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """``path, length`` of the files below ``root``; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
            .load(root).select("path", "length"))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whatever store it names."""
    fs, p = _store(spark, path)
    return fs.exists(p)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder of a finished job."""
    fs, p = _store(spark, path)
    fs.delete(p, True)


def _store(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


# ------------------------------------------------------------------ writers


def _rebalanced(df: DataFrame, cols) -> DataFrame:
    return df.hint("rebalance", *cols) if cols else df


def write_raw(df: DataFrame, path: str, mode: str = "append", max_records_per_file: int = 1_000_000) -> None:
    """Raw envelopes as JSON lines below ``source=/year=/month=/day=``
    (many records per file, not one file per record)."""
    (
        _rebalanced(df.select(*S.RAW_TABLE.fieldNames()), S.RAW_PARTITIONS)
        .write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*S.RAW_PARTITIONS)
        .json(path)
    )


def write_processed(df: DataFrame, path: str, mode: str = "append", max_records_per_file: int = 5_000_000) -> None:
    """Processed rows as Parquet below ``source=/year=/month=/day=``."""
    (
        _rebalanced(df.select(*S.PROCESSED.fieldNames()), S.PROCESSED_PARTITIONS)
        .write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*S.PROCESSED_PARTITIONS)
        .parquet(path)
    )


def _write_overwrite(df: DataFrame, path: str, partitions: tuple, dynamic: bool) -> None:
    w = _rebalanced(df, partitions).write.mode("overwrite")
    if partitions:
        w = w.partitionBy(*partitions)
        if dynamic:
            # Replace only the partitions present in ``df``.
            w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_daily_summary(df: DataFrame, path: str, dynamic: bool = False) -> None:
    """Daily summary, overwritten, partitioned by source/year/month."""
    _write_overwrite(df.select(*S.DAILY_SUMMARY.fieldNames()), path, ("source", "year", "month"), dynamic)


def write_source_statistics(df: DataFrame, path: str) -> None:
    """Source statistics, overwritten, not partitioned; AQE sizes the
    files from the aggregate's output."""
    df.select(*S.SOURCE_STATISTICS.fieldNames()).write.mode("overwrite").parquet(path)


def write_hourly_metrics(df: DataFrame, path: str, dynamic: bool = False) -> None:
    """Hourly metrics, overwritten, partitioned by source."""
    _write_overwrite(df.select(*S.HOURLY_METRICS.fieldNames()), path, ("source",), dynamic)


def with_raw_key(df: DataFrame, ts_col: str = "received_at", source_col: str = "source") -> DataFrame:
    """Add the object ``key`` and the zero-padded ``year``/``month``/
    ``day`` partition values of a raw record."""
    from zonelake.functions.time import raw_key, raw_partition_values

    return df.select("*", raw_key(source_col, ts_col).alias("key"), *raw_partition_values(ts_col))


# --------------------------------------------------------------- catalog


def _ddl(schema, partitions) -> str:
    cols = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in partitions]
    parts = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name in partitions]
    return ", ".join(cols + parts)


def register_table(spark: SparkSession, name: str, path: str, schema, partitions: tuple = (),
                   fmt: str = "parquet") -> None:
    """An external catalog table over a zone folder, then partition
    repair (``MSCK REPAIR TABLE``) so partitions written by jobs become
    visible to SQL."""
    part = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(schema, partitions)}) USING {fmt}{part} LOCATION '{path}'"
    )
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def repair(spark: SparkSession, name: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")
