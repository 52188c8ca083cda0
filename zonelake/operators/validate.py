"""Validation of raw documents (V1-V11) and validation metrics.

The reference reads one landed file at a time and checks its payload with a
JSON-Schema validator. Here a DataFrame of documents (``key``, ``text``) is
checked in one chain of projections. Schemas are rule rows (``rules.py``): a
document is joined with the rules of its source's schema and evaluates those
only, on the VARIANT payload, with no Python on the executors. The rule tables
are configuration and small, so the joins broadcast them by their size.

Per document the reference does, in order (fixed behaviour to match):

1. parse the file; a failure -> status ``error``
2. ``source`` = the document's ``source``, ``'unknown'`` when absent; a
   document that is not an object -> ``error`` (``.get`` fails)
3. no ``data`` key -> ``invalid`` with the single error ``Missing 'data'
   field``
4. a source that is a list or object cannot be looked up -> ``error``
5. when a schema is registered for the source: the best schema error
   (shallowest instance path first, then the validator's keyword order)
   -> ``Schema validation failed: <message>``
6. an ``ingestion_timestamp`` that is a string Python's ``fromisoformat``
   rejects -> ``Invalid timestamp format``; one that is not a string ->
   ``error``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.functions.json import field, py_type_name_of_kind, strict_json, top_kind
from zonelake.functions.pytext import json_string
from zonelake.functions.time import is_python_isoformat, iso_text, parse_ts, raw_partition_values
from zonelake.operators.rules import RuleSet, rule_errors, rule_set, with_rules
from zonelake.schemas import SOURCE_SCHEMAS

# Message texts of the reference validator.
ERR_MISSING_DATA = "Missing 'data' field"
ERR_BAD_TIMESTAMP = "Invalid timestamp format"
SCHEMA_PREFIX = "Schema validation failed: "
ALERT_SUBJECT = "Data Validation Failure"
# Ours: the text of an unreadable document (Python's decoder messages carry
# positions we do not reproduce).
ERR_INVALID_JSON = "Invalid JSON"

RESULT_COLUMNS = ("key", "status", "source", "errors", "error", "ts", "all_errors")


def validate(documents: DataFrame, key: str = "key", text: str = "text", schemas: dict | None = None,
             rules: RuleSet | None = None, keep: tuple = ()) -> DataFrame:
    """V1-V9: one result row per document: key, status (valid / invalid /
    error), source, errors (invalid rows: the one best schema error, then the
    timestamp error), error (error rows), the document's ingestion time
    (``ts``, NULL when absent or unparsable), ``all_errors`` (invalid rows:
    every error, in the order of the checks) and the input's columns ``keep``.

    ``rules`` says which schema a source has; without it ``schemas`` are looked
    up by exact name. Built as a chain of projections, each naming its columns,
    so every parse, path lookup and kind test runs once per row (an inlined
    expression tree would repeat them for every use)."""
    rules = rules or rule_set(SOURCE_SCHEMAS if schemas is None else schemas)
    kept = [F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)]
    kept_names = [f"_keep{i}" for i in range(len(keep))]

    # 1. parse; 2. the document's members; 3. their kinds
    s1 = documents.select(F.col(key).cast("string").alias("key"), F.col(text).alias("_text"),
                          strict_json(F.col(text)).alias("_d"), *kept)
    s2 = s1.select("key", "_text", *kept_names, top_kind("_d").alias("_dk"), field("_d", "source").alias("_src"),
                   field("_d", "ingestion_timestamp").alias("_tsv"), field("_d", "data").alias("_data"))
    s3 = s2.select("key", "_text", *kept_names, "_dk", "_src", "_tsv", "_data",
                   top_kind("_src").alias("_sk"), top_kind("_tsv").alias("_tk"), top_kind("_data").alias("_pk"))
    sk, tk, dk = F.col("_sk"), F.col("_tk"), F.col("_dk")
    s4 = s3.select(
        "key", "_text", *kept_names, "_dk", "_sk", "_tk", "_data", "_pk",
        F.when(sk == "STRING", F.try_variant_get(F.col("_src"), "$", "string")).alias("_src_text"),
        F.when(sk.isNotNull() & ~sk.isin("STRING", "VOID"), F.to_json("_src")).alias("_src_json"),
        F.when(tk == "STRING", F.try_variant_get(F.col("_tsv"), "$", "string")).alias("_ts_text"),
    )
    # 4. the schema's errors and the timestamp rule
    is_obj = F.col("_dk") == "OBJECT"
    s5 = with_rules(s4, rules).select(
        "key", *kept_names, "_dk", "_sk", "_tk", "_src_text", "_src_json", "_ts_text",
        F.col("_data").isNotNull().alias("_has_data"),
        F.when(F.col("_rules").isNotNull() & F.col("_data").isNotNull(),
               rule_errors(F.col("_data"), F.col("_pk"), F.col("_text"), F.col("_rules"))).alias("_failed"),
        (tk.isNotNull() & (tk == "STRING") & ~is_python_isoformat(F.col("_ts_text"))).alias("_bad_ts"),
    )
    # 5. outcome. Best error: shallowest instance path, then rule order.
    failed, has_data = F.col("_failed"), F.col("_has_data")
    none = F.array().cast("array<string>")
    late = F.when(F.coalesce(F.col("_bad_ts"), F.lit(False)), F.array(F.lit(ERR_BAD_TIMESTAMP))).otherwise(none)
    listed = F.coalesce(F.transform(failed, lambda e: F.concat(F.lit(SCHEMA_PREFIX), e["message"])), none)
    best = F.when(F.size(failed) > 0, F.array(F.concat(F.lit(SCHEMA_PREFIX), F.array_min(failed)["message"]))).otherwise(none)
    error_text = (
        F.when(dk.isNull(), F.lit(ERR_INVALID_JSON))
        .when(~is_obj, F.concat(F.lit("'"), py_type_name_of_kind(dk), F.lit("' object has no attribute 'get'")))
        .when(~has_data, F.lit(None).cast("string"))
        .when(sk.isin("ARRAY", "OBJECT"), F.concat(F.lit("unhashable type: '"), py_type_name_of_kind(sk), F.lit("'")))
        .when(tk.isNotNull() & (tk != "STRING"), F.lit("fromisoformat: argument must be str"))
    )
    # The source as the reference reports it: its text when a string,
    # 'unknown' when absent, NULL for a JSON null, else its JSON text.
    source = (
        F.when(~F.coalesce(is_obj, F.lit(False)), F.lit(None).cast("string"))
        .when(sk.isNull(), F.lit("unknown"))
        .otherwise(F.coalesce(F.col("_src_text"), F.col("_src_json")))
    )
    s6 = s5.select("key", *kept_names, source.alias("source"), F.concat(best, late).alias("_errors"),
                   F.concat(listed, late).alias("_all"), error_text.alias("error"),
                   has_data.alias("_has_data"), "_ts_text")
    has_errors = F.size("_errors") > 0
    status = (
        F.when(F.col("error").isNotNull(), F.lit("error"))
        .when(~F.col("_has_data") | has_errors, F.lit("invalid"))
        .otherwise(F.lit("valid"))
    )

    def of_invalid(errors: str) -> Column:
        return (
            F.when(F.col("error").isNotNull(), F.lit(None).cast("array<string>"))
            .when(~F.col("_has_data"), F.array(F.lit(ERR_MISSING_DATA)))
            .when(has_errors, F.col(errors))
        )

    # The result row is emitted through ``inline`` of a one-element array.
    # A filter on the result (``status = 'invalid'``) then stays above the
    # generator and reads the computed columns; without it Catalyst pushes
    # the filter below the projections, substituting the whole validation
    # expression tree into the condition, where it is evaluated again for
    # every reference (seconds per thousand rows instead of milliseconds).
    row = F.struct(
        F.col("key"),
        status.alias("status"),
        F.col("source"),
        of_invalid("_errors").alias("errors"),
        F.col("error"),
        parse_ts("_ts_text").alias("ts"),
        of_invalid("_all").alias("all_errors"),
        *[F.col(n).alias(c) for n, c in zip(kept_names, keep)],
    )
    return s6.select(F.inline(F.array(row)))


def write_split(results: DataFrame, path: str) -> None:
    """V9: validated documents (``validate(..., keep=("text",))``) in one write,
    below ``status=valid|invalid|error``: one evaluation, three readable
    outputs. The path is replaced."""
    results.hint("rebalance", "status").write.mode("overwrite").partitionBy("status").parquet(path)


def read_split(spark: SparkSession, path: str, status: str) -> DataFrame:
    """One output of ``write_split``."""
    return spark.read.parquet(path).where(F.col("status") == status)


def valid_envelopes(valid: DataFrame) -> DataFrame:
    """The valid documents (``text``, ``source``, ``ts``) as raw records, for
    the raw -> processed job: this is how valid data moves on. Documents that
    are valid without an ingestion time have no raw partition and stay out."""
    d = strict_json(F.col("text"))
    parts = raw_partition_values("ts")
    return valid.where(F.col("ts").isNotNull()).select(
        iso_text("ts").alias("ingestion_timestamp"), "source", field(d, "metadata").alias("metadata"),
        field(d, "data").alias("data"), *parts)


def summary(results: DataFrame) -> DataFrame:
    """Documents per status (the run's ``processed`` count is the sum)."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("documents"))


def alerts(results: DataFrame) -> DataFrame:
    """One alert row per invalid document (error rows raise none):
    subject, key and the message text the reference would publish, with the
    error list as JSON (ASCII only) indented by two spaces."""
    quoted = F.transform("errors", json_string)
    listing = F.concat(F.lit("[\n  "), F.array_join(quoted, ",\n  "), F.lit("\n]"))
    return results.filter(F.col("status") == "invalid").select(
        F.lit(ALERT_SUBJECT).alias("subject"),
        "key",
        F.concat(F.lit("Validation failed for "), F.col("key"), F.lit("\nErrors: "), listing).alias("message"),
    )


def metrics(results: DataFrame) -> DataFrame:
    """Per source and hour of the document's ingestion time: valid,
    invalid and error counts, failure rate and the most frequent failure
    text (ties broken by the smallest text).

    Two aggregations, both combined map-side: one per (source, hour,
    failure text), then one per (source, hour) over that small result."""
    failure = F.coalesce(F.col("errors")[0], F.col("error"))
    per_text = results.groupBy(
        "source", F.date_trunc("HOUR", F.col("ts")).cast("timestamp_ntz").alias("hour"), failure.alias("failure")
    ).agg(
        F.count_if(F.col("status") == "valid").alias("valid"),
        F.count_if(F.col("status") == "invalid").alias("invalid"),
        F.count_if(F.col("status") == "error").alias("error"),
    )
    n_fail = F.col("invalid") + F.col("error")
    agg = per_text.groupBy("source", "hour").agg(
        F.sum("valid").alias("valid"),
        F.sum("invalid").alias("invalid"),
        F.sum("error").alias("errors"),
        F.min_by("failure", F.when(F.col("failure").isNotNull(),
                                   F.struct((-n_fail).alias("n"), F.col("failure").alias("t")))).alias("top_error"),
    )
    total = F.col("valid") + F.col("invalid") + F.col("errors")
    return agg.select(
        "source", "hour", "valid", "invalid", "errors",
        ((F.col("invalid") + F.col("errors")) / total).alias("failure_rate"),
        "top_error",
    )
