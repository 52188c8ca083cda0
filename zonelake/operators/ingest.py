"""Ingestion (I1-I7) and batch ingestion (D1) as DataFrame jobs.

The reference answers one HTTP request at a time. Here a DataFrame of request
bodies is classified in one projection: each row gets the status code and
error text the handler would answer, and accepted rows become raw envelopes
(``accepted``) while every row yields an outcome row (``outcomes``). There is
no shuffle; the work is a per-row column expression inside whole-stage
codegen.

Status rules, in the handler's order (fixed values, they must equal the
reference's answers):

* body text that is not exactly one JSON value -> 400
  ``Invalid JSON in request body``
* a JSON object without the key ``source`` or ``data`` -> 400
  ``Missing required fields: source and data``; key presence is what counts,
  a present JSON null passes
* a JSON array or string body: the handler's membership test looks at the
  array's elements or the string's substrings; when both words are found the
  next step fails -> 500, else -> 400 missing fields
* a number, boolean or null body -> 500 ``Internal server error`` (the
  membership test raises)
* an object whose ``source`` is not a string -> 500 (object metadata must be
  strings)
* our own rule: an empty ``source`` -> 400 ``Empty source``
* otherwise -> 200; ``metadata`` defaults to ``{}`` when absent, an explicit
  null stays null
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelake.functions.json import field, kind, strict_json, variant_string
from zonelake.functions.time import iso_text, raw_key, utc_now
from zonelake.functions.util import as_col

# Response texts of the reference handler.
ERR_INVALID_JSON = "Invalid JSON in request body"
ERR_MISSING_FIELDS = "Missing required fields: source and data"
ERR_INTERNAL = "Internal server error"
# Our additions.
ERR_EMPTY_SOURCE = "Empty source"
ERR_BATCH_TOO_LARGE = "Batch too large"

OUTCOME_COLUMNS = ("request_id", "item", "status_code", "error", "key", "source", "ts")


def _contains_string(arr: Column, word: str) -> Column:
    """Python ``word in list`` over the array's elements as text: a
    non-string element's text (digits, ``true``, JSON of a container) can
    never equal a plain word, so this is exact. ``array_contains`` keeps the
    projection inside whole-stage codegen (a lambda would not)."""
    return F.coalesce(F.array_contains(arr, F.lit(word)), F.lit(False))


CLASSIFIED_COLUMNS = ("status_code", "error", "key", "source", "ts", "ingestion_timestamp",
                      "metadata", "data", "year", "month", "day")


def classify_parsed(df: DataFrame, v: str = "_v", ts: str = "_ts", keep: tuple = (),
                    reject: str | None = None) -> DataFrame:
    """Classification of parsed bodies: ``v`` is the body as VARIANT (SQL
    NULL when the text did not parse), ``ts`` the receive time. Returns
    ``keep`` + ``CLASSIFIED_COLUMNS``. ``reject``: optional column holding a
    (status, error) struct that overrides the rules (batch limits).

    Staged projections compute each member lookup and kind test once per
    row; the result row is emitted through ``inline`` so that a filter on
    ``status_code`` stays above it instead of being pushed down and
    re-evaluating the classification inline."""
    keep = list(keep) + ([reject] if reject else [])
    s1 = df.select(
        *keep, F.col(ts).cast("timestamp_ntz").alias("_t"), F.col(v).alias("_v"),
        kind(v).alias("_k"),
        field(v, "source").alias("_srcv"),
        field(v, "data").alias("_data"),
        field(v, "metadata").alias("_meta"),
    )
    k, srcv = F.col("_k"), F.col("_srcv")
    arr = F.when(k == "ARRAY", F.try_variant_get(F.col("_v"), "$", "array<string>"))
    s = F.when(k == "STRING", F.try_variant_get(F.col("_v"), "$", "string"))
    s2 = s1.select(
        *keep, "_t", "_k", "_data", "_meta",
        (k == "OBJECT").alias("_obj"),
        F.col("_v").isNull().alias("_bad"),
        (srcv.isNotNull() & F.col("_data").isNotNull()).alias("_both"),
        variant_string(srcv).alias("_src"),
        (_contains_string(arr, "source") & _contains_string(arr, "data")).alias("_arr_both"),
        (s.contains("source") & s.contains("data")).alias("_str_both"),
    )
    obj, src = F.col("_obj"), F.col("_src")
    status = (
        F.when(F.col("_bad"), F.lit(400))
        .when(obj & ~F.col("_both"), F.lit(400))
        .when(obj & src.isNull(), F.lit(500))
        .when(obj & (src == ""), F.lit(400))
        .when(obj, F.lit(200))
        .when(F.col("_k") == "ARRAY", F.when(F.col("_arr_both"), F.lit(500)).otherwise(F.lit(400)))
        .when(F.col("_k") == "STRING", F.when(F.col("_str_both"), F.lit(500)).otherwise(F.lit(400)))
        .otherwise(F.lit(500))
    )
    error = (
        F.when(F.col("_bad"), F.lit(ERR_INVALID_JSON))
        .when(F.col("_status") == 500, F.lit(ERR_INTERNAL))
        .when(obj & F.col("_both") & (src == ""), F.lit(ERR_EMPTY_SOURCE))
        .when(F.col("_status") == 400, F.lit(ERR_MISSING_FIELDS))
    )
    if reject:
        status = F.coalesce(F.col(f"{reject}.status_code"), status)
    s3 = s2.select(*keep, "_t", "_data", "_meta", "_obj", "_src", "_both", "_bad", status.alias("_status"))
    if reject:
        error = F.when(F.col(f"{reject}.status_code").isNotNull(), F.col(f"{reject}.error")).otherwise(error)
    t = F.col("_t")
    ok = F.col("_status") == 200
    key = F.when(ok, raw_key(src, t))
    metadata = F.when(ok, F.when(F.col("_meta").isNull(), F.parse_json(F.lit("{}"))).otherwise(F.col("_meta")))
    row = F.struct(
        F.col("_status").alias("status_code"),
        error.alias("error"),
        key.alias("key"),
        F.when(obj, src).alias("source"),
        t.alias("ts"),
        F.when(ok, iso_text(t)).alias("ingestion_timestamp"),
        metadata.alias("metadata"),
        F.when(ok, F.col("_data")).alias("data"),
        F.when(ok, F.date_format(t, "yyyy")).alias("year"),
        F.when(ok, F.date_format(t, "MM")).alias("month"),
        F.when(ok, F.date_format(t, "dd")).alias("day"),
    )
    kept = [c for c in keep if c != reject]
    return s3.select(*kept, F.inline(F.array(row)))


def _received(requests: DataFrame, received_at) -> Column:
    if received_at is None:
        return utc_now()
    if isinstance(received_at, str):
        return F.col(received_at).cast("timestamp_ntz")
    return as_col(received_at).cast("timestamp_ntz")


def _request_id(requests: DataFrame, request_id) -> Column:
    if request_id is not None and request_id in requests.columns:
        return F.col(request_id).cast("string")
    return F.lit(None).cast("string")


def classify(requests: DataFrame, body: str = "body", received_at: str | None = "received_at",
             request_id: str | None = "request_id") -> DataFrame:
    """One classified row per request body.

    A NULL ``body`` counts as an absent body field, which the handler reads
    as ``{}`` (-> 400 missing fields)."""
    text = F.coalesce(F.col(body).cast("string"), F.lit("{}"))
    ts = _received(requests, received_at if received_at in requests.columns else None)
    parsed = requests.select(
        _request_id(requests, request_id).alias("request_id"),
        F.lit(None).cast("int").alias("item"),
        strict_json(text).alias("_v"),
        ts.alias("_ts"),
    )
    return classify_parsed(parsed, keep=("request_id", "item"))


def accepted(classified: DataFrame) -> DataFrame:
    """Raw envelope rows (with raw partition columns) of accepted requests."""
    return classified.filter(F.col("status_code") == 200).select(
        "ingestion_timestamp", "source", "metadata", "data", "year", "month", "day"
    )


def outcomes(classified: DataFrame) -> DataFrame:
    """One outcome row per request (or batch item): status, error text,
    object key and time."""
    return classified.select(*OUTCOME_COLUMNS)


class Ingested(NamedTuple):
    accepted: DataFrame
    outcomes: DataFrame


def ingest(requests: DataFrame, body: str = "body", received_at: str | None = "received_at",
           request_id: str | None = "request_id") -> Ingested:
    """Classify request bodies; returns (accepted raw envelopes, outcomes).

    Both frames share one lazy plan; a job that writes both should write
    ``classified`` once (or checkpoint it) when re-reading the input twice
    costs more than the extra write."""
    c = classify(requests, body, received_at, request_id)
    return Ingested(accepted(c), outcomes(c))


def batch_classify(requests: DataFrame, body: str = "body", received_at: str | None = "received_at",
                   request_id: str | None = "request_id", *, max_items: int | None) -> DataFrame:
    """Batch ingestion. A body that is a JSON array is a batch of items;
    each item is classified as a body of its own and gets its position in
    ``item``. A batch with more than ``max_items`` items is rejected whole
    (413 ``Batch too large``); an empty batch yields one 400 row. A body that
    is not an array is a single item with ``item`` NULL.

    With ``max_items=None`` batches of any size are taken."""
    text = F.coalesce(F.col(body).cast("string"), F.lit("{}"))
    ts = _received(requests, received_at if received_at in requests.columns else None)
    parsed = requests.select(
        _request_id(requests, request_id).alias("request_id"),
        strict_json(text).alias("_v"),
        ts.alias("_ts"),
    )
    arr = F.try_variant_get(F.col("_v"), "$", "array<variant>")
    n = F.size(arr)
    within = F.lit(True) if max_items is None else n <= max_items
    is_batch = (kind("_v") == "ARRAY") & (n >= 1) & within
    too_large = (kind("_v") == "ARRAY") & ~within
    # Non-batches explode a one-element array holding the body itself.
    items = F.when(is_batch, arr).otherwise(F.array(F.col("_v")))
    reject = F.when(too_large, F.struct(F.lit(413).alias("status_code"), F.lit(ERR_BATCH_TOO_LARGE).alias("error")))
    exploded = parsed.select(
        "request_id", "_ts", reject.alias("_reject"), is_batch.alias("_is_batch"),
        F.posexplode(items).alias("_pos", "_item"),
    ).withColumn("item", F.when(F.col("_is_batch"), F.col("_pos").cast("int")))
    return classify_parsed(exploded, v="_item", keep=("request_id", "item"), reject="_reject")


def batch_summary(batch_outcomes: DataFrame) -> DataFrame:
    """Per request: item count, accepted and rejected items, and the overall
    status (200 all accepted, 207 partial, else the first item's code)."""
    return batch_outcomes.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.col("status_code") == 200).alias("accepted"),
        F.count_if(F.col("status_code") != 200).alias("rejected"),
        F.min_by("status_code", F.coalesce(F.col("item"), F.lit(0))).alias("first_status"),
    ).select(
        "request_id", "items", "accepted", "rejected",
        F.when(F.col("rejected") == 0, F.lit(200))
        .when(F.col("accepted") > 0, F.lit(207))
        .otherwise(F.col("first_status")).alias("status_code"),
    )
