"""Schema discovery (D2), schema drift (D3) and data-quality measures.

All are grouped aggregates over payload columns, combined map-side before the
shuffle; their results are small (per source, path and kind, or per source,
day and rule), so the joins between them are joins of small tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelake.functions.json import kind, top_kind
from zonelake.operators.rules import ACCEPTS, schema_of
from zonelake.session import scratch_path


def discover_schema(raw: DataFrame, payload: str = "data") -> DataFrame:
    """Per source, the merged schema of all payloads (conflicting
    types widen to VARIANT) and the number of payloads seen."""
    return raw.groupBy("source").agg(
        F.schema_of_variant_agg(F.col(payload)).alias("payload_schema"),
        F.count(F.col(payload)).alias("payloads"),
    )


def field_profile(raw: DataFrame, payload: str = "data") -> DataFrame:
    """D2, flat form: per source, top-level payload field and JSON kind, the
    number of payloads that carry it. Non-object payloads are counted
    under field NULL with their own kind."""
    p = F.col(payload)
    kinds = raw.select("source", p.alias("_p"), kind(p).alias("_pk"))
    members = F.when(F.col("_pk") == "OBJECT", F.try_variant_get(F.col("_p"), "$", "map<string,variant>"))
    rows = kinds.select("source", "_pk", F.explode_outer(F.map_entries(members)).alias("_m"))
    # Rows without a payload are dropped after the aggregation: a filter on
    # the payload kind here would be pushed below the projections and
    # repeat the payload expression inline.
    return (
        rows.select(
            "source",
            F.col("_m.key").alias("field"),
            F.when(F.col("_m").isNull(), F.col("_pk")).otherwise(kind(F.col("_m.value"))).alias("kind"),
        )
        .groupBy("source", "field", "kind")
        .agg(F.count(F.lit(1)).alias("records"))
        .filter(F.col("kind").isNotNull())
    )


NAME = r"^[A-Za-z_][A-Za-z0-9_]*$"
LEVELS = 3


def _child_path(path: Column, name: Column) -> Column:
    quoted = F.concat(F.lit("['"), F.replace(F.replace(name, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("']"))
    return F.concat(path, F.when(F.regexp_like(name, F.lit(NAME)), F.concat(F.lit("."), name)).otherwise(quoted))


def _opened(rows: DataFrame) -> DataFrame:
    """One level deeper: an open container becomes itself, closed, and its
    members, open if they are containers (``source, path, kind, v``; ``v`` is
    NULL once a row is closed)."""
    v, path, k = F.col("v"), F.col("path"), F.col("kind")
    part = lambda p, value: F.struct(p.alias("path"), F.lit(None).cast("string").alias("kind"), value.alias("v"))
    itself = F.array(F.struct(path.alias("path"), k.alias("kind"), F.lit(None).cast("variant").alias("v")))
    members = F.transform(F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")),
                          lambda e: part(_child_path(path, e["key"]), e["value"]))
    elements = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: part(F.concat(path, F.lit("[*]")), x))
    rows = rows.select("source", F.inline(
        F.when(v.isNotNull() & (k == "OBJECT"), F.concat(itself, members))
        .when(v.isNotNull(), F.concat(itself, elements)).otherwise(itself)))
    rows = rows.select("source", "path", F.coalesce("kind", top_kind("v")).alias("kind"), "v")
    return rows.select("source", "path", "kind", F.when(F.col("kind").isin("OBJECT", "ARRAY"), F.col("v")).alias("v"))


def payload_paths(raw: DataFrame, payload: str = "data", levels: int = LEVELS) -> DataFrame:
    """Every path of the payloads, to any depth: ``source, path, kind, values``
    (``$`` is the payload, ``.name`` a member, ``[*]`` the elements of an
    array; ``values`` counts the values met there with that kind).

    ``levels`` levels are opened in one plan and counted; only if containers
    are left below them, these alone are written and opened further."""
    spark = raw.sparkSession
    rows = raw.where(F.col(payload).isNotNull()).select(
        F.col("source"), F.lit("$").alias("path"), top_kind(payload).alias("kind"), F.col(payload).alias("v"))
    rows = rows.select("source", "path", "kind", F.when(F.col("kind").isin("OBJECT", "ARRAY"), F.col("v")).alias("v"))
    found = []
    while True:
        for _ in range(levels):
            rows = _opened(rows)
        is_open = F.col("v").isNotNull()
        counts = rows.groupBy("source", "path", "kind").agg(
            F.count_if(~is_open).alias("values"), F.count_if(is_open).alias("open"))
        found.append(_stored(counts, "paths"))
        if found[-1].where("open > 0").isEmpty():
            break
        rows = _stored(rows.where(is_open), "deeper")
    total = reduce(DataFrame.unionByName, found)
    return total.groupBy("source", "path", "kind").agg(F.sum("values").alias("values")).where("values > 0")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def member(path: str, name: str) -> str:
    """The path of a member as ``payload_paths`` writes it."""
    if name.isascii() and name.isidentifier():
        return f"{path}.{name}"
    escaped = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"{path}['{escaped}']"


def declared_paths(schemas: Mapping[str, Mapping]) -> list[tuple[str, str, str]]:
    """(schema, path, JSON-Schema type) of every declared property, any depth."""
    out = []

    def walk(name: str, sub: Mapping, path: str) -> None:
        if "type" in sub:
            out.append((name, path, sub["type"]))
        for p, below in sub.get("properties", {}).items():
            walk(name, below, member(path, p))

    for name, schema in schemas.items():
        walk(name, schema, "$")
    return out


def schema_diff(paths: DataFrame, schemas: Mapping[str, Mapping], matches=None) -> DataFrame:
    """D3: discovered payload paths (``payload_paths``) against the registered
    schemas, for every source that has one (``matches`` as in ``rule_set``) and
    for schemas whose own name was never seen as a source.

    One row per change: ``added`` (a path the schema does not declare;
    compatible), ``removed`` (declared, never seen; breaking) and
    ``type_changed`` (seen with a kind the declared type rejects; breaking),
    with the number of values showing it."""
    spark = paths.sparkSession
    matches = [(n, "exact", n) for n in schemas] if matches is None else list(matches)
    seen = paths.withColumn("schema", schema_of(F.col("source"), matches)).where("schema is not null")
    declared = spark.createDataFrame(declared_paths(schemas), "schema string, path string, declared string")
    named = spark.createDataFrame([(p, n) for n, m, p in matches if m == "exact"], "source string, schema string")
    # every side is an aggregate per source and path
    expected = seen.select("source", "schema").unionByName(named).distinct().join(declared, "schema")
    both = seen.join(expected, ["source", "schema", "path"], "full_outer")
    accepted = F.coalesce(*(F.when(F.col("declared") == t, F.col("kind").isin(*kinds)) for t, kinds in ACCEPTS.items()))
    change = (
        F.when(F.col("declared").isNull(), F.lit("added"))
        .when(F.col("kind").isNull(), F.lit("removed"))
        .when(~accepted, F.lit("type_changed"))
    )
    return (
        both.select("source", "path", change.alias("change"), "declared", "kind",
                    F.coalesce(F.col("values"), F.lit(0).cast("bigint")).alias("values"))
        .filter(F.col("change").isNotNull())
        .withColumn("breaking", F.col("change") != "added")
    )


class QualityRule(NamedTuple):
    """A measure as data: ``condition`` is a SQL expression over a record, a
    record passes where it is true; a group is in order if at least ``least``
    of its records pass."""

    measure: str
    field: str
    condition: str
    least: float


def quality_rules(max_lag_seconds: int = 86400) -> list[QualityRule]:
    """Completeness of each envelope field, accuracy by the payload's
    validation status, consistency of partition and time, timeliness."""
    age = "timestampdiff(SECOND, try_cast(ingestion_timestamp as timestamp_ntz), processing_timestamp)"
    return [
        *(QualityRule("completeness", f, f"{f} is not null", 0.9)
          for f in ("ingestion_timestamp", "source", "metadata", "data")),
        QualityRule("accuracy", "data", "status = 'valid'", 0.5),
        QualityRule("consistency", "ingestion_timestamp",
                    "partition_date = to_date(try_cast(ingestion_timestamp as timestamp_ntz))", 0.95),
        QualityRule("timeliness", "processing_timestamp", f"{age} <= {int(max_lag_seconds)}", 0.6),
    ]


def _passes(rule: QualityRule) -> Column:
    return F.coalesce(F.expr(rule.condition), F.lit(False))


def quality_metrics(records: DataFrame, rules: list[QualityRule], by: tuple = ("source", "partition_date")) -> DataFrame:
    """One row per group and rule: records, those that pass, their share,
    the least share and whether it is missed. All rules are counted in one
    aggregation."""
    counted = records.groupBy(*by).agg(F.count(F.lit(1)).alias("records"),
                                       *(F.count_if(_passes(r)).alias(f"_n{i}") for i, r in enumerate(rules)))
    rows = F.array(*(F.struct(F.lit(r.measure).alias("measure"), F.lit(r.field).alias("field"),
                              F.col(f"_n{i}").alias("passed"), F.lit(float(r.least)).alias("least"))
                     for i, r in enumerate(rules)))
    share = F.col("passed") / F.col("records")
    return counted.select(*by, "records", F.inline(rows)).select(
        *by, "measure", "field", "records", "passed", share.alias("share"), "least", (share < F.col("least")).alias("missed"))


def quality_alerts(metrics: DataFrame) -> DataFrame:
    """The groups and rules that miss their least share."""
    return metrics.where("missed").drop("missed")


def failing_records(records: DataFrame, rules: list[QualityRule]) -> DataFrame:
    """The records that fail a rule, with ``failed_rules``
    (``measure:field`` in rule order)."""
    failed = F.array_compact(F.array(*(F.when(~_passes(r), F.lit(f"{r.measure}:{r.field}")) for r in rules)))
    # through ``inline``, so that the filter is not pushed into the records'
    # own expressions, where it would evaluate them again for every rule
    row = F.struct(*(F.col(c) for c in records.columns), failed.alias("failed_rules"))
    return records.select(F.inline(F.array(row))).where(F.size("failed_rules") > 0)
