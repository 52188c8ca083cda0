"""Schema versions (D3) and tables from discovered schemas.

A version is the set of payload paths and kinds of a source
(``quality.payload_paths``), kept as rows in a table partitioned by version.
Two versions are compared with compatibility rules; payloads become typed
columns by a schema derived from path rows, and files of several versions are
read together under the merged one.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.functions.json import NUMBER_KINDS

STEP = re.compile(r"\.([A-Za-z_][A-Za-z0-9_]*)|\['((?:[^'\\]|\\.)*)'\]|(\[\*\])")


def write_version(paths: DataFrame, table_path: str, version: int) -> None:
    """Keep the path rows (``source, path, kind, values``) as a version; the
    same version written again is replaced."""
    paths.select("source", "path", "kind", "values").write.mode("overwrite").parquet(f"{table_path}/version={int(version)}")


def read_versions(spark: SparkSession, table_path: str) -> DataFrame:
    schema = "source string, path string, kind string, values bigint, version int"
    return spark.read.schema(schema).parquet(table_path)


def first_seen(versions: DataFrame) -> DataFrame:
    """``source, path, kind`` with the first and last version that has it."""
    return versions.groupBy("source", "path", "kind").agg(
        F.min("version").alias("first_version"), F.max("version").alias("last_version"))


def version_changes(versions: DataFrame, old: int, new: int) -> DataFrame:
    """``source, path, change, old_kinds, new_kinds, breaking`` between two
    versions. Compatible: ``added``, ``widened`` (numbers before and after, of
    other kinds) and ``nullable`` (nulls came or went). Breaking: ``removed``
    and ``type_changed``. Sources that one version lacks have no changes."""

    def kinds(version: int, name: str) -> DataFrame:
        rows = versions.where(F.col("version") == version)
        return rows.groupBy("source", "path").agg(F.array_sort(F.collect_set("kind")).alias(name))

    both = kinds(old, "old_kinds").join(kinds(new, "new_kinds"), ["source", "path"], "full_outer")
    sources = [versions.where(F.col("version") == v).select("source").distinct() for v in (old, new)]
    known = both.join(sources[0].intersect(sources[1]), "source", "left_semi")
    before, after = (F.array_remove(c, "VOID") for c in ("old_kinds", "new_kinds"))
    numbers = lambda c: F.size(F.array_except(c, F.array(*map(F.lit, NUMBER_KINDS)))) == 0
    change = (
        F.when(F.col("old_kinds").isNull(), F.lit("added"))
        .when(F.col("new_kinds").isNull(), F.lit("removed"))
        .when(F.col("old_kinds") == F.col("new_kinds"), F.lit(None).cast("string"))
        .when(before == after, F.lit("nullable"))
        .when(numbers(before) & numbers(after), F.lit("widened"))
        .otherwise(F.lit("type_changed"))
    )
    return (known.withColumn("change", change).where(F.col("change").isNotNull())
            .select("source", "path", "change", F.array_join("old_kinds", "|").alias("old_kinds"),
                    F.array_join("new_kinds", "|").alias("new_kinds"),
                    F.col("change").isin("removed", "type_changed").alias("breaking")))


def payload_type(paths: DataFrame, max_members: int = 1000) -> str:
    """The Spark type of a source's payload, from its path rows: objects become
    structs, arrays arrays, BIGINT alone ``bigint``, other numbers ``double``.
    Values of conflicting kinds, and objects with more than ``max_members``
    members (keys that are data), stay VARIANT, so nothing is lost and the
    number of paths that reach the driver is bounded per object."""
    last = r"(\.[A-Za-z_][A-Za-z0-9_]*|\['(?:[^'\\]|\\.)*'\]|\[\*\])$"
    rows = paths.groupBy("path").agg(F.collect_set("kind").alias("kinds")).withColumn(
        "parent", F.regexp_replace("path", last, ""))
    wide = rows.where("path != '$'").groupBy("parent").count().where(F.col("count") > max_members).select(
        F.col("parent").alias("wide")).collect()
    for r in wide:
        rows = rows.where((F.col("path") == r["wide"]) | ~F.col("path").startswith(r["wide"]))
    tree: dict = {"kinds": set(), "members": {}}
    for r in rows.select("path", "kinds").collect():
        node = tree
        for name, quoted, element in STEP.findall(r["path"][1:]):
            step = "[*]" if element else "." + (name or re.sub(r"\\(.)", r"\1", quoted))
            node = node["members"].setdefault(step, {"kinds": set(), "members": {}})
        node["kinds"] = set(r["kinds"])
    return _type_of(tree)


def _type_of(node: dict) -> str:
    kinds, members = node["kinds"] - {"VOID"}, node["members"]
    if kinds and kinds <= set(NUMBER_KINDS):
        return "bigint" if kinds <= {"BIGINT", "INT", "SMALLINT", "TINYINT"} else "double"
    if kinds == {"STRING"} or kinds == {"BOOLEAN"}:
        return kinds.pop().lower()
    if kinds == {"ARRAY"}:
        return f"array<{_type_of(members['[*]']) if '[*]' in members else 'variant'}>"
    if kinds == {"OBJECT"} and members:
        fields = (f"`{name[1:].replace('`', '``')}`:{_type_of(sub)}" for name, sub in sorted(members.items()))
        return f"struct<{','.join(fields)}>"
    return "variant"


def typed(raw: DataFrame, payload_ddl: str) -> DataFrame:
    """Raw records with a typed payload; a value that doesn't fit is NULL."""
    return raw.select("ingestion_timestamp", "source", F.try_variant_get(F.col("data"), "$", payload_ddl).alias("data"))


def write_typed(raw: DataFrame, payload_ddl: str, path: str, version: int) -> None:
    """Typed records as the files of one version, which they replace."""
    typed(raw, payload_ddl).write.mode("overwrite").parquet(f"{path}/version={int(version)}")


def read_merged(spark: SparkSession, path: str, versions: dict[int, str], merged_ddl: str) -> DataFrame:
    """The files of several versions (their payload types by version) under
    one type: columns a version lacks are NULL, numbers are widened, values of
    conflicting types are VARIANT. (``mergeSchema`` alone refuses such files.)"""

    def one(version: int, ddl: str) -> DataFrame:
        rows = spark.read.schema(f"ingestion_timestamp string, source string, data {ddl}").parquet(f"{path}/version={version}")
        return rows.select("ingestion_timestamp", "source", _as_type("data", ddl, merged_ddl).alias("data"),
                           F.lit(version).alias("version"))

    return reduce(DataFrame.unionByName, [one(v, ddl) for v, ddl in sorted(versions.items())])


def _as_type(column: str, ddl: str, merged_ddl: str) -> Column:
    if ddl == merged_ddl:
        return F.col(column)
    return F.try_variant_get(F.to_variant_object(column) if "<" in ddl else F.col(column).cast("variant"), "$", merged_ddl)


def register_discovered(spark: SparkSession, name: str, raw: DataFrame, payload_ddl: str, path: str) -> DataFrame:
    """The records with a typed payload as a catalog table, partitioned by
    date, its partitions registered; returns the table."""
    rows = typed(raw, payload_ddl).withColumn("ingestion_date", F.to_date(F.col("ingestion_timestamp").try_cast("timestamp_ntz")))
    rows.hint("rebalance", "ingestion_date").write.mode("overwrite").partitionBy("ingestion_date").parquet(path)
    spark.sql(f"CREATE TABLE {name} (ingestion_timestamp STRING, source STRING, data {payload_ddl}, ingestion_date DATE) "
              f"USING parquet PARTITIONED BY (ingestion_date) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)
