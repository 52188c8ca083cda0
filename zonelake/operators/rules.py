"""Schema rules as rows (V3-V6).

A rule set says which sources a schema applies to (``exact``, ``prefix`` or
``regex`` of the source text) and what the schema demands, one row per keyword
and instance path. Documents find their schema by hash joins on the source (the
exact text, then its prefixes, longest first; patterns last) and carry only the
rules of that schema, so the work of a document does not grow with the number
of registered schemas. Both sides are rows: rule sets can be kept as a table.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.functions.json import NUMBER_KINDS, kind
from zonelake.functions.pytext import py_json, py_str
from zonelake.functions.util import let

MATCHES = "schema string, match string, pattern string"
RULES = "schema string, seq int, depth int, path string, target string, keyword string, argument string"
#: Kinds of a VARIANT that have each JSON-Schema type (``integer``: reals
#: without a fraction are tested by value).
ACCEPTS = {"object": ["OBJECT"], "array": ["ARRAY"], "string": ["STRING"], "boolean": ["BOOLEAN"], "null": ["VOID"],
           "number": list(NUMBER_KINDS), "integer": ["BIGINT", "INT", "SMALLINT", "TINYINT"]}


class RuleSet(NamedTuple):
    """``matches``: (schema, match, pattern) rows; ``rules``: rows of RULES.
    Rule sets are configuration: they are read once when a plan is built."""

    matches: list[tuple]
    rules: list[tuple]


def member_path(path: str, name: str) -> str:
    """The path of a member for VARIANT lookups, which know no escapes."""
    if not name or "?" in name or "'" in name and '"' in name:
        raise ValueError(f"no lookup path for a member named {name!r}")
    quote = '"' if "'" in name else "'"
    return f"{path}[{quote}{name}{quote}]"


def rule_rows(name: str, schema: Mapping) -> list[tuple]:
    """The rows of one schema (a JSON-Schema subset: ``type``, ``required``,
    ``properties``), in the validator's order: keywords as written, a
    property's own rules where it stands."""
    out: list[tuple] = []

    def walk(sub: Mapping, path: str, depth: int) -> None:
        for keyword, spec in sub.items():
            if keyword == "type":
                if spec not in ACCEPTS:
                    raise ValueError(f"unsupported JSON-Schema type {spec!r}")
                out.append((name, len(out), depth, path, path, keyword, spec))
            elif keyword == "required":
                out.extend((name, len(out) + k, depth, path, member_path(path, p), keyword, p)
                           for k, p in enumerate(list(spec)))
            elif keyword == "properties":
                for p, below in spec.items():
                    walk(below, member_path(path, p), depth + 1)
            else:
                raise ValueError(f"unsupported JSON-Schema keyword {keyword!r}")

    walk(schema, "$", 0)
    return out


def rule_set(schemas: Mapping[str, Mapping], matches: Iterable[tuple[str, str, str]] | None = None) -> RuleSet:
    """Rule rows of ``schemas``. ``matches`` are (schema, match, pattern);
    without them a schema is for the source of exactly its name."""
    rows = [r for name, schema in schemas.items() for r in rule_rows(name, schema)]
    who = list(matches) if matches is not None else [(name, "exact", name) for name in schemas]
    for schema, match, _ in who:
        if match not in ("exact", "prefix", "regex") or schema not in schemas:
            raise ValueError(f"no such match: {match!r} for {schema!r}")
    return RuleSet(who, rows)


def write_rules(spark: SparkSession, rules: RuleSet, path: str) -> None:
    """Keep a rule set as two tables below ``path``; it replaces the one there."""
    for name, rows, schema in (("matches", rules.matches, MATCHES), ("rules", rules.rules, RULES)):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{path}/{name}")


def read_rules(spark: SparkSession, path: str) -> RuleSet:
    def rows(name: str, schema: str, *order: str) -> list[tuple]:
        return [tuple(r) for r in spark.read.schema(schema).parquet(f"{path}/{name}").orderBy(*order).collect()]

    return RuleSet(rows("matches", MATCHES, "schema", "match", "pattern"), rows("rules", RULES, "schema", "seq"))


def _table(spark: SparkSession, rows: list[tuple], names: tuple) -> DataFrame:
    """Configuration rows as a relation whose size the planner knows, so that
    a join decides by it whether to broadcast."""
    def value(x) -> Column:
        if isinstance(x, list):
            return F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip(r, RULE_FIELDS))) for r in x)).cast(RULE_LIST)
        return F.lit(x)

    return spark.range(1).select(F.inline(F.array(*(
        F.struct(*(value(v).alias(n) for v, n in zip(r, names))) for r in rows))))


RULE_LIST = ("array<struct<seq:int,depth:int,path:string,target:string,keyword:string,argument:string,"
             "accepts:array<string>>>")
RULE_FIELDS = ("seq", "depth", "path", "target", "keyword", "argument", "accepts")


def with_rules(documents: DataFrame, rules: RuleSet, source: str = "_src_text") -> DataFrame:
    """``documents`` with the ``_rules`` of their source's schema (an array in
    rule order, NULL without a schema). An exact match wins, then the longest
    prefix, then the smallest schema name among matching regexes."""
    spark = documents.sparkSession
    by_schema: dict[str, list] = {m[0]: [] for m in rules.matches}
    for name, *rule in sorted(rules.rules):
        by_schema.setdefault(name, []).append((*rule, ACCEPTS[rule[-1]] if rule[-2] == "type" else []))
    # one join for exact names and one for each length of prefixes, longest first
    steps: dict[tuple, dict] = {}
    for schema, match, pattern in sorted(rules.matches, reverse=True):
        if match != "regex":
            steps.setdefault((match == "prefix", len(pattern) if match == "prefix" else 0), {})[pattern] = by_schema[schema]
    out, found = documents, []
    for k, ((prefix, length), known) in enumerate(sorted(steps.items(), key=lambda s: (s[0][0], -s[0][1]))):
        table = _table(spark, [(p, r) for p, r in known.items()], (f"_p{k}", f"_r{k}"))
        key = F.left(F.col(source), F.lit(length)) if prefix else F.col(source)
        out = out.join(table, key == F.col(f"_p{k}"), "left").drop(f"_p{k}")
        found.append(F.col(f"_r{k}"))
    regexes = sorted((s, p) for s, m, p in rules.matches if m == "regex")
    if regexes:
        choice = F.coalesce(*(F.when(F.regexp_like(F.col(source), F.lit(p)), F.lit(s)) for s, p in regexes))
        none_yet = F.coalesce(*found).isNull() if found else F.lit(True)
        table = _table(spark, [(s, by_schema[s]) for s in {s for s, _ in regexes}], ("_ps", "_rs"))
        out = out.join(table, F.when(none_yet, choice) == F.col("_ps"), "left").drop("_ps")
        found.append(F.col("_rs"))
    found.append(F.lit(None).cast(RULE_LIST))
    return out.withColumn("_rules", F.coalesce(*found)).drop(*(f"_r{k}" for k in range(len(steps))), "_rs")


def schema_of(source: Column, matches: Iterable[tuple[str, str, str]]) -> Column:
    """The schema of a source as an expression, for small tables of sources."""
    found = {m: [(s, p) for s, k, p in sorted(matches) if k == m] for m in ("exact", "prefix", "regex")}
    tests = [F.when(source == p, F.lit(s)) for s, p in found["exact"]]
    tests += [F.when(source.startswith(p), F.lit(s)) for s, p in sorted(found["prefix"], key=lambda x: -len(x[1]))]
    tests += [F.when(F.regexp_like(source, F.lit(p)), F.lit(s)) for s, p in found["regex"]]
    return F.coalesce(*tests, F.lit(None).cast("string"))


def rule_errors(payload: Column, payload_kind: Column, document: Column, rules: Column) -> Column:
    """The failed rules of a payload as (depth, seq, message), in rule order.
    ``document`` is the JSON text whose member ``data`` the payload is: values
    are printed from it, and only for a failure. A rule about a value that
    isn't there does not fail."""

    def value(path: Column) -> Column:
        return F.try_variant_get(payload, path, "variant")

    def kind_at(path: Column) -> Column:
        return F.when(path == "$", payload_kind).otherwise(kind(value(path)))

    def failed(r: Column) -> Column:
        real = F.try_variant_get(value(r["path"]), "$", "double")
        whole = (r["argument"] == "integer") & F.coalesce(real == F.floor(real), F.lit(False))
        wrong = ~F.array_contains(r["accepts"], kind_at(r["path"])) & ~whole
        absent = value(r["target"]).isNull() & (kind_at(r["path"]) == "OBJECT")
        return F.coalesce(F.when(r["keyword"] == "required", absent).otherwise(wrong), F.lit(False))

    def printed(v: Column, k: Column, path: Column) -> Column:
        text = F.call_function("get_json_object", document, F.concat(F.lit("$['data']"), F.substr(path, F.lit(2))))
        return (F.when(k == "VOID", F.lit("None")).when(k == "BOOLEAN", F.initcap(F.to_json(v)))
                .when(k == "STRING", py_str(F.try_variant_get(v, "$", "string")))
                .otherwise(py_json(F.coalesce(text, F.to_json(v)))))

    def message(r: Column) -> Column:
        shown = let(kind_at(r["path"]), lambda k: printed(value(r["path"]), k, r["path"]))
        return F.when(r["keyword"] == "required", F.concat(py_str(r["argument"]), F.lit(" is a required property"))).otherwise(
            F.concat(shown, F.lit(" is not of type "), py_str(r["argument"])))

    return F.transform(F.filter(rules, failed), lambda r: F.struct(
        r["depth"].alias("depth"), r["seq"].alias("seq"), message(r).alias("message")))
