"""JSON helpers built from native Spark expressions (no Python UDF).

Payloads are handled as VARIANT. The helpers below cover what the VARIANT
functions do not give directly: strict parsing of request text, the canonical
text form used for fingerprints, key presence, and the JSON kind of a value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonelake.functions.util import as_col


def strict_json(text) -> Column:
    """Parse ``text`` as exactly one JSON value, else NULL.

    ``try_parse_json`` accepts trailing text (``{"a":1} tail`` parses as
    ``{"a":1}``). To reject it the body is wrapped as
    ``{"b":<text>,"z":"<md5(text)>"}``: any trailing text either breaks the
    wrapper, adds keys to it, or hides the ``z`` key, so the value is kept only
    when the wrapper has exactly the keys ``b`` and ``z`` and ``z`` matches.
    JSON null is kept (as a VARIANT null); duplicate keys, ``NaN`` and empty
    text give NULL.
    """
    t = as_col(text)
    digest = F.md5(t)
    wrapped = F.try_parse_json(F.concat(F.lit('{"b":'), t, F.lit(',"z":"'), digest, F.lit('"}')))
    # "b" is always the first key; exactly one more key, "z", holding the
    # digest, proves the parser consumed the whole body.
    two_keys = F.size(F.try_variant_get(wrapped, "$", "map<string,variant>")) == 2
    z_ok = F.try_variant_get(wrapped, "$.z", "string") == digest
    return F.when(two_keys & z_ok, F.try_variant_get(wrapped, "$.b", "variant"))


def kind(v) -> Column:
    """Top-level JSON kind of a VARIANT: OBJECT, ARRAY, STRING, BIGINT,
    DECIMAL, DOUBLE, BOOLEAN, VOID (JSON null), ... or NULL for SQL NULL."""
    return F.substring_index(F.substring_index(F.schema_of_variant(as_col(v)), "<", 1), "(", 1)


def top_kind(v) -> Column:
    """``kind`` without describing the members of an object."""
    c = as_col(v)
    return F.when(F.try_variant_get(c, "$", "struct<>").isNotNull(), F.lit("OBJECT")).otherwise(kind(c))


NUMBER_KINDS = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DECIMAL", "DOUBLE", "FLOAT")


def is_number(v) -> Column:
    """JSON-Schema ``number``: integers and reals, not booleans."""
    return kind(v).isin(*NUMBER_KINDS)


def field(v, name: str) -> Column:
    """Member ``name`` of a VARIANT object as VARIANT.

    SQL NULL when the member is absent, a VARIANT null when it is present
    with the JSON value null."""
    path = "$['" + name.replace("'", "\\'") + "']"
    return F.try_variant_get(as_col(v), path, "variant")


def has_field(v, name: str) -> Column:
    return field(v, name).isNotNull()


def variant_string(v) -> Column:
    """The value as a string only when it is a JSON string, else NULL
    (``try_variant_get(..., 'string')`` would turn the number 5 into '5')."""
    c = as_col(v)
    return F.when(kind(c) == "STRING", F.try_variant_get(c, "$", "string"))


def canonical_json(v) -> Column:
    """Canonical JSON text of a VARIANT: keys sorted, numbers normalised,
    no whitespace. A JSON null becomes SQL NULL (``to_json`` would give the
    text ``null``, which a null filter would keep)."""
    c = as_col(v)
    return F.when(~F.is_variant_null(c), F.to_json(c))


def fingerprint(text, mode: str = "sha256") -> Column:
    """Fingerprint of canonical JSON text.

    ``sha256`` (default) and ``md5`` give hex strings; ``murmur3`` is Spark's
    32-bit ``hash`` rendered as a string (collisions are likely at scale)."""
    t = as_col(text)
    if mode == "sha256":
        return F.sha2(t, 256)
    if mode == "md5":
        return F.md5(t)
    if mode == "murmur3":
        return F.hash(t).cast("string")
    raise ValueError(f"unknown fingerprint mode {mode!r}")


# Python type names used by the reference's error texts, by JSON kind.
PY_TYPE_NAMES = {
    "OBJECT": "dict",
    "ARRAY": "list",
    "STRING": "str",
    "BOOLEAN": "bool",
    "VOID": "NoneType",
    "BIGINT": "int",
    "INT": "int",
    "SMALLINT": "int",
    "TINYINT": "int",
    "DECIMAL": "float",
    "DOUBLE": "float",
    "FLOAT": "float",
}


def py_type_name_of_kind(k) -> Column:
    """Name of the Python type ``json.loads`` gives a value of JSON kind
    ``k`` (see ``kind``)."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in PY_TYPE_NAMES.items() for x in kv]), as_col(k))


def py_type_name(v) -> Column:
    """Name of the Python type ``json.loads`` would give this value."""
    return py_type_name_of_kind(kind(v))
