"""The validation oracle: landed documents rebuilt from ``events`` and checked
with DuckDB's JSON functions, from the registered schemas' definition."""

from __future__ import annotations

from zonelake.schemas import SOURCE_SCHEMAS

TS_TEXT = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"


def document_text() -> str:
    """The landed document of an event, by the templates of
    ``sources.tables.events_to_documents``."""
    stamp = f"""'{{"ingestion_timestamp":"' || {TS_TEXT} || '"'"""
    device = "'iot_sensor_' || (event_id % 3)"

    def doc(source: str, payload: str, head: str = stamp, extra: str = "") -> str:
        src = f""" || ',"source":' || {source}""" if source else ""
        return f"""{head}{src}{extra} || ',"data":' || {payload} || '}}'"""

    def obj(*members: str) -> str:
        return "'{' || " + " || ',' || ".join(members) + " || '}'"

    def text(value: str) -> str:
        return f"""'"' || {value} || '"'"""

    def member(name: str, value: str) -> str:
        return f"""'"{name}":' || {value}"""

    dev, when, hum = member("device_id", text("'dev-' || user_id")), member("timestamp", text(TS_TEXT)), "(event_id % 100)"
    temp = "CAST(value AS VARCHAR)"
    full = obj(member("temperature", temp), member("humidity", hum))
    event = member("event_type", text("event_type"))
    templates = {
        0: doc(text("'iot_sensor'"), obj(dev, when, member("readings", full))),
        1: doc(text("'iot_sensor'"), obj(when, member("readings", obj(member("humidity", hum))))),
        2: doc(text("'iot_sensor'"), obj(dev, when, member("readings", obj(member("temperature", text("'warm'")))))),
        3: doc(text("'api_events'"), obj(event, member("user_id", text("user_id")), when)),
        4: doc(text("'api_events'"), obj(event, member("user_id", "user_id"), when)),
        5: doc(text("event_type"), "props"),
        6: f"""{stamp} || ',"source":' || {text("event_type")} || '}}'""",
        7: doc(text("event_type"), "props", head="""'{"ingestion_timestamp":"' || strftime(ts, '%d/%m/%Y %H:%M') || '"'"""),
        8: doc(text("event_type"), "props", head="""'{"ingestion_timestamp":' || event_id"""),
        9: "'[' || props || ']'",
        10: doc(text(device), obj(dev, when, member("readings", obj(
            member("temperature", temp), member("humidity", hum), member("tags", f"""'["a",' || {hum} || ']'""")))),
            extra=""" || ',"metadata":{"batch":' || user_id || '}'"""),
        11: doc(text(device), obj(
            member("readings", obj("""'"humidity":true'""", member("temperature", text(f"'it''s ' || {hum}")))),
            member("device_id", f"""'["it''s",' || {temp} || ',null,{{"z":1.50,"a":"é"}}]'"""))),
        12: doc("", "props"),
        13: doc(text("'api_events'"), f"'[' || props || ',' || {hum} || ']'"),
        14: doc("'null'", "props"),
        15: doc(text(device), obj(dev, when, member("readings", obj(
            member("temperature", f"""'{{"value":' || {hum} || ',"unit":"°C"}}'"""), member("humidity", hum)))),
            head="""'{"ingestion_timestamp":"soon"'"""),
    }
    return "CASE event_id % 16 " + " ".join(f"WHEN {k} THEN {v}" for k, v in templates.items()) + " END"


def _printed(value: str) -> str:
    """A JSON scalar as Python prints it."""
    s = f"({value} ->> '$')"
    return f"""CASE json_type({value})
      WHEN 'VARCHAR' THEN CASE WHEN contains({s}, '''') AND NOT contains({s}, '"') THEN '"' || {s} || '"'
                               ELSE '''' || replace({s}, '''', chr(92) || '''') || '''' END
      WHEN 'BOOLEAN' THEN CASE {s} WHEN 'true' THEN 'True' ELSE 'False' END
      WHEN 'NULL' THEN 'None' WHEN 'DOUBLE' THEN CAST(CAST({s} AS DOUBLE) AS VARCHAR) ELSE {s} END"""


def _member_list(value: str) -> str:
    """A flat JSON object as Python prints it."""
    return f"""'{{' || array_to_string(list_transform(json_keys({value}),
      lambda m: '''' || m || ''': ' || {_printed(f"json_extract({value}, '$.' || m)")}), ', ') || '}}'"""


def _python_repr(value: str) -> str:
    """A JSON value of two levels as Python prints it."""
    flat = f"CASE json_type(x) WHEN 'OBJECT' THEN {_member_list('x')} ELSE {_printed('x')} END"
    return f"""CASE json_type({value}) WHEN 'OBJECT' THEN {_member_list(value)}
      WHEN 'ARRAY' THEN '[' || array_to_string(list_transform(json_extract({value}, '$[*]'), lambda x: {flat}), ', ') || ']'
      ELSE {_printed(value)} END"""


_JSON_TYPES = {"string": "('VARCHAR')", "object": "('OBJECT')", "number": "('UBIGINT', 'BIGINT', 'DOUBLE')"}


def _schema_checks(name: str) -> str:
    """The errors of one schema as a list, in the validator's order (which for
    both schemas is also the order of depth)."""
    out = []

    def walk(sub: dict, path: str) -> None:
        at = f"(text -> '{path}')"
        if "type" in sub:
            out.append(f"CASE WHEN json_type(text, '{path}') NOT IN {_JSON_TYPES[sub['type']]} "
                       f"THEN ({_python_repr(at)}) || ' is not of type ''{sub['type']}''' END")
        for p in sub.get("required", []):
            out.append(f"CASE WHEN json_type(text, '{path}') = 'OBJECT' AND NOT json_exists(text, '{path}.{p}') "
                       f"THEN '''{p}'' is a required property' END")
        for p, below in sub.get("properties", {}).items():
            walk(below, f"{path}.{p}")

    walk(SOURCE_SCHEMAS[name], "$.data")
    return "[" + ", ".join(out) + "]"


VALIDATION_CTE = f"""
docs AS (
  SELECT 'source=' || event_type || strftime(CAST(ts AS TIMESTAMP), '/year=%Y/month=%m/day=%d/%Y%m%d_%H%M%S_%f')
           || '_' || CAST(event_id AS VARCHAR) || '.json' AS key,
         {document_text()} AS text
  FROM events
),
d1 AS (
  SELECT key, text, json_valid(text) AS ok, CASE WHEN json_valid(text) THEN json_type(text) END AS dkind
  FROM docs
),
d2 AS (
  SELECT *,
    CASE WHEN dkind = 'OBJECT' THEN list_contains(json_keys(text), 'data') END AS has_data,
    CASE WHEN dkind = 'OBJECT' THEN json_type(text, '$.source') END AS skind,
    CASE WHEN dkind = 'OBJECT' THEN text ->> '$.source' END AS src,
    CASE WHEN dkind = 'OBJECT' THEN json_type(text, '$.ingestion_timestamp') END AS tkind,
    CASE WHEN dkind = 'OBJECT' THEN text ->> '$.ingestion_timestamp' END AS ts_text,
    CASE WHEN dkind = 'OBJECT' THEN json_type(text, '$.data') END AS pkind
  FROM d1
),
d3 AS (
  SELECT *, list_filter(CASE WHEN skind <> 'VARCHAR' OR NOT has_data THEN CAST([] AS VARCHAR[])
      WHEN src = 'iot_sensor' OR starts_with(src, 'iot_sensor_') THEN {_schema_checks("iot_sensor")}
      WHEN src = 'api_events' THEN {_schema_checks("api_events")} END, lambda x: x IS NOT NULL) AS failed
  FROM d2
),
d4 AS (
  SELECT *,
    CASE WHEN NOT ok THEN 'Invalid JSON'
         WHEN dkind = 'ARRAY' THEN '''list'' object has no attribute ''get'''
         WHEN dkind <> 'OBJECT' THEN 'not an object'
         WHEN NOT has_data THEN NULL
         WHEN tkind IS NOT NULL AND tkind <> 'VARCHAR' THEN 'fromisoformat: argument must be str'
    END AS error,
    list_transform(coalesce(failed, []), lambda x: 'Schema validation failed: ' || x) AS listed,
    CASE WHEN tkind = 'VARCHAR' AND TRY_CAST(ts_text AS TIMESTAMP) IS NULL THEN ['Invalid timestamp format'] ELSE [] END AS late
  FROM d3
),
validation AS (
  SELECT key, text,
    CASE WHEN error IS NOT NULL THEN 'error'
         WHEN NOT has_data THEN 'invalid'
         WHEN len(listed) + len(late) > 0 THEN 'invalid'
         ELSE 'valid' END AS status,
    CASE WHEN dkind <> 'OBJECT' OR dkind IS NULL THEN NULL
         WHEN skind IS NULL THEN 'unknown'
         WHEN skind = 'NULL' THEN NULL
         ELSE src END AS source,
    CASE WHEN error IS NOT NULL THEN NULL
         WHEN NOT has_data THEN ['Missing ''data'' field']
         WHEN len(listed) + len(late) > 0 THEN list_concat(listed[1:1], late) END AS errors,
    error,
    CASE WHEN tkind = 'VARCHAR' THEN TRY_CAST(ts_text AS TIMESTAMP) END AS ts,
    CASE WHEN error IS NOT NULL THEN NULL
         WHEN NOT has_data THEN ['Missing ''data'' field']
         WHEN len(listed) + len(late) > 0 THEN list_concat(listed, late) END AS all_errors
  FROM d4
)"""

VALIDATION_ALERTS = """
SELECT 'Data Validation Failure' AS subject, key,
  'Validation failed for ' || key || chr(10) || 'Errors: [' || chr(10) || '  '
    || array_to_string(list_transform(errors, lambda e: '"'
         || replace(replace(replace(e, '"', chr(92) || '"'), '°', chr(92) || 'u00b0'), 'é', chr(92) || 'u00e9') || '"'),
       ',' || chr(10) || '  ')
    || chr(10) || ']' AS message
FROM validation WHERE status = 'invalid'"""
