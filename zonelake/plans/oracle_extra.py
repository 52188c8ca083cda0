"""Oracle SQL for the queries in ``registry_extra``.

The request bodies and landed documents are rebuilt from ``events`` with the
same templates as ``sources.tables``; classification and validation are then
done with DuckDB's own JSON functions (``json_valid``, ``json_type``,
``json_keys``), independently of the Spark expressions.
"""

from __future__ import annotations

from zonelake.plans.oracle_validation import VALIDATION_ALERTS, VALIDATION_CTE

REQUESTS_CTE = """
req AS (
  SELECT CAST(event_id AS VARCHAR) AS request_id, CAST(ts AS TIMESTAMP) AS ts,
    CASE event_id % 12
      WHEN 0 THEN '{"source":' || to_json(event_type) || ',"data":' || props || ',"metadata":{"user_id":' || user_id || '}}'
      WHEN 1 THEN '{"source":' || to_json(event_type) || ',"data":' || props || '}'
      WHEN 2 THEN '{"data":' || props || '}'
      WHEN 3 THEN '{"source":' || to_json(event_type) || ',"data":' || props
      WHEN 4 THEN '{"source":' || to_json(event_type) || ',"data":' || props || '} trailing'
      WHEN 5 THEN '[' || props || ']'
      WHEN 6 THEN CAST(user_id AS VARCHAR)
      WHEN 7 THEN 'null'
      WHEN 8 THEN '{"source":null,"data":' || props || '}'
      WHEN 9 THEN '{"source":' || user_id || ',"data":' || props || '}'
      WHEN 10 THEN '{"source":"","data":' || props || '}'
      ELSE '{"source":' || to_json(event_type) || ',"data":null}'
    END AS body
  FROM events
),
req_k AS (
  SELECT request_id, ts, body, json_valid(body) AS ok,
         CASE WHEN json_valid(body) THEN json_type(body) END AS bkind
  FROM req
),
req_c AS (
  SELECT *,
    CASE WHEN bkind = 'OBJECT' THEN list_contains(json_keys(body), 'source') AND list_contains(json_keys(body), 'data') END AS has_both,
    CASE WHEN bkind = 'OBJECT' THEN json_type(body, '$.source') END AS skind,
    CASE WHEN bkind = 'OBJECT' AND json_type(body, '$.source') = 'VARCHAR' THEN body ->> '$.source' END AS src,
    CASE WHEN bkind = 'ARRAY' THEN list_contains(json_extract_string(body, '$[*]'), 'source')
                               AND list_contains(json_extract_string(body, '$[*]'), 'data') END AS arr_both,
    CASE WHEN bkind = 'VARCHAR' THEN contains(body ->> '$', 'source') AND contains(body ->> '$', 'data') END AS str_both
  FROM req_k
),
outcomes AS (
  SELECT request_id, ts, src,
    CASE WHEN NOT ok THEN 400
         WHEN bkind = 'OBJECT' AND NOT has_both THEN 400
         WHEN bkind = 'OBJECT' AND skind IS DISTINCT FROM 'VARCHAR' THEN 500
         WHEN bkind = 'OBJECT' AND src = '' THEN 400
         WHEN bkind = 'OBJECT' THEN 200
         WHEN bkind = 'ARRAY' THEN CASE WHEN arr_both THEN 500 ELSE 400 END
         WHEN bkind = 'VARCHAR' THEN CASE WHEN str_both THEN 500 ELSE 400 END
         ELSE 500 END AS status_code
  FROM req_c
)"""

ORACLE_SQL: dict[str, str] = {
    "ingest_outcomes": "WITH " + REQUESTS_CTE + """
SELECT request_id, CAST(NULL AS INTEGER) AS item, status_code,
  CASE WHEN status_code = 200 THEN NULL
       WHEN status_code = 500 THEN 'Internal server error'
       WHEN request_id IN (SELECT request_id FROM req_c WHERE NOT ok) THEN 'Invalid JSON in request body'
       WHEN src = '' THEN 'Empty source'
       ELSE 'Missing required fields: source and data' END AS error,
  CASE WHEN status_code = 200 THEN 'source=' || src || strftime(ts, '/year=%Y/month=%m/day=%d/%Y%m%d_%H%M%S_%f') || '.json' END AS key,
  src AS source, ts
FROM outcomes""",
    "validation_results": "WITH " + VALIDATION_CTE + "\nSELECT * EXCLUDE (text) FROM validation",
    "validation_summary": "WITH " + VALIDATION_CTE + """
SELECT status, CAST(count(*) AS BIGINT) AS documents FROM validation GROUP BY status""",
    "validation_alerts": "WITH " + VALIDATION_CTE + VALIDATION_ALERTS,
    "validation_metrics": "WITH " + VALIDATION_CTE + """,
per_text AS (
  SELECT source, date_trunc('hour', ts) AS hour, coalesce(errors[1], error) AS failure,
    CAST(count(*) FILTER (WHERE status = 'valid') AS BIGINT) AS valid,
    CAST(count(*) FILTER (WHERE status = 'invalid') AS BIGINT) AS invalid,
    CAST(count(*) FILTER (WHERE status = 'error') AS BIGINT) AS error
  FROM validation GROUP BY ALL
)
SELECT source, hour,
  CAST(sum(valid) AS BIGINT) AS valid, CAST(sum(invalid) AS BIGINT) AS invalid, CAST(sum(error) AS BIGINT) AS errors,
  (sum(invalid) + sum(error)) / (sum(valid) + sum(invalid) + sum(error)) AS failure_rate,
  arg_min(failure, (-(invalid + error), failure)) FILTER (WHERE failure IS NOT NULL) AS top_error
FROM per_text GROUP BY source, hour""",
}


def batch_cte(limit: int) -> str:
    """Batch items and outcomes; batches of more than ``limit`` items are
    rejected whole. No template has more than three."""
    return BATCH_TEMPLATE.replace("@most", str(limit)).replace("@stop", str(limit + 1))


BATCH_TEMPLATE = """
breq AS (
  SELECT CAST(event_id AS VARCHAR) AS request_id, CAST(ts AS TIMESTAMP) AS ts,
    CASE event_id % 3
      WHEN 0 THEN '[{"source":' || to_json(event_type) || ',"data":' || props || '},{"data":' || props || '}]'
      WHEN 1 THEN '{"source":' || to_json(event_type) || ',"data":' || props || '}'
      ELSE '[' || repeat('{"source":' || to_json(event_type) || ',"data":' || props || '},', 2)
           || '{"source":' || to_json(event_type) || ',"data":' || props || '}]'
    END AS body
  FROM events
),
bk AS (
  SELECT request_id, ts, body, json_valid(body) AS ok,
         CASE WHEN json_valid(body) THEN json_type(body) END AS bkind,
         CASE WHEN json_valid(body) AND json_type(body) = 'ARRAY' THEN json_array_length(body) END AS n
  FROM breq
),
bitems AS (
  SELECT request_id, ts, CAST(NULL AS INTEGER) AS item, body AS item_body, n > @most AS too_large
  FROM bk WHERE NOT (bkind = 'ARRAY' AND n BETWEEN 1 AND @most)
  UNION ALL
  SELECT request_id, ts, CAST(i - 1 AS INTEGER) AS item, CAST(json_extract(body, '$[' || (i - 1) || ']') AS VARCHAR), false
  FROM bk, range(1, @stop) r(i) WHERE bkind = 'ARRAY' AND n BETWEEN 1 AND @most AND i <= n
),
bc AS (
  SELECT *, json_type(item_body) AS k,
    CASE WHEN json_type(item_body) = 'OBJECT' THEN list_contains(json_keys(item_body), 'source')
                                                   AND list_contains(json_keys(item_body), 'data') END AS has_both,
    CASE WHEN json_type(item_body) = 'OBJECT' THEN json_type(item_body, '$.source') END AS skind,
    CASE WHEN json_type(item_body) = 'OBJECT' AND json_type(item_body, '$.source') = 'VARCHAR'
         THEN item_body ->> '$.source' END AS src
  FROM bitems
),
boutcomes AS (
  SELECT request_id, item, ts, src,
    CASE WHEN too_large THEN 413
         WHEN k = 'OBJECT' AND NOT has_both THEN 400
         WHEN k = 'OBJECT' AND skind IS DISTINCT FROM 'VARCHAR' THEN 500
         WHEN k = 'OBJECT' AND src = '' THEN 400
         WHEN k = 'OBJECT' THEN 200
         ELSE 500 END AS status_code
  FROM bc
)"""

BATCH_SUMMARY = """
SELECT request_id, CAST(count(*) AS BIGINT) AS items,
  CAST(count(*) FILTER (WHERE status_code = 200) AS BIGINT) AS accepted,
  CAST(count(*) FILTER (WHERE status_code <> 200) AS BIGINT) AS rejected,
  CASE WHEN count(*) FILTER (WHERE status_code <> 200) = 0 THEN 200
       WHEN count(*) FILTER (WHERE status_code = 200) > 0 THEN 207
       ELSE arg_min(status_code, coalesce(item, 0)) END AS status_code
FROM boutcomes GROUP BY request_id"""

# Our kind names for DuckDB JSON types.
KIND_OF = """CASE {t} WHEN 'VARCHAR' THEN 'STRING' WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'BIGINT' THEN 'BIGINT'
  WHEN 'DOUBLE' THEN 'DECIMAL' WHEN 'NULL' THEN 'VOID' ELSE {t} END"""


SCHEMA_DIFF = """,
payloads AS (
  SELECT src AS source, text -> '$.data' AS data FROM d2 WHERE skind = 'VARCHAR' AND has_data
    AND (src IN ('iot_sensor', 'api_events') OR starts_with(src, 'iot_sensor_'))
),
profile AS (
  SELECT source, regexp_replace(fullkey, '\\[[0-9]+\\]', '[*]', 'g') AS path, """ + KIND_OF.format(t="type") + """ AS kind,
    CAST(count(*) AS BIGINT) AS n
  FROM (SELECT p.source, t.fullkey, t.type FROM payloads p, json_tree(p.data) t) GROUP BY ALL
),
declared(schema, path, declared) AS (VALUES
  ('iot_sensor', '$', 'object'), ('iot_sensor', '$.device_id', 'string'), ('iot_sensor', '$.timestamp', 'string'),
  ('iot_sensor', '$.readings', 'object'), ('iot_sensor', '$.readings.temperature', 'number'),
  ('iot_sensor', '$.readings.humidity', 'number'),
  ('api_events', '$', 'object'), ('api_events', '$.event_type', 'string'), ('api_events', '$.user_id', 'string'),
  ('api_events', '$.timestamp', 'string')),
expected AS (
  SELECT source, path, declared FROM declared d JOIN
    (SELECT DISTINCT source, CASE source WHEN 'api_events' THEN 'api_events' ELSE 'iot_sensor' END AS schema FROM profile
     UNION SELECT 'iot_sensor', 'iot_sensor' UNION SELECT 'api_events', 'api_events') s USING (schema)
),
fits(declared, kind) AS (VALUES ('object', 'OBJECT'), ('string', 'STRING'), ('number', 'BIGINT'), ('number', 'DECIMAL'))
SELECT source, path,
  CASE WHEN e.declared IS NULL THEN 'added' WHEN p.kind IS NULL THEN 'removed' ELSE 'type_changed' END AS change,
  e.declared, p.kind, coalesce(p.n, 0) AS values, e.declared IS NOT NULL AS breaking
FROM profile p FULL JOIN expected e USING (source, path)
WHERE (e.declared, p.kind) NOT IN (SELECT (declared, kind) FROM fits) OR e.declared IS NULL OR p.kind IS NULL"""

GENERATIONS = """,
generations AS (
  SELECT CASE WHEN n IN (0, 3) THEN 1 ELSE 2 END AS version, regexp_replace(src, '^iot_sensor_[0-9]$', 'iot_sensor') AS source,
    text -> '$.data' AS data
  FROM (SELECT *, CAST(regexp_extract(key, '_([0-9]+)[.]json$', 1) AS BIGINT) % 16 AS n FROM d2) WHERE n IN (0, 3, 1, 2, 4, 10)
),
kinds AS (
  SELECT version, source, path, string_agg(DISTINCT kind, '|' ORDER BY kind) AS kinds FROM (
    SELECT version, source, regexp_replace(t.fullkey, '\\[[0-9]+\\]', '[*]', 'g') AS path, """ + KIND_OF.format(t="t.type") + """ AS kind
    FROM generations g, json_tree(g.data) t) GROUP BY version, source, path
)"""

SENSOR_TOTALS = """
SELECT @by, CAST(count(*) AS BIGINT) AS records, CAST(count(data ->> '$.device_id') AS BIGINT) AS devices,
  CAST(sum(CAST(data ->> '$.readings.humidity' AS BIGINT)) AS BIGINT) AS humidity,
  CAST(count(*) FILTER (WHERE json_type(data, '$.readings.temperature') = 'VARCHAR') AS BIGINT) AS text_temperatures,
  CAST(count(*) FILTER (WHERE json_type(data, '$.readings.temperature') IN ('UBIGINT', 'BIGINT', 'DOUBLE')) AS BIGINT) AS number_temperatures,
  CAST(sum(coalesce(json_array_length(data, '$.readings.tags'), 0)) AS BIGINT) AS tags
FROM @from GROUP BY @by"""

QUALITY = """,
records AS (
  SELECT key, status, source,
    CASE WHEN tkind = 'VARCHAR' THEN ts_text END AS stamp, d.dkind = 'OBJECT' AND json_exists(d.text, '$.metadata') AS has_meta,
    d.has_data, strptime(regexp_extract(key, '/([0-9]{8}_[0-9]{6})_[0-9]+_[0-9]+[.]json$', 1), '%Y%m%d_%H%M%S') AS landed,
    CAST(regexp_extract(key, '_([0-9]+)[.]json$', 1) AS BIGINT) AS number
  FROM validation JOIN d2 d USING (key)
),
tested AS (
  SELECT key, source, CAST(landed AS DATE) AS partition_date, r.no, r.measure, r.field, r.least,
    coalesce(CASE r.no
      WHEN 1 THEN stamp IS NOT NULL WHEN 2 THEN source IS NOT NULL WHEN 3 THEN has_meta WHEN 4 THEN has_data
      WHEN 5 THEN status = 'valid'
      WHEN 6 THEN CAST(landed AS DATE) = CAST(TRY_CAST(stamp AS TIMESTAMP) AS DATE)
      ELSE date_sub('second', TRY_CAST(stamp AS TIMESTAMP), landed + to_hours(number % 36)) <= 86400 END, false) AS ok
  FROM records, (VALUES (1, 'completeness', 'ingestion_timestamp', 0.9::DOUBLE), (2, 'completeness', 'source', 0.9),
    (3, 'completeness', 'metadata', 0.9), (4, 'completeness', 'data', 0.9), (5, 'accuracy', 'data', 0.5),
    (6, 'consistency', 'ingestion_timestamp', 0.95), (7, 'timeliness', 'processing_timestamp', 0.6)) r(no, measure, field, least)
),
measured AS (
  SELECT source, partition_date, measure, field, CAST(count(*) AS BIGINT) AS records,
    CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS passed, count(*) FILTER (WHERE ok) / count(*) AS share,
    any_value(least) AS least, count(*) FILTER (WHERE ok) / count(*) < any_value(least) AS missed
  FROM tested GROUP BY source, partition_date, no, measure, field
)"""


def _more() -> dict[str, str]:
    from zonelake.plans.oracle import CURATED, DOC_RAW_CTE, PROCESSED, RAW, _fill

    out = {
        "batch_outcomes": "WITH " + batch_cte(3) + """
SELECT request_id, item, status_code,
  CASE status_code WHEN 200 THEN NULL WHEN 413 THEN 'Batch too large' WHEN 500 THEN 'Internal server error'
       ELSE 'Missing required fields: source and data' END AS error,
  CASE WHEN status_code = 200 THEN 'source=' || src || strftime(ts, '/year=%Y/month=%m/day=%d/%Y%m%d_%H%M%S_%f') || '.json' END AS key,
  CASE WHEN status_code <> 413 THEN src END AS source, ts
FROM boutcomes""",
        "batch_ingest": "WITH " + batch_cte(3) + BATCH_SUMMARY,
        "batch_ingest_limited": "WITH " + batch_cte(2) + BATCH_SUMMARY,
        "field_profile": "WITH " + DOC_RAW_CTE + """,
members AS (
  SELECT source, unnest(json_keys(data)) AS field, data FROM raw_data
)
SELECT source, field, """ + KIND_OF.format(t="json_type(data, '$.\"' || field || '\"')") + """ AS kind,
  CAST(count(*) AS BIGINT) AS records
FROM members GROUP BY ALL""",
        "schema_diff": "WITH " + VALIDATION_CTE + SCHEMA_DIFF,
        "quality_metrics": "WITH " + VALIDATION_CTE + QUALITY + "\nSELECT * FROM measured",
        "quality_alerts": "WITH " + VALIDATION_CTE + QUALITY + "\nSELECT * EXCLUDE (missed) FROM measured WHERE missed",
        "quality_failures": "WITH " + VALIDATION_CTE + QUALITY + """
SELECT key, string_agg(measure || ':' || field, ',' ORDER BY no) AS failed_rules
FROM tested WHERE NOT ok GROUP BY key""",
        "denormalized": CURATED + """
SELECT p.*, s.total_records AS source_total_records, s.avg_quality AS source_avg_quality,
       s.first_seen AS source_first_seen, s.last_seen AS source_last_seen
FROM processed_data p LEFT JOIN source_statistics s ON p.source = s.source""",
        "request_metrics": "WITH " + REQUESTS_CTE + """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  CAST(count(*) AS BIGINT) AS requests,
  CAST(count(*) FILTER (WHERE status_code >= 400 AND status_code < 500) AS BIGINT) AS client_errors,
  CAST(count(*) FILTER (WHERE status_code >= 500) AS BIGINT) AS server_errors
FROM outcomes GROUP BY 1, 2""",
        "request_last_hour": "WITH " + REQUESTS_CTE + """
SELECT CAST(count(*) AS BIGINT) AS requests,
  CAST(count(*) FILTER (WHERE status_code >= 400 AND status_code < 500) AS BIGINT) AS client_errors,
  CAST(count(*) FILTER (WHERE status_code >= 500) AS BIGINT) AS server_errors
FROM outcomes WHERE ts >= TIMESTAMP '{as_of}' - INTERVAL 1 HOUR AND ts < TIMESTAMP '{as_of}'""",
        "error_alarms": "WITH " + REQUESTS_CTE + """,
per AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, CAST(count(*) FILTER (WHERE status_code >= 500) AS BIGINT) AS errors
  FROM outcomes GROUP BY 1
)
SELECT r.rule, window_start, window_start + INTERVAL 1 HOUR AS window_end, errors AS value, r.threshold
FROM per, (VALUES ('ingest_errors', 5), ('server_errors', 10)) r(rule, threshold)
WHERE errors > r.threshold""",
        # Spark's merged schema text for object payloads: fields sorted by
        # name, one kind per field (VARIANT when kinds conflict).
        "schema_discovery": RAW + """,
members AS (
  SELECT source, unnest(json_keys(data)) AS field, data FROM raw_data
),
kinds AS (
  SELECT source, field,
    CASE WHEN count(DISTINCT """ + KIND_OF.format(t="json_type(data, '$.\"' || field || '\"')") + """) = 1
         THEN min(""" + KIND_OF.format(t="json_type(data, '$.\"' || field || '\"')") + """) ELSE 'VARIANT' END AS kind
  FROM members GROUP BY source, field
)
SELECT k.source, 'OBJECT<' || string_agg(field || ': ' || kind, ', ' ORDER BY field) || '>' AS payload_schema,
  (SELECT CAST(count(data) AS BIGINT) FROM raw_data r WHERE r.source = k.source) AS payloads
FROM kinds k GROUP BY k.source""",
        "incremental_process": PROCESSED + """
SELECT source, year, month, day, CAST(count(*) AS BIGINT) AS records,
  CAST(sum(CAST('0x' || substr(record_hash, 1, 8) AS BIGINT)) AS BIGINT) AS content
FROM processed_data GROUP BY ALL""",
        "quarantine": PROCESSED + """,
marked AS (
  SELECT *, substr(ingestion_timestamp, 18, 2) = '21' AS bad FROM processed_data
  WHERE substr(ingestion_timestamp, 18, 2) <> '13'
)
SELECT CASE WHEN bad THEN 'quarantine' ELSE 'processed' END AS output, source,
  CASE WHEN NOT bad THEN year END AS year, CASE WHEN NOT bad THEN month END AS month,
  CASE WHEN NOT bad THEN day END AS day,
  CAST(count(*) AS BIGINT) AS records, CAST(sum(quality_score) AS BIGINT) AS score
FROM marked GROUP BY ALL""",
        "curate_totals": PROCESSED + """
SELECT source, output,
  CAST(count(*) FILTER (WHERE output <> 'hourly' OR substr(ingestion_timestamp, 18, 2) >= '10') AS BIGINT) AS records
FROM processed_data, (VALUES ('daily'), ('source'), ('hourly')) o(output) GROUP BY ALL""",
        "schema_versions": "WITH " + VALIDATION_CTE + GENERATIONS + """
SELECT source, path,
  CASE WHEN o.kinds IS NULL THEN 'added' WHEN n.kinds IS NULL THEN 'removed'
       WHEN o.kinds IN ('BIGINT', 'DECIMAL', 'BIGINT|DECIMAL') AND n.kinds IN ('BIGINT', 'DECIMAL', 'BIGINT|DECIMAL') THEN 'widened'
       ELSE 'type_changed' END AS change, o.kinds AS old_kinds, n.kinds AS new_kinds,
  o.kinds IS NOT NULL AND (n.kinds IS NULL OR NOT (o.kinds IN ('BIGINT', 'DECIMAL', 'BIGINT|DECIMAL')
                                                   AND n.kinds IN ('BIGINT', 'DECIMAL', 'BIGINT|DECIMAL'))) AS breaking
FROM (SELECT * FROM kinds WHERE version = 1) o FULL JOIN (SELECT * FROM kinds WHERE version = 2) n USING (source, path)
WHERE o.kinds IS DISTINCT FROM n.kinds""",
        "merged_versions": "WITH " + VALIDATION_CTE + GENERATIONS + SENSOR_TOTALS.replace("@by", "version").replace(
            "@from", "generations WHERE source = 'iot_sensor'"),
        "discovered_table": "WITH " + VALIDATION_CTE + GENERATIONS + SENSOR_TOTALS.replace("@by", "ingestion_date").replace(
            "@from", """(SELECT text -> '$.data' AS data, CAST(CAST(ts_text AS TIMESTAMP) AS DATE) AS ingestion_date FROM d2
                     WHERE CAST(regexp_extract(key, '_([0-9]+)[.]json$', 1) AS BIGINT) % 16 IN (0, 1, 2, 10)) g"""),
        "validated_outputs": "WITH " + VALIDATION_CTE + """
SELECT status AS output, source, CAST(count(*) AS BIGINT) AS documents, CAST(sum(length(text)) AS BIGINT) AS chars,
  CAST(sum(coalesce(len(all_errors), 0)) AS BIGINT) AS errors
FROM validation GROUP BY ALL
UNION ALL
SELECT 'processed', source, CAST(count(DISTINCT (ts, CAST(text -> '$.data' AS VARCHAR))) AS BIGINT), 0, 0
FROM validation WHERE status = 'valid' AND ts IS NOT NULL AND source IS NOT NULL GROUP BY source""",
        "streaming_validation": "WITH " + VALIDATION_CTE + ", alerts AS (" + VALIDATION_ALERTS + """)
SELECT status, CAST(count(*) AS BIGINT) AS documents, CAST(sum(length(text)) AS BIGINT) AS chars FROM validation GROUP BY status
UNION ALL SELECT 'alert', CAST(count(*) AS BIGINT), CAST(sum(length(message)) AS BIGINT) FROM alerts""",
        "accepted_envelopes": "WITH " + REQUESTS_CTE + """
SELECT src AS source, strftime(o.ts, '%Y-%m-%dT%H:%M:%S.%f') AS ingestion_timestamp,
  CASE WHEN json_exists(body, '$.metadata') THEN CAST(body -> '$.metadata' AS VARCHAR) ELSE '{}' END AS metadata,
  nullif(CAST(body -> '$.data' AS VARCHAR), 'null') AS data,
  strftime(o.ts, '%Y') AS year, strftime(o.ts, '%m') AS month, strftime(o.ts, '%d') AS day
FROM outcomes o JOIN req USING (request_id) WHERE status_code = 200""",
        "curated_tables": CURATED + """
SELECT 'daily' AS output, source, CAST(make_date(year, month, day) AS VARCHAR) AS period, record_count AS records,
  avg_quality_score AS quality, first_ingestion AS first FROM daily_summary
UNION ALL SELECT 'hourly', source, strftime(hour_start, '%Y-%m-%d %H:%M:%S'), events_per_hour, avg_quality, NULL FROM hourly_metrics
UNION ALL SELECT 'source', source, NULL, total_records, avg_quality, first_seen FROM source_statistics""",
        "freshness_alarms": PROCESSED + """
SELECT 'no_data' AS rule, source, max(ingestion_timestamp) AS last_data_received,
  date_sub('minute', CAST(max(ingestion_timestamp) AS TIMESTAMP), TIMESTAMP '2024-01-31 01:45:00') AS value, 120 AS threshold
FROM processed_data GROUP BY source
HAVING date_sub('minute', CAST(max(ingestion_timestamp) AS TIMESTAMP), TIMESTAMP '2024-01-31 01:45:00') > 120""",
    }
    return {k: _fill(v) for k, v in out.items()}


ORACLE_SQL.update(_more())
