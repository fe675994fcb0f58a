"""DuckDB CTE text for the stand-in views (mirrors cyclewise.sources.tables)."""

TELEMETRY_LINEITEM = """telemetry_lineitem AS (
  SELECT l_suppkey AS unit_id,
         CAST(row_number() OVER (PARTITION BY l_suppkey
              ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS INTEGER) AS time_cycle,
         l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate
  FROM lineitem)"""

TELEMETRY_EVENTS = """telemetry_events AS (
  SELECT user_id AS unit_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS time_cycle,
         ts, event_type, value
  FROM events)"""

DRIFT_LONG = """drift_long AS (
  SELECT event_type AS feature, value,
         CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'ref' ELSE 'cur' END AS side
  FROM events)"""

PREDICTION_LOG = """prediction_log AS (
  SELECT event_id AS request_id, ts,
         CASE CAST(json_extract_string(props, '$.k') AS BIGINT) % 3
              WHEN 0 THEN 'forest' WHEN 1 THEN 'boosted' ELSE 'sequence' END AS model_type,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
         value / 1000.0 AS latency_s,
         user_id AS unit_id,
         value AS rul
  FROM events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

SCORED = """scored AS (
  SELECT * FROM (
    SELECT CASE CAST(json_extract_string(props, '$.k') AS BIGINT) % 3
                WHEN 0 THEN 'forest' WHEN 1 THEN 'boosted' ELSE 'sequence' END AS model_type,
           ts, event_id AS request_id,
           CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'ref' ELSE 'cur' END AS side,
           avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS prediction,
           value AS actual
    FROM events) WHERE prediction IS NOT NULL)"""

MEMBERS = """members AS (
  SELECT unit_id, time_cycle, ts, value AS y,
         lag(value, 1) OVER w AS forest,
         CASE WHEN time_cycle > 5 THEN avg(value) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) END AS boosted,
         CASE WHEN time_cycle > 20 THEN avg(value) OVER (w ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) END AS sequence
  FROM telemetry_events
  WINDOW w AS (PARTITION BY unit_id ORDER BY time_cycle))"""

MEMBERS_LONG = """members_long AS (
  SELECT unit_id, time_cycle, ts, y, 'forest' AS model, forest AS prediction FROM members WHERE forest IS NOT NULL
  UNION ALL SELECT unit_id, time_cycle, ts, y, 'boosted', boosted FROM members WHERE boosted IS NOT NULL
  UNION ALL SELECT unit_id, time_cycle, ts, y, 'sequence', sequence FROM members WHERE sequence IS NOT NULL)"""
