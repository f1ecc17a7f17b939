"""Load-history questions."""

from pyspark.sql import functions as F

from ..operators import health as H, history as O
from . import derive as D
from .derive import AS_OF, with_sql
from .registry import query

W = with_sql("load_history")
S = f"TIMESTAMP '{AS_OF}'"


def _sql(body, *ctes):
    return (with_sql(*ctes) if ctes else W) + body.replace("{as_of}", S)


def _reg(name, fn, body, *ctes):
    query(name, _sql(body, *ctes))(fn)


def _hist(name, op, body, **kw):
    _reg(name, lambda s, d: op(D.load_history(s, d), as_of=AS_OF, **kw), body)


query("copy_history", _sql("""
SELECT * FROM load_history WHERE lower(table_name) = 'raw.events' AND last_load_time >= TIMESTAMP '2024-01-01 00:00:00' """))(
    lambda s, d: O.copy_history(D.load_history(s, d), "RAW.EVENTS", "2024-01-01 00:00:00"))

_hist("status_summary", O.status_summary, """
SELECT status, count(*)::BIGINT AS file_count, sum(row_count)::BIGINT AS total_rows_loaded, sum(row_parsed)::BIGINT AS total_rows_parsed,
  sum(row_parsed - row_count)::BIGINT AS rows_skipped, min(last_load_time) AS earliest_load, max(last_load_time) AS latest_load
FROM load_history WHERE last_load_time > {as_of} - INTERVAL 30 DAY GROUP BY status """, days=30)
_hist("status_summary_by_pipe", O.status_summary, """
SELECT pipe_name, status, count(*)::BIGINT AS file_count, sum(row_count)::BIGINT AS total_rows_loaded, sum(row_parsed)::BIGINT AS total_rows_parsed,
  sum(row_parsed - row_count)::BIGINT AS rows_skipped, min(last_load_time) AS earliest_load, max(last_load_time) AS latest_load
FROM load_history WHERE last_load_time > {as_of} - INTERVAL 30 DAY GROUP BY pipe_name, status """, days=30, by_pipe=True)
_hist("failed_loads", O.failed_loads, """
SELECT file_name, pipe_name, status, first_error_message, first_error_line_number, first_error_column_name, row_parsed, row_count, last_load_time
FROM load_history WHERE status <> 'LOADED' AND last_load_time > {as_of} - INTERVAL 30 DAY """, days=30)
_hist("failed_files", O.failed_files, """
SELECT DISTINCT file_name, stage_location, status FROM load_history
WHERE status IN ('LOAD_FAILED', 'PARTIALLY_LOADED') AND last_load_time > {as_of} - INTERVAL 30 DAY """, days=30)
_hist("hourly_volume", O.hourly_volume, """
SELECT date_trunc('hour', last_load_time)::TIMESTAMP AS load_hour, count(*)::BIGINT AS files_loaded, sum(row_count)::BIGINT AS rows_loaded,
  round(avg(row_count), 6) AS avg_rows_per_file
FROM load_history WHERE status = 'LOADED' AND last_load_time > {as_of} - INTERVAL 30 DAY GROUP BY 1 """, days=30)
_hist("daily_summary_by_table", O.daily_by_table, """
SELECT table_name, date_trunc('day', last_load_time)::TIMESTAMP AS load_date, count(*)::BIGINT AS files_loaded, sum(row_count)::BIGINT AS total_rows,
  count(*) FILTER (status <> 'LOADED')::BIGINT AS failed_files
FROM load_history WHERE last_load_time > {as_of} - INTERVAL 30 DAY GROUP BY 1, 2 """)
_hist("error_patterns", O.error_patterns, """
SELECT regexp_extract(first_error_message, '^[^:]+') AS error_type, count(*)::BIGINT AS occurrence_count,
  count(DISTINCT file_name)::BIGINT AS affected_files, max(last_load_time) AS most_recent
FROM load_history WHERE status <> 'LOADED' AND last_load_time > {as_of} - INTERVAL 30 DAY GROUP BY 1 """)
_hist("duplicate_files", O.duplicate_files, """
SELECT file_name, table_name, count(*)::BIGINT AS load_count, min(last_load_time) AS first_load, max(last_load_time) AS last_load
FROM load_history WHERE last_load_time > {as_of} - INTERVAL 30 DAY
GROUP BY file_name, table_name HAVING count(*) > 1 """, loaded_only=False)
_hist("load_sla", O.load_sla, """
, t AS (SELECT table_name, last_load_time, lag(last_load_time) OVER (PARTITION BY table_name ORDER BY last_load_time, file_name) AS prev_load_time
  FROM load_history WHERE status = 'LOADED' AND last_load_time > {as_of} - INTERVAL 30 DAY)
SELECT table_name, last_load_time, prev_load_time, date_diff('minute', prev_load_time, last_load_time) AS minutes_since_last,
  CASE WHEN date_diff('minute', prev_load_time, last_load_time) > 60 THEN 'LATE' ELSE 'OK' END AS sla_status
FROM t WHERE prev_load_time IS NOT NULL """, days=30)
_hist("hours_since_load", O.hours_since_load, """
SELECT table_name, max(last_load_time) AS last_load, date_diff('hour', max(last_load_time), {as_of}) AS hours_since_load
FROM load_history WHERE status = 'LOADED' AND last_load_time > {as_of} - INTERVAL 30 DAY GROUP BY table_name """, days=30)
_hist("migration_progress", O.migration_progress, """
SELECT date_trunc('hour', last_load_time)::TIMESTAMP AS hour, count(*)::BIGINT AS files_loaded, sum(row_count)::BIGINT AS rows_loaded,
  round(sum(file_size)::DOUBLE / 1e9, 9) AS gb_loaded
FROM load_history WHERE last_load_time > {as_of} - INTERVAL 30 DAY GROUP BY 1 """, days=30)
_hist("incremental_history", O.incremental_history, """
SELECT date_trunc('day', last_load_time)::TIMESTAMP AS load_date, count(*)::BIGINT AS load_count, sum(row_count)::BIGINT AS total_rows,
  round(avg(row_count), 6) AS avg_rows_per_load
FROM load_history WHERE last_load_time > {as_of} - INTERVAL 30 DAY GROUP BY 1 """, days=30)
_hist("pipe_history", O.pipe_history, """
SELECT pipe_name, file_name, status, row_count, first_error_message, last_load_time
FROM load_history WHERE pipe_name IS NOT NULL AND last_load_time > {as_of} - INTERVAL 720 HOUR """, hours=720)
_hist("pipe_throughput", O.pipe_throughput, """
SELECT pipe_name, date_trunc('hour', last_load_time)::TIMESTAMP AS hour, count(*)::BIGINT AS files_loaded, sum(row_count)::BIGINT AS rows_loaded,
  round(avg(row_count), 6) AS avg_rows_per_file, count(*) FILTER (status <> 'LOADED')::BIGINT AS failed_files
FROM load_history WHERE pipe_name IS NOT NULL AND last_load_time > {as_of} - INTERVAL 30 DAY GROUP BY 1, 2 """, days=30)
_hist("failing_patterns", O.failing_patterns, """
SELECT pipe_name, regexp_extract(file_name, '[^/]+$') AS file_name_only, status, first_error_message, count(*)::BIGINT AS occurrence
FROM load_history WHERE pipe_name IS NOT NULL AND status <> 'LOADED' AND last_load_time > {as_of} - INTERVAL 720 HOUR GROUP BY 1, 2, 3, 4 """, hours=720)
_hist("skipped_rows", O.skipped_rows, """
SELECT file_name, status, row_parsed, row_count, row_parsed - row_count AS skipped_rows,
  round((row_parsed - row_count)::DOUBLE * 100.0::DOUBLE / row_parsed, 2) AS skip_pct, first_error_message, first_error_line_number
FROM load_history WHERE row_parsed > row_count AND last_load_time > {as_of} - INTERVAL 30 DAY """, days=30)
_hist("error_rate_daily", O.error_rate_daily, """
SELECT date_trunc('day', last_load_time)::TIMESTAMP AS load_date, status, count(*)::BIGINT AS file_count, sum(row_parsed)::BIGINT AS total_parsed,
  sum(row_count)::BIGINT AS total_loaded, round(sum(row_parsed - row_count)::DOUBLE * 100.0::DOUBLE / nullif(sum(row_parsed)::DOUBLE, 0), 2) AS error_pct
FROM load_history WHERE last_load_time > {as_of} - INTERVAL 30 DAY GROUP BY 1, 2 """)
_hist("skip_rate_weekly", O.skip_rate_weekly, """
SELECT date_trunc('week', last_load_time)::TIMESTAMP AS week, sum(row_parsed)::BIGINT AS total_parsed, sum(row_count)::BIGINT AS total_loaded,
  sum(row_parsed - row_count)::BIGINT AS total_skipped, round(sum(row_parsed - row_count)::DOUBLE * 100.0::DOUBLE / sum(row_parsed)::DOUBLE, 2) AS skip_pct
FROM load_history WHERE last_load_time > {as_of} - INTERVAL 30 DAY GROUP BY 1 """)
_HEALTH = """
, health AS (SELECT date_trunc('day', last_load_time)::TIMESTAMP AS load_date, table_name, count(*)::BIGINT AS load_count, sum(row_parsed)::BIGINT AS total_parsed,
  sum(row_count)::BIGINT AS total_loaded, sum(row_parsed - row_count)::BIGINT AS total_skipped, count(*) FILTER (status = 'LOAD_FAILED')::BIGINT AS failed_loads,
  round(sum(row_parsed - row_count)::DOUBLE * 100.0::DOUBLE / nullif(sum(row_parsed)::DOUBLE, 0), 2) AS skip_pct
FROM load_history WHERE last_load_time > {as_of} - INTERVAL 30 DAY GROUP BY 1, 2)
SELECT * FROM health """
_hist("load_health", O.load_health, _HEALTH)
_hist("load_health_issues", O.load_health, _HEALTH + "WHERE skip_pct > 1 OR failed_loads > 0", issues_only=True)


def _rejects(s, d):
    """Reject rows name their table; a third of them has no table name (the NULL trap)."""
    return D.raw_events(s, d).select(
        F.when(F.col("user_id") % 3 != 0, "raw.orders").alias("target_table"))


_reg("unmonitored_tables", lambda s, d: O.unmonitored_tables(D.load_history(s, d), _rejects(s, d), AS_OF, days=30), """
SELECT DISTINCT table_name FROM load_history h WHERE row_parsed > row_count AND last_load_time > {as_of} - INTERVAL 30 DAY
  AND NOT EXISTS (SELECT 1 FROM raw_events e WHERE e.user_id % 3 <> 0 AND h.table_name = 'raw.orders') """,
     "load_history", "raw_events")
_reg("load_tracking", lambda s, d: O.load_tracking(D.load_history(s, d), AS_OF), """
SELECT md5(table_name || '|' || file_name || '|' || strftime(last_load_time, '%Y-%m-%d %H:%M:%S')
    || CASE WHEN microsecond(last_load_time) % 1000000 = 0 THEN '' ELSE '.' || rtrim(lpad((microsecond(last_load_time) % 1000000)::VARCHAR, 6, '0'), '0') END) AS load_id,
  file_name, md5(file_name || '|' || file_size::VARCHAR) AS file_hash, last_load_time AS loaded_at, row_count
FROM load_history """)


# ---- pipe health ------------------------------------------------------------------------
_STATUS = """
, st AS (SELECT pipe_name, json_extract_string(status_json, '$.executionState') AS state,
  json_extract_string(status_json, '$.pendingFileCount')::INTEGER AS pending_files,
  json_extract_string(status_json, '$.lastReceivedMessageTimestamp')::TIMESTAMP AS last_message,
  json_extract_string(status_json, '$.notificationChannelName') AS notification_channel FROM pipe_status) """
_reg("pipe_status", lambda s, d: H.parse_status(D.pipe_status(s, d)), _STATUS + "SELECT * FROM st", "pipe_status")
_reg("pipe_issues", lambda s, d: H.pipe_issues(D.pipe_status(s, d)),
     _STATUS + "SELECT * FROM st WHERE state IN ('PAUSED', 'STALLED') OR pending_files > 1000", "pipe_status")
_reg("notification_health", lambda s, d: H.notification_health(D.pipe_status(s, d), AS_OF), _STATUS + """
SELECT pipe_name, last_message, date_diff('minute', last_message, {as_of}) AS minutes_since_last_message,
  CASE WHEN date_diff('minute', last_message, {as_of}) > 60 THEN 'WARNING' WHEN date_diff('minute', last_message, {as_of}) > 15 THEN 'CHECK' ELSE 'OK' END AS health_status
FROM st """, "pipe_status")
_reg("health_check", lambda s, d: H.health_check(
    D.pipe_status(s, d), D.load_history(s, d), D.raw_events(s, d), AS_OF, hours=720), _STATUS + """
, recent AS (SELECT * FROM load_history WHERE last_load_time > {as_of} - INTERVAL 720 HOUR)
, pt AS (SELECT table_name, count(*)::BIGINT AS failed, sum(row_parsed - row_count)::BIGINT AS skipped FROM recent
  WHERE status = 'LOAD_FAILED' OR row_parsed > row_count GROUP BY table_name)
SELECT 'stalled' AS check_name, pipe_name AS subject, pending_files::BIGINT AS value FROM st WHERE state = 'STALLED'
UNION ALL SELECT 'paused', pipe_name, pending_files::BIGINT FROM st WHERE state = 'PAUSED'
UNION ALL SELECT 'backlog', pipe_name, pending_files::BIGINT FROM st WHERE pending_files > 1000
UNION ALL SELECT 'failed_loads', table_name, failed FROM pt WHERE failed > 0
UNION ALL SELECT 'skipped_rows', table_name, skipped FROM pt WHERE skipped > 100
UNION ALL SELECT 'behind', 'all', v FROM (SELECT date_diff('minute', max(_loaded_at), {as_of}) AS v FROM raw_events) WHERE v > 30
UNION ALL SELECT 'few_files', 'all', v FROM (SELECT count(DISTINCT file_name)::BIGINT AS v FROM recent) WHERE v < 1 """,
     "pipe_status", "load_history", "raw_events")
_reg("pipe_metrics", lambda s, d: H.pipe_metrics(D.pipe_status(s, d), AS_OF), _STATUS + """
SELECT {as_of} AS check_time, pipe_name, state AS execution_state, pending_files FROM st """, "pipe_status")


def _transforms(s, d):
    e = D.raw_events(s, d)
    return e.groupBy(
        F.concat(F.lit("stg_"), F.when(F.col("event_type") == "view", "events").otherwise(F.col("event_type"))).alias("model_name"),
        F.when(F.col("user_id") % 2 == 0, "success").otherwise("error").alias("status"),
        F.date_trunc("day", "event_timestamp").cast("timestamp_ntz").alias("run_started_at"),
    ).agg(F.max("_loaded_at").alias("completed_at"))


_reg("load_transform_status", lambda s, d: H.load_transform_status(
    D.load_history(s, d), _transforms(s, d), AS_OF, hours=720), """
, runs AS (SELECT 'stg_' || CASE WHEN event_type = 'view' THEN 'events' ELSE event_type END AS model_name,
  CASE WHEN user_id % 2 = 0 THEN 'success' ELSE 'error' END AS status, date_trunc('day', event_timestamp)::TIMESTAMP AS run_started_at,
  max(_loaded_at) AS completed_at FROM raw_events GROUP BY 1, 2, 3)
, loads AS (SELECT table_name, max(last_load_time) AS loaded_at, sum(row_count)::BIGINT AS rows_loaded FROM load_history
  WHERE last_load_time > {as_of} - INTERVAL 720 HOUR GROUP BY table_name)
, t AS (SELECT model_name, status, max(completed_at) AS transformed_at FROM runs WHERE run_started_at > {as_of} - INTERVAL 720 HOUR GROUP BY 1, 2)
SELECT l.table_name, loaded_at, rows_loaded, transformed_at, t.status AS transform_status, date_diff('minute', loaded_at, transformed_at) AS load_to_transform_minutes
FROM loads l LEFT JOIN t ON t.model_name = 'stg_' || lower(split_part(l.table_name, '.', -1)) """, "load_history", "raw_events")
