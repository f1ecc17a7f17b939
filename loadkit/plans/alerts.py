"""Alert evaluation and history."""

from pyspark.sql import functions as F

from ..operators import alerts as O, freshness as FR, schema as SC
from . import derive as D
from .derive import AS_OF, table, with_sql
from .registry import query
from .rejects import rejected

S = f"TIMESTAMP '{AS_OF}'"


def _rules(s, d):
    hist, events = D.load_history(s, d), D.raw_events(s, d)
    fresh = FR.freshness({"events": (events, "_loaded_at"), "orders": (table(s, d, "orders"), "o_orderdate")}, AS_OF)
    orders = SC.schema_frame(s, table(s, d, "orders").schema)
    return [
        O.copy_failures(hist, AS_OF, hours=720), O.pipe_stalled(D.pipe_status(s, d)), O.no_recent_data(events, "event_timestamp", AS_OF),
        O.error_rate(hist, AS_OF, hours=720), O.skip_rate(hist, AS_OF, hours=720, limit=50),
        O.daily_cost([D.pipe_usage(s, d), D.stream_migration(s, d)], AS_OF, days=30, limit=20), O.reject_rate(rejected(s, d), AS_OF, hours=720),
        O.duplicate_keys(D.doubled_events(s, d), "event_id"), O.schema_drift(SC.schema_diff(orders, orders)), O.stale_source(fresh),
        *O.quota(D.pipe_usage(s, d), AS_OF, 12.0),
    ]


_ALERTS = with_sql("load_history", "pipe_status", "pipe_usage", "stream_migration", "doubled_events") + f"""
, r AS (SELECT sum(row_parsed - row_count) * 100.0 / sum(row_parsed) AS e FROM load_history WHERE last_load_time > {S} - INTERVAL 720 HOUR)
, q AS (SELECT round(sum(credits_used) * 100.0::DOUBLE / 12.0::DOUBLE, 6) AS v FROM pipe_usage WHERE start_time >= date_trunc('month', {S}) AND start_time <= {S})
, a AS (
SELECT 'copy_failures' AS alert_type, 'error' AS severity, count(*)::DOUBLE AS value, count(*) > 0 AS fired FROM load_history WHERE status = 'LOAD_FAILED' AND last_load_time > {S} - INTERVAL 720 HOUR
UNION ALL SELECT 'pipe_stalled', 'error', count(*)::DOUBLE, count(*) > 0 FROM pipe_status WHERE json_extract_string(status_json, '$.executionState') = 'STALLED' OR json_extract_string(status_json, '$.pendingFileCount')::INTEGER > 1000
UNION ALL SELECT 'no_recent_data', 'error', (epoch({S})::BIGINT - floor(epoch(max(ts)))::BIGINT) / 3600.0::DOUBLE, (epoch({S})::BIGINT - floor(epoch(max(ts)))::BIGINT) / 3600.0::DOUBLE > 4 FROM events
UNION ALL SELECT 'error_rate', 'error', round(e::DOUBLE, 6), e > 5 FROM r UNION ALL SELECT 'skip_rate', 'error', round(e::DOUBLE, 6), e > 50 FROM r
UNION ALL SELECT 'daily_cost', 'error', round(sum(credits_used), 6), sum(credits_used) > 20 FROM (SELECT start_time, credits_used FROM pipe_usage UNION ALL SELECT start_time, credits_used FROM stream_migration) WHERE start_time > {S} - INTERVAL 30 DAY
UNION ALL SELECT 'reject_rate', 'error', count(*)::DOUBLE, count(*) > 100 FROM events WHERE ts > {S} - INTERVAL 720 HOUR
UNION ALL SELECT 'duplicate_keys', 'error', (count(*) - count(DISTINCT event_id))::DOUBLE, count(*) > count(DISTINCT event_id) FROM doubled_events
UNION ALL SELECT 'schema_drift', 'error', 0::DOUBLE, false
UNION ALL SELECT 'stale_source', 'error', count(*)::DOUBLE, count(*) > 0 FROM (SELECT date_diff('minute', max(_loaded_at), {S}) >= 30 AS bad FROM raw_events UNION ALL SELECT date_diff('minute', max(o_orderdate), {S}) >= 120 FROM orders) WHERE bad
UNION ALL SELECT 'quota_75', 'warn', v, v >= 75 FROM q UNION ALL SELECT 'quota_90', 'warn', v, v >= 90 FROM q UNION ALL SELECT 'quota_100', 'error', v, v >= 100 FROM q)
"""
query("evaluate_alerts", _ALERTS + f"SELECT alert_type, severity, value, fired, {S} AS created_at FROM a")(lambda s, d: O.evaluate_alerts(_rules(s, d), AS_OF))
query("alert_history", _ALERTS + f"SELECT alert_type, {S} AS created_at, fired FROM a WHERE fired AND alert_type <> 'reject_rate'")(
    lambda s, d: O.alert_history(O.alert_log(O.evaluate_alerts(_rules(s, d), AS_OF)), AS_OF, suspended=["reject_rate"]).drop("message"))
