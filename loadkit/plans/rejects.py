"""Reject lifecycle and recovery."""

from pyspark.sql import functions as F

from ..functions.times import parse_timestamp
from ..operators import copy as C, ledger, merge as M, rejects as R
from ..operators.versioned import Table
from ..session import work_path
from ..sources.formats import FileFormat
from ..sources.stage import list_stage
from . import derive as D, stages as G
from .copying import EVENT_SCHEMA, W as STAGED
from .derive import AS_OF, table, with_sql
from .registry import query

S = f"TIMESTAMP '{AS_OF}'"

# Rejects derived from every `error` and `signup` event: the message by type, the time in another format.
_REJ = """
, rej AS (SELECT event_id AS rejection_id, event_timestamp AS rejection_time, 'raw.' || CASE WHEN user_id % 2 = 0 THEN 'events' ELSE 'orders' END AS target_table, _source_file AS source_file,
  CASE WHEN event_type = 'error' THEN 'Timestamp: timestamp not recognized' ELSE 'Numeric value: not recognized' END AS error_message,
  CASE WHEN event_type = 'error' THEN 'event_timestamp' ELSE 'value' END AS error_column,
  CASE WHEN user_id % 5 = 0 THEN 'RESOLVED' ELSE 'PENDING' END AS retry_status FROM raw_events) """
W = with_sql("raw_events") + _REJ


def rejected(s, d):
    e = D.raw_events(s, d)
    is_time = F.col("event_type") == "error"
    text = F.when(F.col("user_id") % 3 == 0, F.date_format("event_timestamp", "MM/dd/yyyy")).otherwise("unknown")
    return e.select(
        F.col("event_id").alias("rejection_id"), F.col("event_timestamp").alias("rejection_time"),
        F.concat(F.lit("raw."), F.when(F.col("user_id") % 2 == 0, "events").otherwise("orders")).alias("target_table"),
        F.col("_source_file").alias("source_file"), (F.col("event_id") % 1000).alias("source_line"),
        F.when(is_time, "Timestamp: timestamp not recognized").otherwise("Numeric value: not recognized").alias("error_message"),
        F.when(is_time, "event_timestamp").otherwise("value").alias("error_column"),
        F.to_json(F.struct("event_id", "event_type", text.alias("timestamp"))).alias("rejected_data"),
        F.when(F.col("user_id") % 5 == 0, "RESOLVED").otherwise("PENDING").alias("retry_status"),
        F.lit(0).alias("retry_count"), F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
    )


def _reg(name, fn, body, head=W):
    query(name, head + body)(fn)


_reg("rejects_by_error", lambda s, d: R.rejects_by_error(rejected(s, d), AS_OF, days=30), f"""
SELECT error_message, count(*)::BIGINT AS occurrence_count, min(rejection_time) AS first_seen, max(rejection_time) AS last_seen FROM rej WHERE rejection_time > {S} - INTERVAL 30 DAY GROUP BY 1 """)
_reg("rejects_by_file", lambda s, d: R.rejects_by_file(rejected(s, d), AS_OF, days=30), f"""
SELECT source_file, count(*)::BIGINT AS error_count, string_agg(DISTINCT error_message, ', ' ORDER BY error_message) AS error_types FROM rej WHERE rejection_time > {S} - INTERVAL 30 DAY GROUP BY 1 """)
_reg("rejects_by_column", lambda s, d: R.rejects_by_column(rejected(s, d)), """
SELECT error_column, error_message, count(*)::BIGINT AS row_count FROM rej GROUP BY 1, 2 """)
_reg("rejects_hourly", lambda s, d: R.rejects_hourly(rejected(s, d), AS_OF, days=30), f"""
SELECT date_trunc('hour', rejection_time)::TIMESTAMP AS hour, count(*)::BIGINT AS rejected_count FROM rej WHERE rejection_time > {S} - INTERVAL 30 DAY GROUP BY 1 """)


def _fixed():
    return {"event_id": F.get_json_object("rejected_data", "$.event_id").cast("bigint"), "event_type": F.get_json_object("rejected_data", "$.event_type")}


_reg("retry_rejects_rows", lambda s, d: R.retry_rejects(rejected(s, d), R.fixed_timestamp(), AS_OF, _fixed() | {"event_timestamp": R.fixed_timestamp()})[0], """
SELECT event_id, event_type, date_trunc('day', event_timestamp)::TIMESTAMP AS event_timestamp FROM raw_events WHERE event_type = 'error' AND user_id % 3 = 0 AND user_id % 5 <> 0 """)
_reg("retry_rejects_status", lambda s, d: R.retry_rejects(rejected(s, d), R.fixed_timestamp(), AS_OF, _fixed())[1].groupBy("retry_status", "resolved_at").agg(
    F.count(F.lit(1)).alias("n")), f"""
, z AS (SELECT CASE WHEN user_id % 5 = 0 THEN 'RESOLVED' WHEN event_type = 'error' AND user_id % 3 = 0 THEN 'RESOLVED' ELSE 'PENDING' END AS retry_status,
  CASE WHEN user_id % 5 <> 0 AND event_type = 'error' AND user_id % 3 = 0 THEN {S} END AS resolved_at FROM raw_events)
SELECT retry_status, resolved_at, count(*)::BIGINT AS n FROM z GROUP BY 1, 2 """)
_EXPIRED = f"""
, old AS (SELECT *, CASE WHEN retry_status = 'PENDING' AND rejection_time < {S} - INTERVAL 7 DAY THEN 'PERMANENT_FAILURE' ELSE retry_status END AS st FROM rej) """
_reg("expire_rejects", lambda s, d: R.expire_rejects(rejected(s, d), AS_OF).groupBy("retry_status", "retry_count").agg(F.count(F.lit(1)).alias("n")), _EXPIRED + """
SELECT st AS retry_status, CASE WHEN st = 'PERMANENT_FAILURE' THEN 1 ELSE 0 END::INTEGER AS retry_count, count(*)::BIGINT AS n FROM old GROUP BY 1, 2 """)


def _dead_letters(s, d):
    """Permanent failures, against a queue that holds those of raw.orders and one NULL id."""
    rej = R.expire_rejects(rejected(s, d), AS_OF)
    queue = R.to_dead_letters(rej.where("target_table = 'raw.orders'"), None, AS_OF)
    queue = queue.withColumn("original_rejection_id", F.when(F.col("original_rejection_id") > 0, F.col("original_rejection_id")))
    return R.to_dead_letters(rej, queue, AS_OF).select("original_rejection_id", "target_table", "source_file", "error_message", "moved_at")


_reg("to_dead_letters", _dead_letters, _EXPIRED + f"""
SELECT rejection_id AS original_rejection_id, target_table, source_file, error_message, {S} AS moved_at FROM old WHERE st = 'PERMANENT_FAILURE' AND (target_table <> 'raw.orders' OR rejection_id = 0) """)
_reg("reject_report", lambda s, d: R.reject_report(rejected(s, d), AS_OF), f"""
SELECT date_trunc('day', rejection_time)::TIMESTAMP AS day, target_table, retry_status, count(*)::BIGINT AS row_count FROM rej WHERE rejection_time > {S} - INTERVAL 30 DAY GROUP BY 1, 2, 3 """)
_reg("resolution_rate", lambda s, d: R.resolution_rate(R.expire_rejects(rejected(s, d), AS_OF)), _EXPIRED + """
SELECT date_trunc('week', rejection_time)::TIMESTAMP AS week, count(*)::BIGINT AS total_rejected, count(*) FILTER (st = 'RESOLVED')::BIGINT AS resolved, count(*) FILTER (st = 'PERMANENT_FAILURE')::BIGINT AS permanent_failures,
  count(*) FILTER (st = 'PENDING')::BIGINT AS pending, round(count(*) FILTER (st = 'RESOLVED')::DOUBLE * 100.0::DOUBLE / count(*)::DOUBLE, 1) AS resolution_rate_pct FROM old GROUP BY 1 """)


def _classified(s, d):
    e = D.raw_events(s, d)
    doc = e.select("event_id", F.when(F.col("user_id") % 4 == 0, "nope").otherwise(F.col("event_id").cast("string")).alias("id_text"),
                   F.when(F.col("user_id") % 6 == 0, "31/31/2024").otherwise(F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss")).alias("time_text"))
    return R.classify_rejects(doc, [
        (F.col("id_text").try_cast("bigint").isNull(), "Invalid event_id"),
        (parse_timestamp("time_text", "YYYY-MM-DD HH24:MI:SS").isNull(), "Invalid timestamp")]).select("event_id", "error_message")


_reg("classify_rejects", _classified, """
SELECT event_id, CASE WHEN user_id % 4 = 0 THEN 'Invalid event_id' ELSE 'Invalid timestamp' END AS error_message FROM raw_events WHERE user_id % 4 = 0 OR user_id % 6 = 0 """)


def _captured(s, d):
    t = Table(s, work_path(s, "captured"))
    report, rejects = C.load_with_capture(s, t, G.json_stage(s, d), FileFormat.json(), EVENT_SCHEMA, AS_OF, "raw.events")
    return rejects.select(G.file_dir("source_file").alias("source_file"), "source_line", "error_message", "error_column", "retry_status")


_reg("load_with_capture", _captured, """
SELECT 'd=' || d || '/batch=' || batch::VARCHAR AS source_file, line AS source_line, CASE WHEN b2 THEN 'Record: cannot be parsed' ELSE 'Numeric value: not recognized' END AS error_message,
  CASE WHEN NOT b2 THEN 'value' END AS error_column, 'PENDING' AS retry_status FROM staged WHERE b1 OR b2 """, STAGED)


def _split(s, d):
    e = D.raw_events(s, d).select("event_id", F.when(F.col("user_id") % 4 == 0, "x").otherwise(F.col("user_id").cast("string")).alias("user_id"),
                                  F.when(F.col("user_id") % 6 == 0, "y").otherwise(F.col("value").cast("string")).alias("value"))
    return R.split_bad_rows(e, {"user_id": "bigint", "value": "double"}, "event_id")


_reg("insert_errors", lambda s, d: _split(s, d)[1], """
SELECT event_id, 'user_id' AS column_name, 'not recognized: user_id' AS error FROM raw_events WHERE user_id % 4 = 0
UNION ALL SELECT event_id, 'value', 'not recognized: value' FROM raw_events WHERE user_id % 6 = 0 """)
_reg("insert_good_rows", lambda s, d: _split(s, d)[0], "SELECT event_id, user_id, value FROM raw_events WHERE user_id % 4 <> 0 AND user_id % 6 <> 0 ")

# ---- recovery --------------------------------------------------------------------------------


def _retried(s, d):
    """Files skipped for their errors, then loaded again keeping the good rows."""
    t = Table(s, work_path(s, "retried"))
    stage = G.json_stage(s, d)
    C.copy_into(s, t, stage, FileFormat.json(), EVENT_SCHEMA, AS_OF, on_error="SKIP_FILE")
    before = t.read().count()
    report, log = R.retry_failed_loads(s, t, stage, FileFormat.json(), EVENT_SCHEMA, "2024-01-31 01:00:00")
    return log.select(F.size("files").cast("bigint").alias("files"), "rows_recovered", "status", F.lit(before).cast("bigint").alias("rows_before"), F.lit(t.read().count()).cast("bigint").alias("rows_after"))


_reg("retry_failed_loads", _retried, """
SELECT count(*) FILTER (bad > 0)::BIGINT AS files, sum(CASE WHEN bad > 0 THEN parsed - bad END)::BIGINT AS rows_recovered, 'COMPLETED' AS status,
  sum(CASE WHEN bad = 0 THEN parsed ELSE 0 END)::BIGINT AS rows_before, sum(parsed - bad)::BIGINT AS rows_after FROM files """, STAGED)


def _backfill(s, d):
    """A day loaded again with FORCE into staging, then only its missing keys inserted."""
    t, staging = Table(s, work_path(s, "events")), Table(s, work_path(s, "reload"))
    stage = G.json_stage(s, d)
    C.copy_into(s, t, stage, FileFormat.json(), EVENT_SCHEMA, AS_OF, on_error="CONTINUE")
    M.replace_rows(t, lambda now: M.delete_where(now, F.to_date("event_timestamp") == F.lit("2024-01-15").cast("date")), AS_OF, "delete")
    lost = t.read().count()
    C.copy_into(s, staging, stage, FileFormat.json(), EVENT_SCHEMA, AS_OF, on_error="CONTINUE", pattern=r"d=2024-01-1[4-6]/.*", force=True)
    M.replace_rows(t, lambda now: M.insert_only(now, staging.read(), ["event_id"]), AS_OF, "insert")
    return t.read().agg(F.lit(lost).cast("bigint").alias("rows_without_day"), F.count(F.lit(1)).alias("rows_after"), F.count_distinct("event_id").alias("ids"))


_reg("backfill", _backfill, """
SELECT count(*) FILTER (d <> '2024-01-15')::BIGINT AS rows_without_day, count(*)::BIGINT AS rows_after, count(DISTINCT event_id)::BIGINT AS ids FROM staged WHERE NOT b1 AND NOT b2 """, STAGED)
_reg("reload_overlap", lambda s, d: R.reload_overlap(D.doubled_events(s, d), D.raw_events(s, d).where("user_id % 2 = 0"), "event_id"), """
SELECT count(*)::BIGINT AS staged_rows, count(DISTINCT event_id)::BIGINT AS unique_ids, (count(*) - count(DISTINCT event_id))::BIGINT AS duplicates_in_staged,
  count(*) FILTER (user_id % 2 = 0)::BIGINT AS already_exists FROM doubled_events """, with_sql("doubled_events"))
_reg("staged_duplicates", lambda s, d: R.staged_duplicates(D.doubled_events(s, d), D.raw_events(s, d).where("event_type = 'error'"), "event_id"),
     "SELECT event_id FROM raw_events WHERE event_type = 'error' ")
_reg("staged_quality", lambda s, d: R.staged_quality(
    table(s, d, "lineitem").withColumn("l_tax", F.when(F.col("l_tax") > 0.05, F.col("l_tax"))), "l_shipdate", ["l_orderkey", "l_tax"],
    {"high_discount": F.col("l_discount") > 0.05, "small_quantity": F.col("l_quantity") <= 2}), """
SELECT l_shipdate, count(*)::BIGINT AS total_rows, 0::BIGINT AS null_l_orderkey, count(*) FILTER (NOT l_tax > 0.05)::BIGINT AS null_l_tax, count(*) FILTER (l_discount > 0.05)::BIGINT AS high_discount,
  count(*) FILTER (l_quantity <= 2)::BIGINT AS small_quantity FROM lineitem GROUP BY 1 """, "")


def _gate(s, d):
    t = Table(s, work_path(s, "gate"))
    report = C.copy_into(s, t, G.json_stage(s, d), FileFormat.json(), EVENT_SCHEMA, AS_OF, on_error="CONTINUE")
    return R.validate_before_load(list_stage(s, G.json_stage(s, d)), report).select("check_name", "status")


_reg("validate_before_load", _gate, """
SELECT 'files_exist' AS check_name, 'PASS' AS status UNION ALL SELECT 'file_readable', CASE WHEN sum(parsed) > sum(bad) THEN 'PASS' ELSE 'FAIL' END FROM files
UNION ALL SELECT 'skip_rate', CASE WHEN round(sum(bad) * 100.0 / sum(parsed), 2) > 5 THEN 'FAIL' ELSE 'PASS' END FROM files """, STAGED)
