"""Deduplication, merges and row changes."""

from pyspark.sql import functions as F

from ..operators import merge as M
from ..operators.versioned import Table
from ..session import work_path
from . import derive as D
from .derive import AS_OF, table, with_sql
from .registry import query


def _reg(name, fn, body, *ctes):
    query(name, (with_sql(*ctes) if ctes else "") + body)(fn)


_LAST = "QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY {o}) = 1"
_reg("dedupe_latest", lambda s, d: M.latest(D.doubled_events(s, d), ["event_id"], "_loaded_at"), """
SELECT * FROM doubled_events """ + _LAST.format(k="event_id", o="_loaded_at DESC"), "doubled_events")
_reg("dedupe_first", lambda s, d: M.latest(D.doubled_events(s, d), ["event_id"], "_loaded_at", newest=False), """
SELECT * FROM doubled_events """ + _LAST.format(k="event_id", o="_loaded_at"), "doubled_events")
# one event type holds every fifth row: the hot-key case
_reg("latest_per_type", lambda s, d: M.latest(D.raw_events(s, d), ["event_type"], "event_timestamp"), """
SELECT * FROM raw_events """ + _LAST.format(k="event_type", o="event_timestamp DESC"), "raw_events")
_reg("delete_dups_keep_min", lambda s, d: M.delete_duplicates_keep_min(D.doubled_events(s, d), "event_id", "_loaded_at"), """
SELECT * FROM doubled_events WHERE (event_id, _loaded_at) IN (SELECT (event_id, min(_loaded_at)) FROM doubled_events GROUP BY event_id) """, "doubled_events")

_UPSERT = """
, s AS (SELECT * FROM customer_changes QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) = 1)
, m AS (SELECT coalesce(t.customer_id, s.customer_id) AS customer_id,
    CASE WHEN t.customer_id IS NULL OR s.updated_at > t.updated_at THEN s.customer_name ELSE t.customer_name END AS customer_name,
    CASE WHEN t.customer_id IS NULL OR s.updated_at > t.updated_at THEN s.email ELSE t.email END AS email,
    CASE WHEN t.customer_id IS NULL OR s.updated_at > t.updated_at THEN s.status ELSE t.status END AS status,
    CASE WHEN t.customer_id IS NULL OR s.updated_at > t.updated_at THEN s.updated_at ELSE t.updated_at END AS updated_at,
    CASE WHEN t.customer_id IS NULL THEN 'inserted' WHEN s.updated_at > t.updated_at THEN 'updated' ELSE 'unchanged' END AS a
  FROM raw_customers t FULL JOIN s ON t.customer_id = s.customer_id) """
_C = ("raw_customers", "customer_changes")
for _name in ("merge_upsert_broadcast", "merge_upsert_shuffled"):  # one form; Spark picks the join from the sizes
    _reg(_name, lambda s, d: M.result(M.upsert(D.raw_customers(s, d), D.customer_changes(s, d), "customer_id", "updated_at")),
         _UPSERT + "SELECT * EXCLUDE (a) FROM m", *_C)
_reg("merge_stats", lambda s, d: M.stats(M.upsert(D.raw_customers(s, d), D.customer_changes(s, d), "customer_id", "updated_at")),
     _UPSERT + "SELECT a AS _action, count(*)::BIGINT AS row_count FROM m WHERE a <> 'unchanged' GROUP BY 1", *_C)


def _incremental(s, d):
    """Create, merge, merge again: the second merge changes nothing."""
    t = Table(s, work_path(s, "customers"))
    t.append(D.raw_customers(s, d), AS_OF, "create")
    changes = D.customer_changes(s, d)
    first = M.apply(t, lambda now: M.upsert(now, changes, "customer_id", "updated_at"), AS_OF)
    again = M.apply(t, lambda now: M.upsert(now, changes, "customer_id", "updated_at"), AS_OF)
    a = M.load_audit(first, "customers", "raw.customers", AS_OF).withColumn("run", F.lit(1))
    return a.unionByName(M.load_audit(again, "customers", "raw.customers", AS_OF).withColumn("run", F.lit(2)))


_reg("merge_audit", _incremental, _UPSERT + f"""
, c AS (SELECT count(*) FILTER (a = 'inserted')::BIGINT AS i, count(*) FILTER (a = 'updated')::BIGINT AS u FROM m)
SELECT 'customers' AS job_id, DATE '{AS_OF[:10]}' AS execution_date, 'raw.customers' AS table_name, i AS rows_inserted, u AS rows_updated, 0::BIGINT AS rows_deleted,
  TIMESTAMP '{AS_OF}' AS completed_at, 1::INTEGER AS run FROM c
UNION ALL SELECT 'customers', DATE '{AS_OF[:10]}', 'raw.customers', 0, 0, 0, TIMESTAMP '{AS_OF}', 2 FROM c """, *_C)
def _staged_merge(s, d):
    """Changed customers staged as files, loaded into a staging table, deduplicated and merged."""
    from ..sources.formats import FileFormat
    from . import stages as G

    def make():
        path = work_path(s, "stage-customers")
        D.customer_changes(s, d).write.parquet(path)
        return path

    t, staging = Table(s, work_path(s, "customers")), Table(s, work_path(s, "staging"))
    t.append(D.raw_customers(s, d), AS_OF, "create")
    schema = "customer_id string, customer_name string, email string, status string, updated_at timestamp_ntz"
    audit = M.load_incremental(s, t, staging, G.once(s, (d, "customers"), make), FileFormat.parquet(), schema, "customer_id", "updated_at", AS_OF)
    return audit.select("rows_staged", "rows_inserted", "rows_updated", "rows_deleted")


_reg("load_incremental", _staged_merge, _UPSERT + """
SELECT (SELECT count(*) FROM customer_changes)::BIGINT AS rows_staged, count(*) FILTER (a = 'inserted')::BIGINT AS rows_inserted, count(*) FILTER (a = 'updated')::BIGINT AS rows_updated, 0::BIGINT AS rows_deleted FROM m """, *_C)
_reg("merge_insert_only", lambda s, d: M.insert_only(D.raw_customers(s, d), D.customer_changes(s, d), ["customer_id"], "updated_at"), """
, s AS (SELECT * FROM customer_changes QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) = 1)
SELECT * FROM raw_customers UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM raw_customers t WHERE t.customer_id = s.customer_id) """, *_C)
_FEED = """
, s AS (SELECT * FROM order_changes QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY change_timestamp DESC) = 1)
, j AS (SELECT t.order_id AS tk, s.order_id AS sk, s.operation AS op, s.change_timestamp > t.updated_at AS newer, s.customer_id AS sc, s.order_total AS so, s.status AS ss, s.change_timestamp AS st, t.*
  FROM raw_orders t FULL JOIN s ON t.order_id = s.order_id)
, k AS (SELECT *, CASE WHEN tk IS NULL THEN CASE WHEN op <> 'D' THEN 'inserted' ELSE 'ignored' END WHEN op = 'D' THEN 'deleted' WHEN op IN ('I', 'U') AND newer THEN 'updated' ELSE 'unchanged' END AS a FROM j) """
_reg("merge_change_feed", lambda s, d: M.result(M.merge_changes(D.raw_orders(s, d), D.order_changes(s, d), "order_id")), _FEED + """
SELECT coalesce(tk, sk) AS order_id, CASE WHEN a IN ('inserted', 'updated') THEN sc ELSE customer_id END AS customer_id, CASE WHEN a IN ('inserted', 'updated') THEN so ELSE order_total END AS order_total,
  CASE WHEN a IN ('inserted', 'updated') THEN ss ELSE status END AS status, CASE WHEN a IN ('inserted', 'updated') THEN st ELSE updated_at END AS updated_at
FROM k WHERE a NOT IN ('deleted', 'ignored') """, "raw_orders", "order_changes")
_reg("merge_change_feed_stats", lambda s, d: M.stats(M.merge_changes(D.raw_orders(s, d), D.order_changes(s, d), "order_id")), _FEED + """
SELECT a AS _action, count(*)::BIGINT AS row_count FROM k WHERE a IN ('inserted', 'updated', 'deleted') GROUP BY 1 """, "raw_orders", "order_changes")


def _late(s, d):
    """Late data: staged events whose time moved back or forward, newest event time wins."""
    e = D.raw_events(s, d).select("event_id", "event_type", "event_timestamp", "value")
    moved = e.withColumn("event_timestamp", F.when(F.col("event_type") == "click", F.expr("event_timestamp + interval 1 hour")).otherwise(F.expr("event_timestamp - interval 1 hour"))).withColumn("value", F.col("value") + 100)
    again = moved.withColumn("event_timestamp", F.expr("event_timestamp - interval 1 day")).withColumn("value", F.lit(-1.0))
    return M.result(M.upsert(e, moved.unionByName(again), "event_id", "event_timestamp"))


_reg("merge_late", _late, """
SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN event_timestamp + INTERVAL 1 HOUR ELSE event_timestamp END AS event_timestamp,
  CASE WHEN event_type = 'click' THEN value + 100 ELSE value END AS value FROM raw_events """, "raw_events")


# ---- CDC ------------------------------------------------------------------------------------
def cdc_documents(s, d):
    """Envelope documents: a create for each customer, an update for some, a delete for others."""
    c = D.raw_customers(s, d)
    key = F.col("customer_id").cast("bigint")

    def document(df, op, hours, status=None):
        row = F.struct(F.col("customer_id").alias("id"), "customer_name", F.lit(status).alias("status") if status else F.col("status"))
        ms = F.unix_millis((F.col("updated_at") + F.expr(f"interval {hours} hour")).cast("timestamp"))
        empty = F.lit(None).cast("struct<id:string,customer_name:string,status:string>")
        payload = F.struct(F.lit(op).alias("op"), (row if op == "d" else empty).alias("before"), (empty if op == "d" else row).alias("after"), F.struct(ms.alias("ts_ms")).alias("source"))
        return df.select(F.to_json(F.struct(payload.alias("payload"))).alias("record_content"))

    return (document(c, "c", 0).unionByName(document(c.where(key % 5 == 0), "u", 1, "UPDATED")).unionByName(document(c.where(key % 7 == 0), "d", 2)))


def cdc_changes(s, d):
    return M.cdc_changes(cdc_documents(s, d), "record_content", "id", ["customer_name", "status"])


_STATE = """
SELECT customer_id AS id, customer_name, CASE WHEN customer_id::BIGINT % 5 = 0 THEN 'UPDATED' ELSE status END AS status,
  CASE WHEN customer_id::BIGINT % 5 = 0 THEN updated_at + INTERVAL 1 HOUR ELSE updated_at END AS updated_at FROM raw_customers WHERE customer_id::BIGINT % 7 <> 0 """
_reg("cdc_current_state", lambda s, d: M.cdc_state(cdc_changes(s, d), "id"), _STATE, "raw_customers")


def _cdc_merge(s, d):
    """A target holding the created rows, then all changes merged into it."""
    target = D.raw_customers(s, d).select(F.col("customer_id").alias("id"), "customer_name", "status", "updated_at")
    return M.result(M.merge_cdc(target, cdc_changes(s, d), "id"))


_reg("merge_cdc", _cdc_merge, _STATE, "raw_customers")

# ---- plain row changes ---------------------------------------------------------------------
_reg("insert_new", lambda s, d: M.insert_only(D.raw_events(s, d).where("event_type <> 'error'"), D.raw_events(s, d), ["event_id"]), "SELECT * FROM raw_events", "raw_events")
_reg("delete_where", lambda s, d: M.delete_where(D.raw_customers(s, d), F.col("email").like("customer%")), """
SELECT * FROM raw_customers WHERE NOT coalesce(email LIKE 'customer%', false) """, "raw_customers")
_reg("update_where", lambda s, d: M.update_where(D.raw_customers(s, d), {"status": F.lit("NO MAIL")}, F.col("email").isNull()), """
SELECT customer_id, customer_name, email, CASE WHEN email IS NULL THEN 'NO MAIL' ELSE status END AS status, updated_at FROM raw_customers """, "raw_customers")


def _soft(s, d):
    c = table(s, d, "customer").withColumn("is_deleted", F.when(F.col("c_acctbal") < 0, True).when(F.col("c_acctbal") > 5000, False))
    active, gone = M.split_soft_deletes(c, "is_deleted")
    count = lambda df, part: df.agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("n"))
    return count(active, "active").unionByName(count(gone, "deleted"))


_reg("split_soft_deletes", _soft, """
SELECT 'active' AS part, count(*) FILTER (NOT (c_acctbal < 0))::BIGINT AS n FROM customer UNION ALL SELECT 'deleted', count(*) FILTER (c_acctbal < 0)::BIGINT FROM customer """)


def _archive(s, d):
    live, old = Table(s, work_path(s, "live")), Table(s, work_path(s, "archive"))
    live.append(D.raw_events(s, d), AS_OF)
    M.archive(live, old, F.col("event_type").isin("view", "click"), "event_timestamp", AS_OF, days=10)
    count = lambda t, part: t.read().agg(F.lit(part).alias("part"), F.count(F.lit(1)).alias("n"))
    return count(live, "live").unionByName(count(old, "archive"))


_reg("archive", _archive, f"""
, x AS (SELECT event_type IN ('view', 'click') AND event_timestamp < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY AS o FROM raw_events)
SELECT 'live' AS part, count(*) FILTER (NOT o)::BIGINT AS n FROM x UNION ALL SELECT 'archive', count(*) FILTER (o)::BIGINT FROM x """, "raw_events")
