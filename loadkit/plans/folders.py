"""Changes of tables in key-range folders: what is written anew and what is kept."""

from pyspark.sql import functions as F

from ..functions.times import older
from ..operators import folders as B, merge as M
from ..operators.replicate import replicate
from ..operators.versioned import Table
from ..session import work_path
from . import derive as D
from .derive import AS_OF, with_sql
from .registry import query

#: Keys of a folder in these queries.
WIDTH = 1000


def orders_in_folders(s, d) -> Table:
    """All orders, a folder for each WIDTH keys."""
    t, orders = Table(s, work_path(s, "folders")), D.raw_orders(s, d)
    top = orders.agg(F.max("order_id")).first()[0] or 0
    B.create(t, orders, "order_id", AS_OF, bounds=list(range(WIDTH, top + 1, WIDTH)))
    return t


def local_changes(s, d):
    """The order changes (inserts, updates, deletes) of every third folder."""
    return D.order_changes(s, d).where(F.floor((F.col("order_id") % 100000000) / WIDTH) % 3 == 0)


_LOCAL = f"""
, c AS (SELECT * FROM order_changes WHERE (order_id % 100000000) // {WIDTH} % 3 = 0)
, s AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY change_timestamp DESC) = 1)
, k AS (SELECT coalesce(t.order_id, s.order_id) AS order_id, t.order_id AS tk, s.operation AS op,
    s.change_timestamp > t.updated_at AS newer, t.customer_id AS tc, t.order_total AS tt, t.status AS ts, t.updated_at AS tu,
    s.customer_id AS sc, s.order_total AS st, s.status AS ss, s.change_timestamp AS su FROM raw_orders t FULL JOIN s ON t.order_id = s.order_id)
, a AS (SELECT *, CASE WHEN tk IS NULL THEN CASE WHEN op <> 'D' THEN 'inserted' ELSE 'ignored' END WHEN op = 'D' THEN 'deleted' WHEN op IN ('I', 'U') AND newer THEN 'updated' ELSE 'unchanged' END AS act FROM k) """
_SQL = with_sql("raw_orders", "order_changes") + _LOCAL
#: A folder's number: keys from the last bound on share one.
_TOP = f"(SELECT max(order_id) // {WIDTH} FROM raw_orders)"


def _merged(s, d):
    t = orders_in_folders(s, d)
    feed = local_changes(s, d)
    M.apply(t, lambda now: M.merge_changes(now, feed, "order_id"), AS_OF, source=feed)
    return t.read()


query("folders_merge_rows", _SQL + """
SELECT order_id, CASE WHEN act IN ('inserted', 'updated') THEN sc ELSE tc END AS customer_id, CASE WHEN act IN ('inserted', 'updated') THEN st ELSE tt END AS order_total,
  CASE WHEN act IN ('inserted', 'updated') THEN ss ELSE ts END AS status, CASE WHEN act IN ('inserted', 'updated') THEN su ELSE tu END AS updated_at
FROM a WHERE act NOT IN ('deleted', 'ignored') """)(_merged)


def _report(s, d):
    """What the merge wrote and kept, and what deletes and updates by a condition and a repeated merge do after it."""
    t = orders_in_folders(s, d)
    feed = local_changes(s, d)
    merging = lambda now: M.merge_changes(now, feed, "order_id")
    steps, before = [], t.current()
    run = {
        "merge": lambda: B.change(t, merging, AS_OF, "merge", feed),
        "delete": lambda: B.change(t, lambda now: M.delete_where(now, F.col("order_id") < 1500), AS_OF, "delete", condition=F.col("order_id") < 1500),
        "nothing": lambda: B.change(t, lambda now: M.delete_where(now, F.col("order_id") < 0), AS_OF, "delete", condition=F.col("order_id") < 0),
    }
    for name, step in run.items():
        w, now = step(), t.current()
        same = len(set(before["load_ids"]) & set(now["load_ids"]))
        steps.append((name, w.touched, w.kept, same, w.actions.get("inserted", 0), w.actions.get("updated", 0), w.actions.get("deleted", 0), now["rows"]))
        before = now
    return s.createDataFrame(steps, "step string, folders_touched bigint, folders_kept bigint, folders_same bigint, rows_inserted bigint, rows_updated bigint, rows_deleted bigint, rows_after bigint")


query("folders_report", _SQL + f"""
, f AS (SELECT DISTINCT least(order_id // {WIDTH}, {_TOP}) AS p FROM raw_orders)
, hit AS (SELECT DISTINCT least(order_id // {WIDTH}, {_TOP}) AS p FROM c)
, left_over AS (SELECT least(order_id // {WIDTH}, {_TOP}) AS p, count(*) FILTER (order_id < 1500) AS gone, count(*) AS n FROM a WHERE act NOT IN ('deleted', 'ignored') GROUP BY 1)
, m AS (SELECT (SELECT count(*) FROM f JOIN hit USING (p))::BIGINT AS touched, (SELECT count(*) FROM f ANTI JOIN hit USING (p))::BIGINT AS kept,
    count(*) FILTER (act = 'inserted')::BIGINT AS i, count(*) FILTER (act = 'updated')::BIGINT AS u, count(*) FILTER (act = 'deleted')::BIGINT AS x, count(*) FILTER (act NOT IN ('deleted', 'ignored'))::BIGINT AS n FROM a)
, x AS (SELECT count(*) FILTER (gone > 0)::BIGINT AS touched, count(*) FILTER (gone = 0)::BIGINT AS kept, sum(gone)::BIGINT AS x, sum(n - gone)::BIGINT AS n, count(*) FILTER (gone < n)::BIGINT AS folders FROM left_over)
SELECT 'merge' AS step, touched AS folders_touched, kept AS folders_kept, kept AS folders_same, i AS rows_inserted, u AS rows_updated, x AS rows_deleted, n AS rows_after FROM m
UNION ALL SELECT 'delete', touched, kept, kept, 0, 0, x, n FROM x
UNION ALL SELECT 'nothing', 0, folders, folders, 0, 0, 0, n FROM x """)(_report)


def _archived(s, d):
    """Events in folders by time: old ones go to an archive, an update marks some of the rest; rows by event type in both."""
    live, old = Table(s, work_path(s, "live")), Table(s, work_path(s, "archive"))
    B.create(live, D.raw_events(s, d), "event_timestamp", AS_OF, folder_rows=20_000)
    some = F.col("event_type").isin("view", "click")
    M.archive(live, old, some, "event_timestamp", AS_OF, days=10)
    late = ~older("event_timestamp", AS_OF, days=2) & (F.col("event_type") == "error")
    M.replace_rows(live, lambda now: M.update_where(now, {"value": F.lit(-1.0)}, late), AS_OF, "update", condition=late)
    part = lambda t, name: t.read().groupBy("event_type").agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("value") == -1, 1)).alias("marked"))
    return part(live, "live").unionByName(part(old, "archive"))


query("folders_archive", with_sql("raw_events") + f"""
, x AS (SELECT event_type, event_type IN ('view', 'click') AND event_timestamp < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY AS o,
    CASE WHEN event_type = 'error' AND NOT event_timestamp < TIMESTAMP '{AS_OF}' - INTERVAL 2 DAY THEN -1 ELSE value END AS value FROM raw_events)
SELECT event_type, CASE WHEN o THEN 'archive' ELSE 'live' END AS part, count(*)::BIGINT AS n, count(*) FILTER (value = -1)::BIGINT AS marked FROM x GROUP BY 1, 2 """)(_archived)


def _replicated(s, d):
    """Incremental replication into a table in folders: rows newer than the table, then the same again."""
    t, orders = Table(s, work_path(s, "copy")), D.raw_orders(s, d)
    B.create(t, orders.where("order_id % 3 > 0"), "order_id", AS_OF, folder_rows=5000)
    newer = orders.where("order_id % 5 = 0").withColumn("updated_at", F.expr("updated_at + interval 40 year"))
    for _ in range(2):
        replicate(newer, t, AS_OF, "incremental", "order_id", "updated_at")
    return t.read()


query("folders_replicate", with_sql("raw_orders") + """
SELECT order_id, customer_id, order_total, status, CASE WHEN order_id % 5 = 0 THEN updated_at + INTERVAL 40 YEAR ELSE updated_at END AS updated_at
FROM raw_orders WHERE order_id % 3 > 0 OR order_id % 5 = 0 """)(_replicated)
