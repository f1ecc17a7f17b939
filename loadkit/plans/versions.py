"""Versioned tables."""

from pyspark.sql import functions as F

from ..operators import copy as C
from ..operators.versioned import Table
from ..session import work_path
from ..sources.formats import FileFormat
from . import derive as D, stages as G
from .derive import AS_OF, table, with_sql
from .registry import query

W = with_sql("raw_events")


def _grown(s, d) -> Table:
    """A table grown by one load per event type, in their order, on consecutive days."""
    t = Table(s, work_path(s, "grown"))
    e = D.raw_events(s, d)
    kinds = sorted(r["event_type"] for r in e.select("event_type").distinct().collect())
    for i, kind in enumerate(kinds):
        t.append(e.where(F.col("event_type") == kind), f"2024-02-{i + 1:02d} 00:00:00")
    return t


def _counts(df):
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


_BY = "SELECT event_type, count(*)::BIGINT AS n FROM raw_events WHERE event_type IN ({k}) GROUP BY 1"
query("snapshots", W + """
, c AS (SELECT event_type, count(*)::BIGINT AS n FROM raw_events GROUP BY 1)
SELECT row_number() OVER (ORDER BY event_type)::BIGINT AS snapshot_id, CASE WHEN row_number() OVER (ORDER BY event_type) > 1 THEN row_number() OVER (ORDER BY event_type) - 1 END::BIGINT AS parent_id,
  TIMESTAMP '2024-02-01' + to_days((row_number() OVER (ORDER BY event_type) - 1)::INTEGER) AS committed_at, 'append' AS operation, sum(n) OVER (ORDER BY event_type)::BIGINT AS rows FROM c """)(
    lambda s, d: _grown(s, d).snapshots().select("snapshot_id", "parent_id", "committed_at", "operation", "rows"))
query("read_at_snapshot", W + _BY.format(k="'click', 'error'"))(lambda s, d: _counts(_grown(s, d).read(snapshot=2)))
query("read_at_timestamp", W + _BY.format(k="'click', 'error', 'purchase'"))(lambda s, d: _counts(_grown(s, d).read(timestamp="2024-02-03 12:00:00")))
query("table_files", W + "SELECT count(*)::BIGINT AS record_count FROM raw_events")(
    lambda s, d: _grown(s, d).files().agg(F.sum("record_count").alias("record_count")))


def _expired(s, d):
    t = _grown(s, d)
    gone = t.expire("2024-02-04 00:00:00")
    return gone.select("snapshot_id", F.lit("expired").alias("state")).unionByName(t.snapshots().select("snapshot_id", F.lit("kept").alias("state")))


query("expire_snapshots", """
SELECT v AS snapshot_id, CASE WHEN v < 4 THEN 'expired' ELSE 'kept' END AS state FROM (SELECT DISTINCT dense_rank() OVER (ORDER BY event_type)::BIGINT AS v FROM events) """)(_expired)


def _compacted(s, d):
    t = _grown(s, d)
    before = t.current()["files"]
    t.compact("2024-02-10 00:00:00")
    now = t.current()
    return _counts(t.read()).withColumn("fewer_files", F.lit(now["files"] < before))


query("compact", W + "SELECT event_type, count(*)::BIGINT AS n, true AS fewer_files FROM raw_events GROUP BY 1")(_compacted)


def _compacted_where(s, d):
    """Only loads that hold matching rows are rewritten."""
    t = _grown(s, d)
    t.compact("2024-02-10 00:00:00", where=F.col("event_type").isin("click", "view"))
    return _counts(t.read()).withColumn("loads", F.lit(len(t.current()["load_ids"])).cast("bigint"))


query("compact_where", W + "SELECT event_type, count(*)::BIGINT AS n, 4::BIGINT AS loads FROM raw_events GROUP BY 1")(_compacted_where)


def _full_ingest(s, d):
    t = Table(s, work_path(s, "ingest"))
    C.copy_into(s, t, G.parquet_stage(s, d), FileFormat.parquet(), table(s, d, "orders").schema, AS_OF, load_mode="FULL_INGEST", cluster_by=["o_orderdate"])
    return t.read()


query("full_ingest", "SELECT * FROM orders")(_full_ingest)


def _added(s, d):
    t = Table(s, work_path(s, "added"))
    t.add_files(G.parquet_stage(s, d), AS_OF)
    t.add_files(G.parquet_stage(s, d), AS_OF)
    return t.read().groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


query("add_files_copy", "SELECT o_orderstatus, 2 * count(*)::BIGINT AS n FROM orders GROUP BY 1")(_added)


def _partitioned(s, d):
    """Partitioned by type: a filter on it reads one directory of each load."""
    t = Table(s, work_path(s, "parts"))
    t.append(D.raw_events(s, d), AS_OF, partition_by=["event_type"])
    return t.read().where("event_type = 'view'").select("event_id", "event_type", "value")


query("partitioned_table", W + "SELECT event_id, event_type, value FROM raw_events WHERE event_type = 'view' ")(_partitioned)


def _truncated(s, d):
    t = _grown(s, d)
    t.truncate("2024-02-10 00:00:00")
    t.append(D.raw_events(s, d).where("event_type = 'view'"), "2024-02-11 00:00:00")
    return _counts(t.read())


query("truncate_table", W + _BY.format(k="'view'"))(_truncated)
