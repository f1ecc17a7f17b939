"""Replication and relational sources."""

from pyspark.sql import functions as F

from ..operators import external as E
from ..operators.replicate import replicate, snapshot_at
from ..operators.versioned import Table
from ..functions.times import within
from ..session import work_path
from ..sources.rows import newer_than_target
from . import derive as D
from .derive import AS_OF, table, with_sql
from .registry import query


def _full(s, d):
    t = Table(s, work_path(s, "nations"))
    replicate(table(s, d, "nation").where("n_regionkey = 0"), t, AS_OF, "full-refresh")
    replicate(table(s, d, "nation"), t, AS_OF, "full-refresh")
    return t.read()


query("replicate_full", "SELECT * FROM nation")(_full)


def _incremental(s, d):
    t = Table(s, work_path(s, "customers"))
    replicate(D.raw_customers(s, d), t, AS_OF, "incremental", "customer_id", "updated_at")
    replicate(D.customer_changes(s, d), t, AS_OF, "incremental", "customer_id", "updated_at")
    return t.read()


query("replicate_incremental", with_sql("raw_customers", "customer_changes") + """
, m AS (SELECT max(updated_at) AS m FROM raw_customers)
, s AS (SELECT customer_changes.* FROM customer_changes, m WHERE updated_at > m.m QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) = 1)
SELECT * FROM raw_customers t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.customer_id = t.customer_id AND s.updated_at > t.updated_at)
UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM raw_customers t WHERE t.customer_id = s.customer_id AND s.updated_at <= t.updated_at) """)(_incremental)


def _snapshots(s, d):
    t = Table(s, work_path(s, "parts"))
    replicate(table(s, d, "part"), t, "2024-01-01 00:00:00", "snapshot")
    replicate(table(s, d, "part").withColumn("p_retailprice", F.col("p_retailprice") + 1), t, "2024-01-02 00:00:00", "snapshot")
    return snapshot_at(t, "2024-01-02 00:00:00").select("p_partkey", "p_retailprice")


query("replicate_snapshot", "SELECT p_partkey, p_retailprice + 1 AS p_retailprice FROM part")(_snapshots)
query("watermark_extract", """
SELECT o_orderkey FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 450000) """)(
    lambda s, d: newer_than_target(table(s, d, "orders"), table(s, d, "orders").where("o_orderstatus = 'F' and o_totalprice > 450000"), "o_orderdate").select("o_orderkey"))
query("custom_sql_source", """
SELECT o_custkey, count(*)::BIGINT AS orders, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 """)(
    lambda s, d: (table(s, d, "orders").createOrReplaceTempView("loadkit_orders_src"), s.sql(
        "SELECT o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM loadkit_orders_src WHERE o_orderstatus <> 'P' GROUP BY o_custkey"))[1])
query("staging_projection", f"""
SELECT event_id, ts AS event_timestamp, event_type, json_extract_string(props, '$.k')::INTEGER AS k FROM events WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 90 DAY """)(
    lambda s, d: E.flatten_view(table(s, d, "events").where(within("ts", AS_OF, days=90)).select("event_id", F.col("ts").alias("event_timestamp"), "event_type", "props"),
                                "props", {"k": ("k", "int")}))
