"""Join forms (J01-J12) that no other registered query shows by itself."""

from pyspark.sql import functions as F

from . import derive as D
from .derive import table, with_sql
from .registry import query

query("join_inner", """
SELECT n_name, r_name, count(*)::BIGINT AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2 """)(
    # customers are counted per nation before they meet the nation table
    lambda s, d: table(s, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    .join(table(s, d, "nation"), "n_nationkey").join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    .groupBy("n_name", "r_name").agg(F.sum("customers").alias("customers")))
query("join_left", """
SELECT c_custkey, count(o_orderkey)::BIGINT AS orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1 """)(
    lambda s, d: table(s, d, "customer").select("c_custkey").join(
        table(s, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n")), "c_custkey", "left")
    .select("c_custkey", F.coalesce("n", F.lit(0)).alias("orders")))
query("join_full", """
SELECT coalesce(c.k, s.k) AS k, c.n AS customers, s.n AS suppliers FROM (SELECT c_nationkey AS k, count(*)::BIGINT AS n FROM customer WHERE c_acctbal < 0 GROUP BY 1) c
FULL JOIN (SELECT s_nationkey AS k, count(*)::BIGINT AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) s ON c.k = s.k """)(
    lambda s, d: table(s, d, "customer").where("c_acctbal < 0").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("customers")).join(
        table(s, d, "supplier").where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("suppliers")), "k", "full_outer"))
query("join_semi", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")(
    lambda s, d: table(s, d, "customer").select("c_custkey").join(
        table(s, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi"))
query("join_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")(
    lambda s, d: table(s, d, "customer").select("c_custkey").join(
        table(s, d, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey", "left_anti"))
query("join_case_insensitive", """
SELECT a.c_mktsegment AS segment, count(*)::BIGINT AS n FROM customer a JOIN (SELECT DISTINCT lower(c_mktsegment) AS k FROM customer WHERE c_acctbal > 0) b ON upper(a.c_mktsegment) = upper(b.k) GROUP BY 1 """)(
    lambda s, d: table(s, d, "customer").groupBy(F.col("c_mktsegment").alias("segment"), F.upper("c_mktsegment").alias("k")).agg(F.count(F.lit(1)).alias("n")).join(
        table(s, d, "customer").where("c_acctbal > 0").select(F.upper(F.lower("c_mktsegment")).alias("k")).distinct(), "k").select("segment", "n"))


def _user_documents(s, d):
    """One document per event with the user and a two-element event list."""
    e = D.raw_events(s, d)
    return e.select(F.to_json(F.struct(
        F.struct(F.col("user_id").cast("string").alias("id")).alias("user"),
        F.array(F.struct(F.col("event_type").alias("type")), F.struct(F.lit("seen").alias("type"))).alias("events"), "event_id")).alias("doc"))


query("flatten_documents", with_sql("raw_events") + """
SELECT event_id, user_id::VARCHAR AS user_id, event_type FROM raw_events UNION ALL SELECT event_id, user_id::VARCHAR, 'seen' FROM raw_events """)(
    lambda s, d: _user_documents(s, d).select(F.from_json("doc", "struct<event_id:bigint,user:struct<id:string>,events:array<struct<type:string>>>").alias("j"))
    .select("j.event_id", F.col("j.user.id").alias("user_id"), F.explode("j.events").alias("f")).select("event_id", "user_id", F.col("f.type").alias("event_type")))
