"""Projections, filters, windows, sorts and scalar functions (P, A, X, O, U and F rows)."""

from pyspark.sql import Window, functions as F

from ..functions import text as TX, times as TM, windows as WN
from ..functions.numbers import ratio
from ..operators import quality as Q
from . import derive as D
from .derive import AS_OF, table, with_sql
from .registry import query

S = f"TIMESTAMP '{AS_OF}'"


def _reg(name, fn, body, *ctes):
    query(name, (with_sql(*ctes) if ctes else "") + body)(fn)


_reg("project_rename", lambda s, d: table(s, d, "customer").select(
    F.col("c_custkey").alias("customer_id"), F.concat(F.upper("c_mktsegment"), F.lit(" "), F.col("c_name")).alias("label"), F.col("c_acctbal").alias("balance")), """
SELECT c_custkey AS customer_id, upper(c_mktsegment) || ' ' || c_name AS label, c_acctbal AS balance FROM customer """)
_reg("typed_path", lambda s, d: table(s, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k")), """
SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k FROM events """)
_reg("fiscal_quarter", lambda s, d: table(s, d, "orders").select(
    "o_orderkey", F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string")).alias("fiscal_quarter"),
    F.when(F.col("o_totalprice") < 100000, "small").when(F.col("o_totalprice") < 300000, "medium").otherwise("large").alias("order_size_category")), """
SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (1, 2, 3) THEN 'Q1' WHEN month(o_orderdate) IN (4, 5, 6) THEN 'Q2' WHEN month(o_orderdate) IN (7, 8, 9) THEN 'Q3' ELSE 'Q4' END AS fiscal_quarter,
  CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'medium' ELSE 'large' END AS order_size_category FROM orders """)
_reg("filters", lambda s, d: table(s, d, "lineitem").where(
    F.col("l_returnflag").isin("A", "R") & F.col("l_quantity").between(10, 20) & (F.col("l_linestatus") != "F") & F.col("l_discount").isNotNull()
).select("l_orderkey", "l_linenumber"), """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_quantity BETWEEN 10 AND 20 AND l_linestatus <> 'F' AND l_discount IS NOT NULL """)
_reg("time_window", lambda s, d: table(s, d, "events").where(TM.within("ts", AS_OF, days=7)).select("event_id"), f"""
SELECT event_id FROM events WHERE ts > {S} - INTERVAL 7 DAY """)
_reg("like_filters", lambda s, d: table(s, d, "part").where(F.col("p_type").like("%STEEL%") | F.col("p_name").ilike("%RED%")).select("p_partkey"), """
SELECT p_partkey FROM part WHERE p_type LIKE '%STEEL%' OR p_name ILIKE '%RED%' """)
_reg("scalar_subquery_max", lambda s, d: table(s, d, "orders").where(
    F.col("o_orderdate") == table(s, d, "orders").agg(F.max("o_orderdate")).scalar()).select("o_orderkey", "o_orderdate"), """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders) """)
_reg("distinct_projection", lambda s, d: table(s, d, "orders").select("o_orderstatus", "o_orderpriority").distinct(), """
SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders """)
_reg("lateral_alias", lambda s, d: (table(s, d, "orders").createOrReplaceTempView("loadkit_orders"), s.sql("""
SELECT o_orderpriority, count_if(o_totalprice > 200000) AS large_count, count(*) AS total_count, round(100.0D * large_count / total_count, 1) AS large_pct
FROM loadkit_orders GROUP BY o_orderpriority"""))[1], """
SELECT o_orderpriority, count(*) FILTER (o_totalprice > 200000)::BIGINT AS large_count, count(*)::BIGINT AS total_count,
  round(100.0::DOUBLE * count(*) FILTER (o_totalprice > 200000) / count(*), 1) AS large_pct FROM orders GROUP BY 1 """)
_reg("named_table", lambda s, d: (table(s, d, "nation").createOrReplaceTempView("loadkit_nation"), s.sql(
    "SELECT count(*) AS n FROM identifier(:t)", args={"t": "loadkit_nation"}))[1], "SELECT count(*)::BIGINT AS n FROM nation")
# a hundredth of the rows, decided by a hash of their key: the same rows wherever they lie
query("sample_fraction", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE substr(md5(l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR), 1, 4) < '028f'")(
    lambda s, d: table(s, d, "lineitem").where(F.substring(F.md5(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))), 1, 4) < "028f")
    .select("l_orderkey", "l_linenumber"))
_reg("grouped_aggregates", lambda s, d: table(s, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
    F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
    F.round(F.avg("l_extendedprice"), 4).alias("avg_price"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"), F.count_distinct("l_suppkey").alias("suppliers")), """
SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS n, round(sum(l_quantity), 2) AS sum_qty, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, round(avg(l_extendedprice), 4) AS avg_price,
  count(*) FILTER (l_discount > 0.05)::BIGINT AS discounted, count(DISTINCT l_suppkey)::BIGINT AS suppliers FROM lineitem GROUP BY 1, 2 """)
_reg("global_aggregate", lambda s, d: table(s, d, "orders").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.round(F.stddev_samp("o_totalprice"), 4).alias("dev")), """
SELECT count(*)::BIGINT AS n, round(sum(o_totalprice), 2) AS total, round(stddev_samp(o_totalprice), 4) AS dev FROM orders """)
_reg("median_by_group", lambda s, d: WN.exact_percentile(table(s, d, "lineitem"), ["l_returnflag"], "l_extendedprice", 0.5, "median_price"), """
SELECT l_returnflag, median(l_extendedprice) AS median_price FROM lineitem GROUP BY 1 """)
_reg("percentile_95", lambda s, d: WN.exact_percentile(table(s, d, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", 0.95, "p95").withColumn("p95", F.round("p95", 6)), """
SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95 FROM lineitem GROUP BY 1, 2 """)
_reg("listagg_ordered", lambda s, d: table(s, d, "nation").groupBy("n_regionkey").agg(
    F.array_join(F.array_sort(F.collect_set("n_name")), ", ").alias("nations")), """
SELECT n_regionkey, string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS nations FROM nation GROUP BY 1 """)
_reg("having_group", lambda s, d: table(s, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where("n > 15"), """
SELECT o_custkey, count(*)::BIGINT AS n FROM orders GROUP BY 1 HAVING count(*) > 15 """)
_reg("having_global", lambda s, d: table(s, d, "events").agg(F.max("ts").alias("last_ts")).where(F.col("last_ts") < TM.ntz("2024-02-01 00:00:00")), """
SELECT max(ts) AS last_ts FROM events HAVING max(ts) < TIMESTAMP '2024-02-01 00:00:00' """)
_reg("share_of_total", lambda s, d: Q.with_share(table(s, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")), "n"), """
SELECT o_orderpriority, count(*)::BIGINT AS n, round(count(*)::DOUBLE * 100.0::DOUBLE / (sum(count(*)) OVER ())::DOUBLE, 2) AS pct FROM orders GROUP BY 1 """)
_reg("ratio_guarded", lambda s, d: table(s, d, "lineitem").groupBy("l_suppkey").agg(F.round(ratio(F.sum("l_tax"), F.sum(F.col("l_discount") * 0)), 4).alias("never"),
    F.round(ratio(F.sum("l_extendedprice"), F.sum("l_quantity")), 4).alias("unit_price")), """
SELECT l_suppkey, NULL::DOUBLE AS never, round(sum(l_extendedprice) / nullif(sum(l_quantity), 0), 4) AS unit_price FROM lineitem GROUP BY 1 """)
_reg("lag_previous", lambda s, d: WN.lag_over_time(table(s, d, "events").select("event_id", "event_type", "ts"), ["event_type"], "ts", "prev_ts", ["event_id"], unit="day"), """
SELECT event_id, event_type, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev_ts FROM events """)
_reg("running_total", lambda s, d: WN.running_before(D.file_listing(s, d).select("name", "size", "last_modified"), "size", "last_modified", ["name"], "before"), """
SELECT name, size, last_modified, coalesce(sum(size) OVER (ORDER BY last_modified, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM file_listing """, "file_listing")
_reg("moving_average", lambda s, d: table(s, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n")).withColumn(
    "avg7", F.round(F.avg("n").over(Window.orderBy("day").rowsBetween(-7, -1)), 6)), """
, x AS (SELECT 1) SELECT day, n, round(avg(n) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS avg7 FROM (SELECT event_timestamp::DATE AS day, count(*)::BIGINT AS n FROM raw_events GROUP BY 1) """, "raw_events")
_reg("sort_by_case", lambda s, d: table(s, d, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.min("o_totalprice").alias("least")).orderBy(
    F.when(F.col("o_orderpriority").startswith("1"), 0).otherwise(1), F.asc_nulls_last("least")), """
SELECT o_orderpriority, count(*)::BIGINT AS n, min(o_totalprice) AS least FROM orders GROUP BY 1 """)
_reg("top_orders", lambda s, d: table(s, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey", "o_totalprice"), """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100 """)
_reg("union_all", lambda s, d: table(s, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance")).unionByName(
    table(s, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"))), """
SELECT 'customer' AS kind, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier', s_acctbal FROM supplier """)

# ---- scalar functions ---------------------------------------------------------------------
_reg("string_functions", lambda s, d: D.raw_events(s, d).select(
    "event_id", F.upper("event_type").alias("u"), F.left("event_type", F.lit(3)).alias("l3"), F.length("props").alias("n"),
    F.split_part("_source_file", F.lit("/"), F.lit(2)).alias("year"), F.split_part("_source_file", F.lit("/"), F.lit(-1)).alias("last"),
    F.concat(F.col("event_type"), F.lit(None).cast("string")).alias("null_concat")), """
SELECT event_id, upper(event_type) AS u, left(event_type, 3) AS l3, length(props)::INTEGER AS n, split_part(_source_file, '/', 2) AS year, split_part(_source_file, '/', -1) AS last, NULL::VARCHAR AS null_concat FROM raw_events """, "raw_events")
_reg("regex_functions", lambda s, d: table(s, d, "pages").select(
    "page_id", TX.base_name("url").alias("base"), F.regexp_extract("url", r"(?i)HTTPS?://([^/]+)", 1).alias("host"),
    F.regexp_replace("url", "[0-9]+", "#").alias("masked"), F.col("url").rlike("^https").alias("secure")), r"""
SELECT page_id, regexp_extract(url, '[^/]+$') AS base, regexp_extract(url, '(?i)HTTPS?://([^/]+)', 1) AS host, regexp_replace(url, '[0-9]+', '#', 'g') AS masked, regexp_matches(url, '^https') AS secure FROM pages """)
_reg("hash_functions", lambda s, d: table(s, d, "documents").select("doc_id", F.md5("text").alias("digest")), "SELECT doc_id, md5(text) AS digest FROM documents")
_reg("conversion_functions", lambda s, d: table(s, d, "orders").select(
    "o_orderkey", F.date_format("o_orderdate", TM.spark_format("YYYY-MM-DD HH24:MI:SS")).alias("shown"),
    F.to_date(F.date_format("o_orderdate", "yyyyMMdd"), TM.spark_format("YYYYMMDD")).alias("d"),
    F.col("o_orderpriority").try_cast("int").alias("not_int"), F.left("o_orderpriority", F.lit(1)).try_cast("int").alias("priority"),
    F.try_to_number(F.left("o_orderpriority", F.lit(1)), F.lit("9")).cast("int").alias("num")), """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS shown, o_orderdate::DATE AS d, TRY_CAST(o_orderpriority AS INTEGER) AS not_int, left(o_orderpriority, 1)::INTEGER AS priority, left(o_orderpriority, 1)::INTEGER AS num FROM orders """)
_reg("date_functions", lambda s, d: D.raw_events(s, d).select(
    "event_id", *[TM.trunc(u, "event_timestamp").alias(f"{u}_start") for u in ("minute", "hour", "day", "week", "month")],
    F.expr("timestampadd(HOUR, 5, event_timestamp)").alias("later"), TM.diff("second", "event_timestamp", "_loaded_at").alias("ds"), TM.diff("minute", "event_timestamp", "_loaded_at").alias("dm"),
    TM.diff("hour", "event_timestamp", "_loaded_at").alias("dh"), F.year("event_timestamp").alias("y"), F.month("event_timestamp").alias("m"), F.hour("event_timestamp").alias("h"),
    F.dayname("event_timestamp").alias("dn"), F.to_date("event_timestamp").alias("d")), """
SELECT event_id, date_trunc('minute', event_timestamp)::TIMESTAMP AS minute_start, date_trunc('hour', event_timestamp)::TIMESTAMP AS hour_start, date_trunc('day', event_timestamp)::TIMESTAMP AS day_start,
  date_trunc('week', event_timestamp)::TIMESTAMP AS week_start, date_trunc('month', event_timestamp)::TIMESTAMP AS month_start, event_timestamp + INTERVAL 5 HOUR AS later,
  date_diff('second', event_timestamp, _loaded_at) AS ds, date_diff('minute', event_timestamp, _loaded_at) AS dm, date_diff('hour', event_timestamp, _loaded_at) AS dh,
  year(event_timestamp)::INTEGER AS y, month(event_timestamp)::INTEGER AS m, hour(event_timestamp)::INTEGER AS h, substr(dayname(event_timestamp), 1, 3) AS dn, event_timestamp::DATE AS d FROM raw_events """, "raw_events")
_reg("null_functions", lambda s, d: D.raw_customers(s, d).select("customer_id", F.coalesce("email", F.lit("none")).alias("email"), F.nullif("status", F.lit("BUILDING")).alias("status")), """
SELECT customer_id, coalesce(email, 'none') AS email, nullif(status, 'BUILDING') AS status FROM raw_customers """, "raw_customers")
_reg("math_functions", lambda s, d: table(s, d, "customer").select("c_custkey", F.round("c_acctbal", 0).alias("r"), F.abs("c_acctbal").alias("a"), F.round(F.col("c_acctbal") * 1.0 / 7, 6).alias("q")), """
SELECT c_custkey, round(c_acctbal, 0) AS r, abs(c_acctbal) AS a, round(c_acctbal * 1.0 / 7, 6) AS q FROM customer """)
_reg("document_functions", lambda s, d: table(s, d, "events").select(
    "event_id", F.schema_of_variant(F.parse_json("props")).alias("shape"), F.element_at(F.json_object_keys("props"), 1).alias("first_key"),
    F.to_json(F.struct("event_id", "event_type")).alias("built")), """
SELECT event_id, 'OBJECT<k: BIGINT>' AS shape, json_keys(props)[1] AS first_key, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS built FROM events """)
_reg("current_user", lambda s, d: table(s, d, "nation").select("n_nationkey", (F.length(F.current_user()) > 0).alias("known")), "SELECT n_nationkey, true AS known FROM nation")
