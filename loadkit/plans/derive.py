"""Operational inputs derived from the given tables, once for Spark and once as SQL text.

The given tables are clean and carry no load history, so both engines derive the same
history, usage, status and listing rows from all of `events` / `orders` / `customer` by
fixed arithmetic. Every row of the base table takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF = "2024-01-31 00:00:00"
ORDERS_AS_OF = "2001-08-02 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def decimal_round(expr: str, digits: int) -> str:
    """SQL for rounding half away from zero on the decimal value, as both report dialects do."""
    return f"round(({expr})::DECIMAL(38, 12), {digits})::DOUBLE"


def with_sql(*names: str) -> str:
    """WITH clause holding the named derived tables and what they need."""
    order, todo = [], list(names)
    while todo:
        name = todo.pop(0)
        needs = [n for n in CTES if n != name and f" {n} " in CTES[name].replace("\n", " ")]
        todo.extend(needs)
        if name in order:
            order.remove(name)
        order.insert(0, name)
    seen = list(dict.fromkeys(order))
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in seen)


CTES = {
    "raw_events": """
SELECT event_id, event_type, ts AS event_timestamp, user_id, value, props,
       ts + to_seconds(event_id % 300) AS _loaded_at,
       'events/' || strftime(ts, '%Y/%m/%d') || '/batch_' || lpad((event_id % 4)::VARCHAR, 3, '0') || '.json' AS _source_file
FROM events """,
    "file_rows": """
SELECT _source_file, count(*)::BIGINT AS n, count(*) FILTER (event_id % 97 <> 0)::BIGINT AS good,
       sum(length(props) + 60)::BIGINT AS file_size, max(_loaded_at) AS last_load_time,
       day(min(event_timestamp)) AS d
FROM raw_events GROUP BY _source_file """,
    "first_loads": """
SELECT 'raw.events' AS table_name, regexp_replace(_source_file, '[^/]+$', '') AS stage_location,
       _source_file AS file_name, CASE WHEN d % 2 = 0 THEN 'events_pipe' END AS pipe_name,
       CASE WHEN d % 13 = 0 THEN 'LOAD_FAILED' WHEN good = n THEN 'LOADED' ELSE 'PARTIALLY_LOADED' END AS status,
       n AS row_parsed, CASE WHEN d % 13 = 0 THEN 0 ELSE good END::BIGINT AS row_count, file_size,
       1::BIGINT AS error_limit, n - CASE WHEN d % 13 = 0 THEN 0 ELSE good END::BIGINT AS errors_seen,
       CASE WHEN d % 13 = 0 OR good < n THEN CASE WHEN d % 2 = 0 THEN 'Numeric value: not recognized' ELSE 'Timestamp: not recognized' END END AS first_error_message,
       CASE WHEN d % 13 = 0 OR good < n THEN 1 + d END::BIGINT AS first_error_line_number,
       CASE WHEN d % 13 = 0 OR good < n THEN 10 + d END::BIGINT AS first_error_character,
       CASE WHEN d % 13 = 0 OR good < n THEN CASE WHEN d % 2 = 0 THEN 'value' ELSE 'event_timestamp' END END AS first_error_column_name,
       last_load_time, d
FROM file_rows """,
    "load_history": """
SELECT * EXCLUDE (d) FROM first_loads
UNION ALL
SELECT * EXCLUDE (d) REPLACE (last_load_time + INTERVAL 1 DAY AS last_load_time) FROM first_loads WHERE d % 10 = 0 """,
    "pipe_usage": """
SELECT 'pipe_' || (user_id % 3)::VARCHAR AS pipe_name, date_trunc('hour', ts)::TIMESTAMP AS start_time,
       count(*)::DOUBLE / 1000 AS credits_used, count(DISTINCT event_type)::BIGINT AS files_inserted,
       sum(length(props) * 100000)::BIGINT AS bytes_inserted
FROM events GROUP BY 1, 2 """,
    "stream_migration": """
SELECT 'raw' AS database_name, 'streaming' AS schema_name, event_type AS table_name,
       min(ts) AS start_time, max(ts) AS end_time, count(*)::DOUBLE / 500 AS credits_used,
       sum(length(props) * 1000)::BIGINT AS num_bytes_migrated, count(*)::BIGINT AS num_rows_migrated
FROM events GROUP BY event_type, date_trunc('hour', ts) """,
    "query_history": """
SELECT o_orderkey AS query_id,
       CASE WHEN o_custkey % 2 = 0 THEN 'COPY INTO raw.events' ELSE 'SELECT * FROM lake.events_archive' END AS query_text,
       CASE WHEN o_custkey % 2 = 0 THEN 'COPY' ELSE 'SELECT' END AS query_type,
       'wh_' || lower(o_orderstatus) AS warehouse_name,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'X-Small' WHEN '2' THEN 'Small' WHEN '3' THEN 'Medium' WHEN '4' THEN 'Large' ELSE 'X-Large' END AS warehouse_size,
       o_orderdate AS start_time, round(o_totalprice)::BIGINT AS execution_time,
       round(o_totalprice)::BIGINT + 250 AS total_elapsed_time,
       round(o_totalprice)::BIGINT * 10000 AS bytes_scanned,
       o_custkey % 150 + 1 AS partitions_scanned, 200::BIGINT AS partitions_total,
       round(o_totalprice)::DOUBLE / 1000000 AS credits_used_cloud_services
FROM orders """,
    "pipe_status": """
SELECT 'pipe_' || user_id::VARCHAR AS pipe_name,
       '{"executionState":"' || CASE user_id % 5 WHEN 0 THEN 'PAUSED' WHEN 1 THEN 'STALLED' ELSE 'RUNNING' END
       || '","pendingFileCount":' || (count(*) * 10)::VARCHAR
       || ',"lastReceivedMessageTimestamp":"' || strftime(max(ts), '%Y-%m-%d %H:%M:%S')
       || '","notificationChannelName":"channel_' || user_id::VARCHAR || '"}' AS status_json
FROM events GROUP BY user_id """,
    "pipes": """
SELECT DISTINCT 'pipe_' || (user_id % 3)::VARCHAR AS pipe_name,
       CASE user_id % 3 WHEN 0 THEN 'copy into raw.events from @stage' WHEN 1 THEN 'COPY INTO raw.orders FROM @stage' ELSE 'COPY INTO raw.events FROM @other' END AS definition
FROM events """,
    "file_listing": """
SELECT 'stage/data/' || strftime(o_orderdate, '%Y/%m/%d') || '/file_' || o_orderkey::VARCHAR || '.parquet' AS name,
       o_orderkey * 40000 AS size, o_orderdate AS last_modified
FROM orders """,
    "raw_customers": """
SELECT c_custkey::VARCHAR AS customer_id, c_name AS customer_name,
       CASE WHEN c_custkey % 40 = 1 THEN NULL WHEN c_custkey % 50 = 0 THEN lower(c_name) ELSE replace(lower(c_name), '#', '.') || '@example.com' END AS email,
       c_mktsegment AS status, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(c_custkey % 1000) AS updated_at
FROM customer """,
    "customer_changes": """
SELECT customer_id, customer_name, email, 'CHANGED' AS status, updated_at + INTERVAL 1 DAY AS updated_at FROM raw_customers WHERE customer_id::BIGINT % 10 = 0
UNION ALL
SELECT customer_id, customer_name, email, 'STALE' AS status, updated_at - INTERVAL 1 DAY AS updated_at FROM raw_customers WHERE customer_id::BIGINT % 100 IN (0, 1)
UNION ALL
SELECT 'N' || customer_id AS customer_id, customer_name, email, 'NEW' AS status, updated_at FROM raw_customers WHERE customer_id::BIGINT % 50 = 3 """,
    "raw_orders": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS order_total, o_orderstatus AS status, o_orderdate AS updated_at
FROM orders """,
    "order_changes": """
SELECT order_id + CASE WHEN order_id % 10 = 4 THEN 100000000 ELSE 0 END AS order_id, customer_id, order_total + 1 AS order_total, 'X' AS status,
       CASE WHEN order_id % 10 = 0 THEN 'D' WHEN order_id % 10 = 4 THEN 'I' ELSE 'U' END AS operation,
       updated_at + INTERVAL 1 DAY AS change_timestamp
FROM raw_orders WHERE order_id % 10 <= 4
UNION ALL
SELECT order_id, customer_id, order_total + 2 AS order_total, 'Y' AS status, 'U' AS operation, updated_at + INTERVAL 2 DAY AS change_timestamp
FROM raw_orders WHERE order_id % 7 = 0 AND order_id % 10 BETWEEN 1 AND 3 """,
    "doubled_events": """
SELECT *, 0 AS copy_no FROM raw_events
UNION ALL
SELECT * REPLACE (_loaded_at + INTERVAL 1 HOUR AS _loaded_at), 1 AS copy_no FROM raw_events WHERE event_type = 'error' """,
}


def raw_events(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    path = F.concat(
        F.lit("events/"), F.date_format("ts", "yyyy/MM/dd"), F.lit("/batch_"),
        F.lpad((F.col("event_id") % 4).cast("string"), 3, "0"), F.lit(".json"),
    )
    return e.select(
        "event_id", "event_type", F.col("ts").alias("event_timestamp"), "user_id", "value", "props",
        F.expr("ts + make_dt_interval(0, 0, 0, event_id % 300)").alias("_loaded_at"),
        path.alias("_source_file"),
    )


def load_history(spark, sf_dir) -> DataFrame:
    e = raw_events(spark, sf_dir)
    per_file = e.groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("event_id") % 97 != 0).alias("good"),
        F.sum(F.length("props") + 60).alias("file_size"),
        F.max("_loaded_at").alias("last_load_time"),
        F.day(F.min("event_timestamp")).alias("d"),
    )
    d = F.col("d")
    loaded = F.when(d % 13 == 0, F.lit(0)).otherwise(F.col("good")).cast("bigint")
    bad = (d % 13 == 0) | (F.col("good") < F.col("n"))
    even = d % 2 == 0
    first = per_file.select(
        F.lit("raw.events").alias("table_name"),
        F.regexp_replace("_source_file", "[^/]+$", "").alias("stage_location"),
        F.col("_source_file").alias("file_name"),
        F.when(even, F.lit("events_pipe")).alias("pipe_name"),
        F.when(d % 13 == 0, "LOAD_FAILED").when(F.col("good") == F.col("n"), "LOADED")
        .otherwise("PARTIALLY_LOADED").alias("status"),
        F.col("n").alias("row_parsed"),
        loaded.alias("row_count"),
        "file_size",
        F.lit(1).cast("bigint").alias("error_limit"),
        (F.col("n") - loaded).alias("errors_seen"),
        F.when(bad, F.when(even, "Numeric value: not recognized").otherwise("Timestamp: not recognized"))
        .alias("first_error_message"),
        F.when(bad, d + 1).cast("bigint").alias("first_error_line_number"),
        F.when(bad, d + 10).cast("bigint").alias("first_error_character"),
        F.when(bad, F.when(even, "value").otherwise("event_timestamp")).alias("first_error_column_name"),
        "last_load_time", "d",
    )
    again = first.where(d % 10 == 0).withColumn("last_load_time", F.expr("last_load_time + interval 1 day"))
    return first.unionByName(again).drop("d")


def pipe_usage(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy(
        F.concat(F.lit("pipe_"), (F.col("user_id") % 3).cast("string")).alias("pipe_name"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("start_time"),
    ).agg(
        (F.count(F.lit(1)).cast("double") / 1000).alias("credits_used"),
        F.count_distinct("event_type").alias("files_inserted"),
        F.sum(F.length("props") * 100000).alias("bytes_inserted"),
    )


def stream_migration(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("table_name"), F.date_trunc("hour", "ts").alias("_h")).agg(
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"),
        (F.count(F.lit(1)).cast("double") / 500).alias("credits_used"),
        F.sum(F.length("props") * 1000).alias("num_bytes_migrated"),
        F.count(F.lit(1)).alias("num_rows_migrated"),
    ).select(F.lit("raw").alias("database_name"), F.lit("streaming").alias("schema_name"), "*").drop("_h")


def query_history(spark, sf_dir) -> DataFrame:
    copying = F.col("o_custkey") % 2 == 0
    ms = F.round("o_totalprice").cast("bigint")
    size = F.create_map(*[F.lit(x) for x in ("1", "X-Small", "2", "Small", "3", "Medium", "4", "Large", "5", "X-Large")])
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("query_id"),
        F.when(copying, "COPY INTO raw.events").otherwise("SELECT * FROM lake.events_archive").alias("query_text"),
        F.when(copying, "COPY").otherwise("SELECT").alias("query_type"),
        F.concat(F.lit("wh_"), F.lower("o_orderstatus")).alias("warehouse_name"),
        F.coalesce(size[F.substring("o_orderpriority", 1, 1)], F.lit("X-Large")).alias("warehouse_size"),
        F.col("o_orderdate").alias("start_time"),
        ms.alias("execution_time"), (ms + 250).alias("total_elapsed_time"), (ms * 10000).alias("bytes_scanned"),
        (F.col("o_custkey") % 150 + 1).alias("partitions_scanned"),
        F.lit(200).cast("bigint").alias("partitions_total"),
        (ms.cast("double") / 1000000).alias("credits_used_cloud_services"),
    )


def pipe_status(spark, sf_dir) -> DataFrame:
    user = F.col("user_id").cast("string")
    state = F.when(F.col("user_id") % 5 == 0, "PAUSED").when(F.col("user_id") % 5 == 1, "STALLED").otherwise("RUNNING")
    grouped = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("last"))
    return grouped.select(
        F.concat(F.lit("pipe_"), user).alias("pipe_name"),
        F.to_json(F.struct(
            state.alias("executionState"), (F.col("n") * 10).alias("pendingFileCount"),
            F.date_format("last", "yyyy-MM-dd HH:mm:ss").alias("lastReceivedMessageTimestamp"),
            F.concat(F.lit("channel_"), user).alias("notificationChannelName"),
        )).alias("status_json"),
    )


def pipes(spark, sf_dir) -> DataFrame:
    kind = F.col("user_id") % 3
    return table(spark, sf_dir, "events").select(kind.alias("k")).distinct().select(
        F.concat(F.lit("pipe_"), F.col("k").cast("string")).alias("pipe_name"),
        F.when(F.col("k") == 0, "copy into raw.events from @stage")
        .when(F.col("k") == 1, "COPY INTO raw.orders FROM @stage")
        .otherwise("COPY INTO raw.events FROM @other").alias("definition"),
    )


def file_listing(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("stage/data/"), F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit("/file_"),
                 F.col("o_orderkey").cast("string"), F.lit(".parquet")).alias("name"),
        (F.col("o_orderkey") * 40000).alias("size"), F.col("o_orderdate").alias("last_modified"),
    )


def raw_customers(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    name = F.lower("c_name")
    return c.select(
        key.cast("string").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.when(key % 40 == 1, F.lit(None)).when(key % 50 == 0, name)
        .otherwise(F.concat(F.replace(name, F.lit("#"), F.lit(".")), F.lit("@example.com"))).alias("email"),
        F.col("c_mktsegment").alias("status"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(c_custkey % 1000 as int))").alias("updated_at"),
    )


def customer_changes(spark, sf_dir) -> DataFrame:
    c = raw_customers(spark, sf_dir)
    key = F.col("customer_id").cast("bigint")
    day = F.expr("interval 1 day")
    newer = c.where(key % 10 == 0).withColumn("status", F.lit("CHANGED")).withColumn("updated_at", F.col("updated_at") + day)
    stale = c.where((key % 100).isin(0, 1)).withColumn("status", F.lit("STALE")).withColumn("updated_at", F.col("updated_at") - day)
    fresh = c.where(key % 50 == 3).withColumn("status", F.lit("NEW")).withColumn("customer_id", F.concat(F.lit("N"), F.col("customer_id")))
    return newer.unionByName(stale).unionByName(fresh)


def raw_orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("order_total"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("updated_at"),
    )


def order_changes(spark, sf_dir) -> DataFrame:
    o = raw_orders(spark, sf_dir)
    digit = F.col("order_id") % 10
    first = o.where(digit <= 4).select(
        (F.col("order_id") + F.when(digit == 4, 100000000).otherwise(0)).alias("order_id"), "customer_id",
        (F.col("order_total") + 1).alias("order_total"), F.lit("X").alias("status"),
        F.when(digit == 0, "D").when(digit == 4, "I").otherwise("U").alias("operation"),
        F.expr("updated_at + interval 1 day").alias("change_timestamp"),
    )
    second = o.where((F.col("order_id") % 7 == 0) & digit.between(1, 3)).select(
        "order_id", "customer_id", (F.col("order_total") + 2).alias("order_total"), F.lit("Y").alias("status"),
        F.lit("U").alias("operation"), F.expr("updated_at + interval 2 day").alias("change_timestamp"),
    )
    return first.unionByName(second)


def doubled_events(spark, sf_dir) -> DataFrame:
    """raw_events with every `error` event loaded a second time one hour later."""
    e = raw_events(spark, sf_dir)
    again = e.where("event_type = 'error'").withColumn("_loaded_at", F.expr("_loaded_at + interval 1 hour"))
    return e.withColumn("copy_no", F.lit(0)).unionByName(again.withColumn("copy_no", F.lit(1)))
