"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Loads, merges and streams write real tables; other queries write to the noop sink, so that
every row of their result is computed. Each query runs once to warm up code and files,
then $BENCH_RUNS times (3); the median counts. Stages (input files) are made before timing.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import functions as F, types as T

from loadkit.operators import copy as C, external as E, merge as M, reconcile as RC
from loadkit.operators.versioned import Table
from loadkit.plans import derive as D, registry, stages as G
from loadkit.plans.copying import EVENT_SCHEMA
from loadkit.session import build_session, work_path
from loadkit.sources.formats import FileFormat
from loadkit.streaming.rowstream import row_stream

AS_OF = D.AS_OF
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# analytic queries of every family, timed as registered
REGISTERED = (
    "status_summary", "load_sla", "health_check", "cost_by_method", "warehouse_cost", "stream_throughput", "size_distribution", "file_stats",
    "null_rules", "uniqueness", "referential_shares", "quality_report", "reconcile_files", "daily_deviation", "batch_checksum", "row_hash",
    "delta_compare", "freshness_by_weekday", "dedupe_latest", "latency_by_minute", "percentile_95", "evaluate_alerts", "json_paths",
    "merge_change_feed", "cdc_current_state", "grouped_aggregates",
)


def lineitem_csv(spark, sf):
    """lineitem as CSV with one bad quantity in a hundred rows."""
    def make():
        path = work_path(spark, "bench-csv")
        li = D.table(spark, sf, "lineitem")
        bad = F.when(F.col("l_orderkey") % 100 == 0, "many").otherwise(F.col("l_quantity").cast("string"))
        li.withColumn("l_quantity", bad).write.option("header", "true").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
        return path

    return G.once(spark, (sf, "bench-csv"), make)


def load_json(spark, sf):
    t = Table(spark, work_path(spark, "b"))
    C.copy_into(spark, t, G.json_stage(spark, sf), FileFormat.json(), EVENT_SCHEMA, AS_OF, on_error="CONTINUE").collect()


def load_csv(spark, sf):
    t = Table(spark, work_path(spark, "b"))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in D.table(spark, sf, "lineitem").schema])
    C.copy_into(spark, t, lineitem_csv(spark, sf), FileFormat.csv(skip_header=1), schema, AS_OF, on_error="CONTINUE").collect()


def load_parquet(spark, sf):
    t = Table(spark, work_path(spark, "b"))
    C.copy_into(spark, t, G.parquet_stage(spark, sf, "lineitem"), FileFormat.parquet(), D.table(spark, sf, "lineitem").schema, AS_OF).collect()


def merge_orders(spark, sf):
    """10 % updates and 1 % deletes into a table of all orders."""
    t = Table(spark, work_path(spark, "b"))
    orders = D.raw_orders(spark, sf)
    t.append(orders, AS_OF)
    k = F.col("order_id") % 100
    feed = orders.where(k < 11).select(
        "order_id", "customer_id", (F.col("order_total") + 1).alias("order_total"), "status",
        F.when(k == 10, "D").otherwise("U").alias("operation"), F.expr("updated_at + interval 1 day").alias("change_timestamp"))
    M.apply(t, lambda now: M.merge_changes(now, feed, "order_id"), AS_OF).collect()


def tiny_files(spark, sf, n):
    def make():
        path = work_path(spark, f"bench-files{n}")
        D.table(spark, sf, "lineitem").repartition(n).write.parquet(path)
        return path

    path = G.once(spark, (sf, "files", n), make)
    spark.read.parquet(path).agg(F.sum("l_quantity")).collect()


def dated_events(spark, sf):
    def make():
        path = work_path(spark, "bench-dated")
        E.repartition_layout(D.table(spark, sf, "events"), "ts", path)
        return path

    return G.once(spark, (sf, "bench-dated"), make)


def one_day(spark, sf, pruned):
    df = spark.read.parquet(dated_events(spark, sf))
    day = df.where("year = 2024 and month = 1 and day = 15") if pruned else df.where("date_format(ts, 'yyyy-MM-dd') = '2024-01-15'")
    day.agg(F.sum("value")).collect()


def stream_files(spark, sf):
    t = Table(spark, work_path(spark, "b"))
    source = spark.readStream.schema("event_id bigint, event_type string, value string").option("recursiveFileLookup", "true").json(G.json_stage(spark, sf))
    row_stream(source, t, "bench", work_path(spark, "ckpt"), AS_OF).awaitTermination()


def hash_sum(spark, sf):
    RC.numeric_sums(D.table(spark, sf, "lineitem"), "l_orderkey", {"total_checksum": "l_extendedprice"}).collect()


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    jobs = {
        "load_json_continue": lambda: load_json(spark, sf), "load_csv_continue": lambda: load_csv(spark, sf),
        "load_parquet_trusted": lambda: load_parquet(spark, sf), "merge_updates_deletes": lambda: merge_orders(spark, sf),
        "scan_1000_files": lambda: tiny_files(spark, sf, 1000), "scan_compacted": lambda: tiny_files(spark, sf, 4),
        "one_day_pruned": lambda: one_day(spark, sf, True), "one_day_unpruned": lambda: one_day(spark, sf, False),
        "stream_files": lambda: stream_files(spark, sf), "checksum_hash_sum": lambda: hash_sum(spark, sf),
    }
    fns = registry.all_queries()
    for name in REGISTERED:
        jobs[name] = lambda fn=fns[name]: fn(spark, sf).write.format("noop").mode("overwrite").save()
    times = {}
    for name, job in jobs.items():
        job()
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            job()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    n_events, n_lines = D.table(spark, sf, "events").count(), D.table(spark, sf, "lineitem").count()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/")),
        "rates": {
            "json_rows_per_sec": round(n_events / times["load_json_continue"]), "csv_rows_per_sec": round(n_lines / times["load_csv_continue"]),
            "parquet_rows_per_sec": round(n_lines / times["load_parquet_trusted"]), "stream_rows_per_sec": round(n_events / times["stream_files"]),
            "tiny_file_ratio": round(times["scan_1000_files"] / times["scan_compacted"], 2),
            "pruning_ratio": round(times["one_day_unpruned"] / times["one_day_pruned"], 2),
        },
    }))
    spark.stop()


if __name__ == "__main__":
    main()
