"""External tables, partitions, stored views and tiers."""

from pyspark.sql import functions as F, types as T

from ..operators import external as O
from ..session import work_path
from ..sources import fs
from ..sources.formats import FileFormat
from . import derive as D, stages as G
from .derive import AS_OF, table, with_sql
from .registry import query

W = with_sql("raw_events")
_EVENT_COLUMNS = {
    "event_id": ("event_id", "bigint"), "kind": ("event_type", "string"), "value": ("value", "double"), "k": ("payload.k", "int"),
}
query("external_json", W + """
SELECT event_id, event_type AS kind, value, json_extract_string(props, '$.k')::INTEGER AS k FROM raw_events """)(
    lambda s, d: O.external_table(s, G.json_stage(s, d, False), FileFormat.json(), _EVENT_COLUMNS))
query("external_csv", """
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS total FROM orders """)(
    lambda s, d: O.external_table(s, G.csv_stage(s, d), FileFormat.csv(delimiter="|", skip_header=1), {"order_id": ("c1", "bigint"), "total": ("c4", "double")}))
query("external_parquet", "SELECT o_orderkey AS id, o_totalprice::VARCHAR AS price FROM orders")(
    lambda s, d: O.external_table(s, G.parquet_stage(s, d), FileFormat.parquet(), {"id": ("o_orderkey", "bigint"), "price": ("o_totalprice", "string")}))
query("external_inferred", "SELECT * FROM orders")(lambda s, d: O.external_table(s, G.parquet_stage(s, d), FileFormat.parquet()))


def dated(s, d) -> str:
    def make():
        path = work_path(s, "dated")
        O.repartition_layout(table(s, d, "events"), "ts", path)
        return path

    return G.once(s, (d, "dated"), make)


def _flat(s, d) -> str:
    """The same rows in yyyy/mm/dd directories without key names."""
    def make():
        path = work_path(s, "flat")
        keyed = f"{path}-keyed"
        table(s, d, "events").withColumn("_day", F.date_format("ts", "yyyy/MM/dd")).repartition("_day").write.partitionBy("_day").parquet(keyed)
        for name in fs.children(s, keyed):
            if name.startswith("_day="):
                fs.rename(s, f"{keyed}/{name}", f"{path}/{name[5:].replace('%2F', '/')}")
        return path

    return G.once(s, (d, "flat"), make)


_HIVE_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string, year int, month int, day int"


def _hive(s, d):
    return O.hive_partitioned(s, dated(s, d), FileFormat.parquet(), _HIVE_SCHEMA)


query("hive_partitions", "SELECT event_id, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day FROM events WHERE day(ts) = 15 AND value > 10")(
    lambda s, d: _hive(s, d).where("year = 2024 and month = 1 and day = 15 and value > 10").select("event_id", "year", "month", "day"))
query("partition_range", "SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10 06:00:00' AND TIMESTAMP '2024-01-12 18:00:00'")(
    lambda s, d: O.with_partition_filter(_hive(s, d), "ts", "2024-01-10 06:00:00", "2024-01-12 18:00:00").select("event_id"))
query("positional_partitions", "SELECT event_id, year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day FROM events")(
    lambda s, d: O.positional_partitioned(s.read.option("recursiveFileLookup", "true").parquet(_flat(s, d)), {
        "year": (-4, "int"), "month": (-3, "int"), "day": (-2, "int")}).select("event_id", "year", "month", "day"))
query("path_date", "SELECT event_id, ts::DATE AS event_date FROM events")(
    lambda s, d: O.path_date(s.read.option("recursiveFileLookup", "true").parquet(_flat(s, d))).select("event_id", "event_date"))
query("date_layout_rows", "SELECT count(*)::BIGINT AS n, count(DISTINCT ts::DATE)::BIGINT AS days FROM events")(
    lambda s, d: _hive(s, d).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("year", "month", "day").alias("days")))


def _pruned(s, d):
    """Whether the files that a day's read touches are just those of its directory, and not all."""
    day, everything = _hive(s, d).where("year = 2024 and month = 1 and day = 15"), _hive(s, d)
    own = sum("/month=1/day=15/" in f or "/month=01/day=15/" in f for f in everything.inputFiles())
    found = O.pruning_report(everything, day)
    return found.select((F.col("partitions_scanned") == own).alias("own_files_only"), (F.col("partitions_scanned") < F.col("partitions_total")).alias("fewer_than_all"))


query("pruning_report", "SELECT true AS own_files_only, count(DISTINCT ts::DATE) > 1 AS fewer_than_all FROM events")(_pruned)
query("external_rows_per_file", "SELECT count(*)::BIGINT AS row_count FROM orders")(
    lambda s, d: O.rows_per_file(O.external_table(s, G.parquet_stage(s, d), FileFormat.parquet())).agg(F.sum("row_count").alias("row_count")))


def _catalog(s, d):
    """A catalog table over dated directories: one partition dropped, one added again."""
    name = "loadkit_events"
    schema = _HIVE_SCHEMA
    O.catalog_table(s, name, dated(s, d), "parquet", schema, ["year", "month", "day"])
    O.drop_partition(s, name, {"year": 2024, "month": 1, "day": 15}, {"year": 2024, "month": 1, "day": 16})
    O.add_partition(s, name, {"year": 2024, "month": 1, "day": 16})
    return O.show_partitions(s, name)


query("catalog_partitions", """
SELECT DISTINCT 'year=' || year(ts) || '/month=' || month(ts) || '/day=' || day(ts) AS partition FROM events WHERE ts::DATE <> DATE '2024-01-15' """)(_catalog)


def _view(s, d):
    """A stored view of the last 30 days, refreshed, suspended, resumed."""
    view = O.StoredView(s, work_path(s, "hot"), lambda as_of: table(s, d, "events").where(F.col("ts") >= F.expr(f"timestamp_ntz '{as_of}' - interval 30 days")))
    view.refresh("2024-01-31 00:00:00")
    view.suspend()
    view.refresh("2024-02-10 00:00:00")
    view.resume()
    view.refresh("2024-02-20 00:00:00")
    return view.refreshes().select("snapshot_id", "refreshed_at", "rows")


query("stored_view_refreshes", """
SELECT 1::BIGINT AS snapshot_id, TIMESTAMP '2024-01-31' AS refreshed_at, count(*) FILTER (ts >= TIMESTAMP '2024-01-01')::BIGINT AS rows FROM events
UNION ALL SELECT 2, TIMESTAMP '2024-02-20', count(*) FILTER (ts >= TIMESTAMP '2024-01-21')::BIGINT FROM events """)(_view)
_SUMMARY = "SELECT ts::DATE AS event_date, event_type, count(*)::BIGINT AS event_count, count(DISTINCT user_id)::BIGINT AS unique_users FROM events GROUP BY 1, 2"
query("daily_summary", _SUMMARY)(lambda s, d: O.daily_summary(table(s, d, "events"), "ts", "event_type", "user_id"))
query("daily_totals", f"SELECT event_date, sum(event_count)::BIGINT AS total_events, sum(unique_users)::BIGINT AS sum_of_type_uniques FROM ({_SUMMARY}) GROUP BY 1")(
    lambda s, d: O.daily_totals(O.daily_summary(table(s, d, "events"), "ts", "event_type", "user_id")))
query("flatten_view", "SELECT event_id, event_type, json_extract_string(props, '$.k')::INTEGER AS k, NULL::VARCHAR AS city FROM events")(
    lambda s, d: O.flatten_view(table(s, d, "events").select("event_id", "event_type", "props"), "props", {"k": ("k", "int"), "city": ("location.city", "string")}))


def _tiers(s, d):
    """Each tier stamps its rows, so the answer shows which tier every row came from."""
    e = table(s, d, "events").select("event_id", "ts")
    hot, warm, cold = (e.withColumn("tier", F.lit(x)) for x in ("hot", "warm", "cold"))
    return O.tiered_read("2024-01-03 00:00:00", "2024-01-30 00:00:00", AS_OF, hot, warm, cold, "ts", hot_days=7, warm_days=20)


query("tiered_read", f"""
SELECT event_id, ts, CASE WHEN ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY THEN 'hot' WHEN ts >= TIMESTAMP '{AS_OF}' - INTERVAL 20 DAY THEN 'warm' ELSE 'cold' END AS tier
FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-30' """)(_tiers)
query("catalog_read", "SELECT n_nationkey, n_name FROM nation")(lambda s, d: (
    O.catalog_table(s, "loadkit_nations", _copy_of(s, d, "nation"), "parquet"), O.catalog_read(s, "spark_catalog.default.loadkit_nations").select("n_nationkey", "n_name"))[1])


def _copy_of(s, d, name):
    return G.parquet_stage(s, d, name)


def _streamed(s, d):
    """Auto refresh: files read as a stream into a table."""
    from ..operators.versioned import Table
    from ..streaming.rowstream import row_stream

    t = Table(s, work_path(s, "auto"))
    schema = T.StructType.fromDDL("event_id bigint, event_type string")
    row_stream(O.external_stream(s, G.json_stage(s, d, False), FileFormat.json(), schema), t, "auto", work_path(s, "ckpt"), AS_OF).awaitTermination()
    return t.read()


query("external_stream", W + "SELECT event_id, event_type FROM raw_events")(_streamed)
