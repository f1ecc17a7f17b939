"""Pipes, row streams, change streams and latency."""

from pyspark.sql import functions as F, types as T


from ..operators.merge import cdc_live, latest
from ..operators.versioned import Table
from ..session import work_path
from ..sources.formats import FileFormat
from ..streaming import latency as L, rowstream as R
from ..streaming.pipe import Pipe, backfill_if_behind
from . import derive as D, stages as G
from .copying import EVENT_SCHEMA, W as STAGED
from .derive import AS_OF, with_sql
from .merging import cdc_documents
from .registry import query

W = with_sql("raw_events")


def _pipe(s, d, **kw) -> Pipe:
    return Pipe(s, "events_pipe", G.json_stage(s, d), FileFormat.json(), EVENT_SCHEMA, Table(s, work_path(s, "piped")),
                work_path(s, "ckpt"), as_of=AS_OF, tracking_days=14, max_files=kw.pop("max_files", 40), **kw)


def _piped(s, d):
    p = _pipe(s, d)
    p.refresh()
    return p


query("pipe_rows", STAGED + "SELECT event_id, event_type, value FROM staged WHERE NOT b1 AND NOT b2 ")(
    lambda s, d: _piped(s, d).table.read().select("event_id", "event_type", "value"))


def _recreated(s, d):
    """Refresh twice, then a new pipe over the same table: nothing is loaded again."""
    p = _piped(s, d)
    p.refresh()
    again = p.recreate(work_path(s, "ckpt"))
    again.refresh()
    return again.table.read().agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


query("pipe_recreated", STAGED + "SELECT count(*)::BIGINT AS n, count(DISTINCT event_id)::BIGINT AS ids FROM staged WHERE NOT b1 AND NOT b2 ")(_recreated)


query("pipe_live_status", STAGED + """
SELECT 'before' AS phase, 'events_pipe' AS pipe_name, 'PAUSED' AS state, count(*)::BIGINT AS pending_files FROM files
UNION ALL SELECT 'middle', 'events_pipe', 'PAUSED', count(*) FILTER (file NOT LIKE 'd=2024-01-0%')::BIGINT FROM files """)(lambda s, d: _status(s, d))


def _status(s, d):
    """Both phases are taken when asked for, so each is stored before the next step."""
    p = _pipe(s, d)
    first = [tuple(r) for r in p.status().select(F.lit("before"), "pipe_name", "state", "pending_files").collect()]
    p.refresh("d=2024-01-0")
    second = [tuple(r) for r in p.status().select(F.lit("middle"), "pipe_name", "state", "pending_files").collect()]
    return s.createDataFrame(first + second, "phase string, pipe_name string, state string, pending_files bigint")


query("pipe_backfill", STAGED + "SELECT count(*)::BIGINT AS n FROM staged WHERE NOT b1 AND NOT b2 ")(lambda s, d: _backfilled(s, d))


def _backfilled(s, d):
    p = _pipe(s, d)
    backfill_if_behind(p, limit=100)
    return p.table.read().agg(F.count(F.lit(1)).alias("n"))


# ---- row streams -----------------------------------------------------------------------------


def _event_stream(s, d, schema="event_id string, event_type string, value string", faults=False, files=30):
    return s.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files).json(G.json_stage(s, d, faults))


def _rows(s, d):
    """Typed rows to the table, untypable ones to the dead letters, replayed without effect."""
    t, dead = Table(s, work_path(s, "rows")), Table(s, work_path(s, "dead"))
    ckpt = work_path(s, "ckpt")
    source = _event_stream(s, d).withColumn("value", F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value")))
    for _ in range(2):
        R.row_stream(source, t, "ch_1", ckpt, AS_OF, casts={"event_id": "bigint", "value": "double"}, dead_letters=dead).awaitTermination()
    good = t.read().agg(F.lit("loaded").alias("part"), F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return good.unionByName(dead.read().agg(F.lit("dead").alias("part"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("total")))


query("row_stream", W + """
SELECT 'loaded' AS part, count(*)::BIGINT AS n, round(sum(value), 2) AS total FROM raw_events WHERE event_type <> 'error'
UNION ALL SELECT 'dead', count(*)::BIGINT, NULL FROM raw_events WHERE event_type = 'error' """)(_rows)


def _token(s, d):
    t = Table(s, work_path(s, "rows"))
    R.row_stream(_event_stream(s, d, files=60), t, "ch_1", work_path(s, "ckpt"), AS_OF).awaitTermination()
    return R.offset_token(t, "ch_1")


query("offset_token", STAGED + "SELECT ceil(count(*) / 60.0)::BIGINT - 1 AS offset_token FROM files")(_token)


def _landed(s, d, landing):
    """Messages of two topics in files of (topic, value), each to its own table."""
    def make():
        path = work_path(s, "messages")
        e = D.raw_events(s, d)
        e.select(F.when(F.col("event_type") == "purchase", "orders").otherwise("events").alias("topic"),
                 F.to_json(F.struct("event_id", "value")).alias("value")).write.json(path)
        return path

    path = G.once(s, (d, "messages"), make)
    tables = {"orders": Table(s, work_path(s, "t1")), "events": Table(s, work_path(s, "t2"))}
    messages = s.readStream.schema("topic string, value string").option("maxFilesPerTrigger", 4).json(path)
    R.ingest_topics(messages, tables, work_path(s, "ckpt"), AS_OF, landing=landing).awaitTermination()
    return tables["orders"].read().unionByName(tables["events"].read())


def _topics(s, d):
    return _landed(s, d, T.StructType.fromDDL("event_id bigint, value double"))


query("ingest_topics", W + "SELECT event_id, value, CASE WHEN event_type = 'purchase' THEN 'orders' ELSE 'events' END AS record_topic FROM raw_events")(_topics)


_LANDED = "SELECT event_id, value, CASE WHEN event_type = 'purchase' THEN 'orders' ELSE 'events' END AS record_topic FROM raw_events"


def _landed_variant(s, d):
    part = lambda key, kind: F.variant_get("record_content", f"$.{key}", kind).alias(key)
    return _landed(s, d, "variant").select(part("event_id", "bigint"), part("value", "double"), "record_topic")


def _landed_inferred(s, d):
    """Columns and their types come from the payloads alone."""
    return _landed(s, d, "inferred").select("event_id", "value", "record_topic", F.col("record_content").isNull().alias("is_object"))


query("ingest_topics_variant", W + _LANDED)(_landed_variant)
query("ingest_topics_inferred", W + _LANDED.replace(" FROM", ", true AS is_object FROM"))(_landed_inferred)


def _flattened(s, d):
    """Array payloads flattened on a stream."""
    def make():
        path = work_path(s, "arrays")
        D.raw_events(s, d).select("event_type", F.to_json(F.array(F.struct("event_id"), F.struct((-F.col("event_id")).alias("event_id")))).alias("payload")).write.json(path)
        return path

    stream = s.readStream.schema("event_type string, payload string").json(G.once(s, (d, "arrays"), make))
    t = Table(s, work_path(s, "flat"))
    R.row_stream(R.flatten_payload(stream, "payload", "array<struct<event_id:bigint>>"), t, "flat", work_path(s, "ckpt"), AS_OF).awaitTermination()
    return t.read()


query("stream_flatten", W + "SELECT event_type, event_id FROM raw_events UNION ALL SELECT event_type, -event_id FROM raw_events")(_flattened)


def _consumed(s, d):
    """Two loads consumed as they appear; a third below the minimum waits for the fourth."""
    t = Table(s, work_path(s, "source"))
    e = D.raw_events(s, d)
    seen = Table(s, work_path(s, "seen"))
    ckpt = work_path(s, "ckpt")
    step = iter(range(1, 10))

    def act(fresh):
        seen.append(fresh.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("step", F.lit(next(step))), AS_OF)

    first_of_each = latest(e, ["event_type"], "event_timestamp", newest=False)
    for load in (e.where("event_type = 'click'"), e.where("event_type = 'view'"), first_of_each, e.where("event_type NOT IN ('click', 'view')")):
        t.append(load, AS_OF)
        R.on_new_data(t, "rollup", act, ckpt, min_rows=6).awaitTermination()
    return seen.read()


query("on_new_data", W + """
SELECT 'click' AS event_type, count(*)::BIGINT AS n, 1::INTEGER AS step FROM raw_events WHERE event_type = 'click'
UNION ALL SELECT 'view', count(*)::BIGINT, 2 FROM raw_events WHERE event_type = 'view'
UNION ALL SELECT event_type, count(*)::BIGINT, 3 FROM (SELECT DISTINCT event_type FROM raw_events UNION ALL SELECT event_type FROM raw_events WHERE event_type NOT IN ('click', 'view')) GROUP BY 1 """)(_consumed)


def _cdc_stream(s, d):
    def make():
        path = work_path(s, "cdc")
        cdc_documents(s, d).repartition(6).write.text(path)
        return path

    docs = s.readStream.option("maxFilesPerTrigger", 2).text(G.once(s, (d, "cdc"), make)).withColumnRenamed("value", "record_content")
    t = Table(s, work_path(s, "state"))
    empty = D.raw_customers(s, d).select(F.col("customer_id").alias("id"), "customer_name", "status", "updated_at", F.lit(False).alias("_deleted")).where("false")
    t.append(empty, AS_OF, "create")
    R.cdc_merge_stream(docs, t, "record_content", "id", ["customer_name", "status"], work_path(s, "ckpt"), AS_OF).awaitTermination()
    return cdc_live(t.read())


query("cdc_merge_stream", with_sql("raw_customers") + """
SELECT customer_id AS id, customer_name, CASE WHEN customer_id::BIGINT % 5 = 0 THEN 'UPDATED' ELSE status END AS status,
  CASE WHEN customer_id::BIGINT % 5 = 0 THEN updated_at + INTERVAL 1 HOUR ELSE updated_at END AS updated_at FROM raw_customers WHERE customer_id::BIGINT % 7 <> 0 """)(_cdc_stream)


def _late_stream(s, d):
    """Rows and their later versions in any order over several batches."""
    def make():
        path = work_path(s, "late")
        e = D.raw_events(s, d).select("event_id", "event_type", "event_timestamp", "value")
        later = e.where("event_type = 'click'").withColumn("event_timestamp", F.expr("event_timestamp + interval 1 hour")).withColumn("value", F.lit(-1.0))
        later.unionByName(e).repartition(6, F.md5(F.concat("event_id", "value"))).write.parquet(path)
        return path

    path = G.once(s, (d, "late"), make)
    stream = s.readStream.schema("event_id bigint, event_type string, event_timestamp timestamp_ntz, value double").option("maxFilesPerTrigger", 2).parquet(path)
    t = Table(s, work_path(s, "late-table"))
    R.late_merge_stream(stream, t, "event_id", "event_timestamp", work_path(s, "ckpt"), AS_OF).awaitTermination()
    return t.read()


query("late_merge_stream", W + """
SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN event_timestamp + INTERVAL 1 HOUR ELSE event_timestamp END AS event_timestamp,
  CASE WHEN event_type = 'click' THEN -1.0::DOUBLE ELSE value END AS value FROM raw_events """)(_late_stream)


# ---- latency -----------------------------------------------------------------------------------


def _arrivals(s, d):
    e = D.raw_events(s, d)
    return e.select("event_id", F.col("event_timestamp").alias("source_timestamp"), F.col("_loaded_at").alias("_inserted_at"),
                    F.concat(F.lit("ch_"), (F.col("event_id") % 4).cast("string")).alias("channel_name"))


_ARR = W + ", arr AS (SELECT event_timestamp AS source_timestamp, _loaded_at AS _inserted_at, 'ch_' || event_id % 4 AS channel_name, date_diff('second', event_timestamp, _loaded_at) AS lat FROM raw_events) "
for _unit in ("minute", "hour"):
    query(f"latency_by_{_unit}", _ARR + f"""
SELECT date_trunc('{_unit}', _inserted_at)::TIMESTAMP AS {_unit}, count(*)::BIGINT AS row_count, round(avg(lat), 6) AS avg_latency_sec, round(quantile_cont(lat, 0.95), 6) AS p95_latency_sec, max(lat) AS max_latency_sec FROM arr GROUP BY 1 """)(
        lambda s, d, u=_unit: L.latency_by(_arrivals(s, d), "source_timestamp", "_inserted_at", u))
query("latency_by_channel", _ARR + """
SELECT channel_name, count(*)::BIGINT AS rows_ingested, min(_inserted_at) AS first_insert, max(_inserted_at) AS last_insert, round(avg(lat), 6) AS avg_latency_sec, min(lat) AS min_latency_sec, max(lat) AS max_latency_sec FROM arr GROUP BY 1 """)(
    lambda s, d: L.latency_by_channel(_arrivals(s, d), "source_timestamp", "_inserted_at", "channel_name"))
query("ingest_lag", _ARR + f"""
SELECT max(source_timestamp) AS latest_source_time, max(_inserted_at) AS latest_insert_time, count(*)::BIGINT AS recent_rows, date_diff('second', max(source_timestamp), max(_inserted_at)) AS processing_lag_sec
FROM arr WHERE _inserted_at > TIMESTAMP '{AS_OF}' - INTERVAL 720 MINUTE """)(
    lambda s, d: L.ingest_lag(_arrivals(s, d), "source_timestamp", "_inserted_at", AS_OF, minutes=720))


def _latency_stream(s, d):
    """Arrivals streamed in one batch: the windows the watermark closed, compared on their counts."""
    def make():
        path = work_path(s, "arrivals")
        _arrivals(s, d).write.parquet(path)
        return path

    path = G.once(s, (d, "arrivals"), make)
    stream = s.readStream.schema("event_id bigint, source_timestamp timestamp_ntz, _inserted_at timestamp_ntz, channel_name string").parquet(path)
    out = work_path(s, "windows")
    q = L.latency_stream(stream, "source_timestamp", "_inserted_at", "0 seconds", 60).writeStream.option("checkpointLocation", work_path(s, "ckpt")).outputMode("append").format(
        "parquet").option("path", out).trigger(availableNow=True).start()
    q.awaitTermination()
    return s.read.parquet(out).select("minute", "row_count", "max_latency_sec")


query("latency_stream", _ARR + """
SELECT date_trunc('hour', _inserted_at)::TIMESTAMP AS minute, count(*)::BIGINT AS row_count, max(lat) AS max_latency_sec FROM arr GROUP BY 1
HAVING date_trunc('hour', _inserted_at)::TIMESTAMP + INTERVAL 1 HOUR <= (SELECT max(_inserted_at) FROM arr) """)(_latency_stream)
