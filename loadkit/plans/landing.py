"""Loads, pipes and stages whose files are made for the purpose: arrays, fixed sizes, purges, pauses."""

from pyspark.sql import functions as F

from ..operators import copy as C
from ..operators.versioned import Table
from ..session import work_path
from ..sources import stage as ST
from ..sources.formats import FileFormat
from ..streaming import latency as L
from ..streaming.pipe import Pipe, if_new_files
from . import derive as D, stages as G
from .copying import EVENT_SCHEMA, W
from .derive import AS_OF, with_sql
from .registry import query
from .streams import _ARR, _arrivals

SHORT = "event_id bigint, event_type string, value double"


def _table(s) -> Table:
    return Table(s, work_path(s, "table"))


def _counted(t: Table) -> int:
    return 0 if t.current() is None else t.read().count()


# ---- stages ---------------------------------------------------------------------------------
#: Events of a file's array, about.
_ARRAY = 50_000


def array_stage(s, d, most: int = _ARRAY) -> str:
    """One JSON array of events for each day, batch and part of about `most` events, over several lines."""
    def make():
        path = work_path(s, "stage-arrays")
        e = D.raw_events(s, d).select(F.date_format("event_timestamp", "yyyy-MM-dd").alias("d"), (F.col("event_id") % 4).alias("batch"), F.struct("event_id", "event_type", "value").alias("e"))
        parts = e.groupBy("d", "batch").agg(F.ceil(F.count(F.lit(1)) / most).alias("parts"))
        e = e.join(parts, ["d", "batch"]).withColumn("part", F.pmod(F.xxhash64("e.event_id", "e.event_type", "e.value"), "parts"))
        arrays = e.groupBy("d", "batch", "part").agg(F.regexp_replace(F.to_json(F.collect_list("e")), r"\},\{", "},\n{").alias("value"))
        arrays.write.partitionBy("d", "batch", "part").text(path)
        return path

    return G.once(s, (d, "arrays", most), make)


def _arrays(s, d):
    t = _table(s)
    C.copy_into(s, t, array_stage(s, d), FileFormat.json(strip_outer_array=True), SHORT, AS_OF)
    return t.read()


query("copy_json_arrays", with_sql("raw_events") + "SELECT event_id, event_type, value FROM raw_events ")(_arrays)

#: Rows of a file and bytes of a row (with its line end) in the stage of equal files.
_ROWS, _BYTES = 100, 21


def _size_limit(s, d):
    """Files of equal size under limits: names are taken while the bytes before them are below the limit."""
    def make():
        path = work_path(s, "stage-equal")
        k = D.table(s, d, "customer").select(F.lpad(F.col("c_custkey").cast("string"), _BYTES - 1, "0").alias("value"), F.floor(F.col("c_custkey") / _ROWS).alias("part"))
        k = k.join(k.groupBy("part").count().where(f"count = {_ROWS}").select("part"), "part", "left_semi")
        k.repartition("part").write.partitionBy("part").text(path)
        return path

    listing = ST.list_stage(s, G.once(s, (d, "equal"), make))
    out = None
    for limit in (1, _ROWS * _BYTES, 3 * _ROWS * _BYTES + 1):
        one = ST.select_files(listing, size_limit=limit).agg(F.lit(limit).cast("bigint").alias("size_limit"), F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))
        out = one if out is None else out.unionByName(one)
    return out


query("stage_size_limits", f"""
WITH f AS (SELECT c_custkey // {_ROWS} AS part, count(*) * {_BYTES} AS size FROM customer GROUP BY 1 HAVING count(*) = {_ROWS})
, l AS (SELECT unnest([1, {_ROWS * _BYTES}, {3 * _ROWS * _BYTES + 1}])::BIGINT AS size_limit)
SELECT size_limit, least(ceil(size_limit / {_ROWS * _BYTES}.0), (SELECT count(*) FROM f))::BIGINT AS files,
  (least(ceil(size_limit / {_ROWS * _BYTES}.0), (SELECT count(*) FROM f)) * {_ROWS * _BYTES})::BIGINT AS bytes FROM l """)(_size_limit)


def _named(s, d):
    t = _table(s)
    C.copy_into(s, t, G.json_stage(s, d), FileFormat.named("json_format"), SHORT, AS_OF, on_error="CONTINUE")
    return t.read()


query("copy_named_format", W + "SELECT event_id, event_type, value FROM staged WHERE NOT b1 AND NOT b2 ")(_named)


# ---- loads ----------------------------------------------------------------------------------
def _purged(s, d):
    """What a load with PURGE leaves in its stage: files with errors."""
    path = work_path(s, "stage-purge")
    G._by_day(G.event_lines(s, d)).text(path)
    C.copy_into(s, _table(s), path, FileFormat.json(), EVENT_SCHEMA, AS_OF, on_error="CONTINUE", purge=True)
    return ST.list_stage(s, path).select(G.file_dir("name").alias("file"))


query("copy_purge", W + "SELECT file FROM files WHERE bad > 0 ")(_purged)


def _uncertain(s, d):
    """Files older than the history's window: left out, unless uncertain ones are asked for."""
    t, rows = _table(s), []
    for flag in (False, True):
        C.copy_into(s, t, G.json_stage(s, d), FileFormat.json(), EVENT_SCHEMA, "2999-01-01 00:00:00", on_error="CONTINUE", load_uncertain=flag)
        rows.append((flag, _counted(t)))
    return s.createDataFrame(rows, "load_uncertain boolean, row_count bigint")


query("copy_uncertain_files", W + """
SELECT false AS load_uncertain, 0::BIGINT AS row_count UNION ALL SELECT true, count(*)::BIGINT FROM staged WHERE NOT b1 AND NOT b2 """)(_uncertain)


def _environments(s, d):
    """Rows that get in under the policy of each environment."""
    rows = []
    for env in ("dev", "staging", "prod"):
        t = _table(s)
        try:
            C.copy_into(s, t, G.json_stage(s, d), FileFormat.json(), EVENT_SCHEMA, AS_OF, on_error=C.policy_for(env))
        except C.LoadAborted:
            pass
        rows.append((env, _counted(t)))
    return s.createDataFrame(rows, "environment string, row_count bigint")


query("copy_by_environment", W + """
SELECT 'dev' AS environment, CASE WHEN sum(bad) > 0 THEN 0 ELSE sum(parsed) END::BIGINT AS row_count FROM files
UNION ALL SELECT 'staging', coalesce(sum(parsed - bad) FILTER (bad <= 10), 0)::BIGINT FROM files
UNION ALL SELECT 'prod', sum(parsed - bad)::BIGINT FROM files """)(_environments)


def _as_select(s, d):
    """A table made from a query over another table's version."""
    t, made = _table(s), _table(s)
    t.append(D.raw_events(s, d), AS_OF)
    made.append(t.read().groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_timestamp").alias("last_event")), AS_OF, "create as select")
    t.truncate(AS_OF)
    return made.read()


query("create_as_select", with_sql("raw_events") + "SELECT event_type, count(*)::BIGINT AS n, max(event_timestamp) AS last_event FROM raw_events GROUP BY 1 ")(_as_select)
query("copy_transform_all", W + """
SELECT event_id::VARCHAR AS id, upper(event_type) AS kind, CASE WHEN abs(value) - floor(abs(value)) = 0.5 THEN sign(value) * ceil(abs(value)) ELSE round(value) END AS rounded FROM staged WHERE NOT b1 AND NOT b2 AND value > 10 """)(
    lambda s, d: _transformed(s, d))


def _transformed(s, d):
    t = _table(s)
    C.copy_into(s, t, G.json_stage(s, d), FileFormat.json(), EVENT_SCHEMA, AS_OF, on_error="CONTINUE", where=F.col("value") > 10,
                select=[F.col("event_id").cast("string"), F.upper("event_type"), F.round("value", 0)], target_columns=["id", "kind", "rounded"])
    return t.read()


query("join_anti_rows", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")(
    lambda s, d: D.table(s, d, "customer").select("c_custkey").join(
        D.table(s, d, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti"))


# ---- pipes ----------------------------------------------------------------------------------
def _events_of(s, d, stage, where):
    G._by_day(G.event_lines(s, d).where(where)).mode("append").text(stage)


def _pipe(s, stage, t) -> Pipe:
    return Pipe(s, "events_pipe", stage, FileFormat.json(), EVENT_SCHEMA, t, work_path(s, "ckpt"), as_of=AS_OF)


def _paused(s, d):
    """Rows in the table while the pipe runs, is paused as files arrive, and runs again."""
    t, stage, rows = _table(s), work_path(s, "stage-pipe"), []
    _events_of(s, d, stage, "d < '2024-01-11'")
    p = _pipe(s, stage, t)

    def note(step):
        rows.append((step, p.state(), _counted(t)))

    p.start(1).processAllAvailable()
    note("running")
    p.pause()
    _events_of(s, d, stage, "d >= '2024-01-11'")
    note("paused")
    p.resume(1).processAllAvailable()
    note("resumed")
    p.pause()
    return s.createDataFrame(rows, "step string, state string, row_count bigint")


query("pipe_paused", W + """
, n AS (SELECT count(*) FILTER (d < '2024-01-11')::BIGINT AS a, count(*)::BIGINT AS b FROM staged WHERE NOT b1 AND NOT b2)
SELECT 'running' AS step, 'RUNNING' AS state, a AS row_count FROM n UNION ALL SELECT 'paused', 'PAUSED', a FROM n UNION ALL SELECT 'resumed', 'RUNNING', b FROM n """)(_paused)


def _inserted(s, d):
    """Files loaded by name; a refresh then takes the others only."""
    t, stage, rows = _table(s), G.json_stage(s, d), []
    p = _pipe(s, stage, t)
    names = [r["name"] for r in ST.list_stage(s, stage, "d=2024-01-15/").select("name").collect()]
    p.insert_files(names)
    rows.append(("by name", _counted(t), if_new_files(s, stage, t, lambda: True) is True))
    p.refresh()
    rows.append(("refreshed", _counted(t), if_new_files(s, stage, t, lambda: True) is True))
    return s.createDataFrame(rows, "step string, row_count bigint, new_files boolean")


query("pipe_insert_files", W + """
, n AS (SELECT count(*) FILTER (d = '2024-01-15')::BIGINT AS a, count(*)::BIGINT AS b FROM staged WHERE NOT b1 AND NOT b2)
SELECT 'by name' AS step, a AS row_count, true AS new_files FROM n UNION ALL SELECT 'refreshed', b, false FROM n """)(_inserted)


def _names(s, d):
    """Two stages whose files have equal names, into one table; then one file is rewritten."""
    t = _table(s)
    for half in (0, 1):
        stage = work_path(s, f"stage-half{half}")
        e = D.raw_events(s, d).where(F.col("event_id") % 2 == half).select("event_id", "event_type", "value")
        _put(s, stage, "a.json", e.where("event_id % 3 = 0"))
        _put(s, stage, "b.json", e.where("event_id % 3 > 0"))
        p = Pipe(s, "p", stage, FileFormat.json(), SHORT, t, work_path(s, "ckpt"), as_of=AS_OF)
        p.refresh()
    _put(s, stage, "a.json", e.where("event_id % 3 = 0 AND value > 50"))
    p.refresh()
    p.refresh()
    return t.read().groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


def _put(s, stage, name, rows):
    """One file of a chosen name."""
    from ..sources import fs

    made = work_path(s, "one")
    rows.coalesce(1).write.json(made)
    (part,) = [c for c in fs.children(s, made) if c.startswith("part-")]
    target = f"{stage}/{name}"
    if fs.exists(s, target):
        fs.delete(s, target)
    fs.rename(s, f"{made}/{part}", target)
    fs.delete(s, made)


query("pipe_names_and_rewrites", with_sql("raw_events") + """
SELECT event_type, count(*)::BIGINT AS n, sum(event_id)::BIGINT AS ids FROM (
  SELECT event_type, event_id FROM raw_events UNION ALL SELECT event_type, event_id FROM raw_events WHERE event_id % 2 = 1 AND event_id % 3 = 0 AND value > 50) GROUP BY 1 """)(_names)


# ---- latency --------------------------------------------------------------------------------
def _latency_all(s, d):
    """Every window with all its measures: an arrival two hours after the last one closes the last window."""
    def make():
        path = work_path(s, "arrivals-closed")
        arrivals = _arrivals(s, d)
        arrivals.write.parquet(path)
        last = arrivals.agg(F.max("_inserted_at").alias("m"))
        closing = last.select(F.lit(-1).cast("bigint").alias("event_id"), F.col("m").alias("source_timestamp"), (F.col("m") + F.expr("interval 2 hours")).alias("_inserted_at"), F.lit("closing").alias("channel_name"))
        closing.write.mode("append").parquet(path)
        return path

    path = G.once(s, (d, "arrivals-closed"), make)
    stream = s.readStream.schema("event_id bigint, source_timestamp timestamp_ntz, _inserted_at timestamp_ntz, channel_name string").parquet(path)
    out = work_path(s, "windows")
    L.latency_stream(stream, "source_timestamp", "_inserted_at", "0 seconds", 60).writeStream.option("checkpointLocation", work_path(s, "ckpt")).outputMode("append").format(
        "parquet").option("path", out).trigger(availableNow=True).start().awaitTermination()
    return s.read.parquet(out).withColumn("avg_latency_sec", F.round("avg_latency_sec", 6))


query("latency_stream_all", _ARR + """
SELECT date_trunc('hour', _inserted_at)::TIMESTAMP AS minute, count(*)::BIGINT AS row_count, round(avg(lat), 6) AS avg_latency_sec, quantile_disc(lat, 0.95) AS p95_latency_sec, max(lat) AS max_latency_sec FROM arr GROUP BY 1 """)(_latency_all)
