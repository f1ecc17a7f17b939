"""Bulk loads, validation and stage reads."""

from pyspark.sql import functions as F

from ..functions.times import parse_timestamp
from ..operators import copy as C, ledger
from ..operators.versioned import Table
from ..session import work_path
from ..sources import stage as ST
from ..sources.formats import FileFormat
from . import derive as D, stages as G
from .derive import AS_OF, with_sql
from .registry import query

EVENT_SCHEMA = "event_id bigint, event_type string, event_timestamp timestamp_ntz, user_id bigint, value double, payload string"
W = with_sql("raw_events") + G.STAGED_SQL


def _reg(name, fn, body, head=W):
    query(name, head + body)(fn)


def _new_table(s, label="table") -> Table:
    return Table(s, work_path(s, label))


def _load(s, d, on_error="CONTINUE", faults=True, **kw):
    t = _new_table(s)
    report = C.copy_into(s, t, G.json_stage(s, d, faults), FileFormat.json(), kw.pop("columns", EVENT_SCHEMA), AS_OF, on_error=on_error, table_name="raw.events", **kw)
    return t, report


def _report(r):
    return r.withColumn("file", G.file_dir("file")).select("file", "status", "rows_parsed", "rows_loaded", "errors_seen", "first_error_line")


_REPORT = """
SELECT file, CASE WHEN {fail} THEN 'LOAD_FAILED' WHEN bad = 0 THEN 'LOADED' WHEN bad < parsed THEN 'PARTIALLY_LOADED' ELSE 'LOAD_FAILED' END AS status,
  parsed AS rows_parsed, CASE WHEN {fail} THEN 0 ELSE parsed - bad END::BIGINT AS rows_loaded, bad AS errors_seen, first_line AS first_error_line FROM files """
for _name, _policy, _fail in (
    ("copy_continue", "CONTINUE", "false"), ("copy_skip_file", "SKIP_FILE", "bad > 0"), ("copy_skip_file_n", "SKIP_FILE_1", "bad > 1"),
    ("copy_skip_file_pct", "SKIP_FILE_2%", "bad * 100.0 / parsed > 2"),
):
    _reg(f"{_name}_report", lambda s, d, p=_policy: _report(_load(s, d, p)[1]), _REPORT.replace("{fail}", _fail))
_reg("copy_skip_file_n_rows", lambda s, d: _load(s, d, "SKIP_FILE_1")[0].read().select("event_id", "event_type", "value"), """
SELECT event_id, event_type, value FROM staged WHERE NOT b1 AND NOT b2 AND 'd=' || d || '/batch=' || batch::VARCHAR NOT IN (SELECT file FROM files WHERE bad > 1) """)
_reg("copy_failed_only", lambda s, d: _report(_load(s, d, return_failed_only=True)[1]), _REPORT.replace("{fail}", "false") + "WHERE bad > 0")
_reg("copy_audit_rows", lambda s, d: _load(s, d, audit=True)[0].read().select(
    "event_id", "event_timestamp", "value", G.file_dir("_source_file").alias("source_file"), "_source_row", "_loaded_at"), f"""
SELECT event_id, event_timestamp, value, 'd=' || d || '/batch=' || batch::VARCHAR AS source_file, line AS _source_row, TIMESTAMP '{AS_OF}' AS _loaded_at
FROM staged WHERE NOT b1 AND NOT b2 """)


def _abort(s, d):
    """ABORT on faulty files commits nothing; on clean files everything."""
    t = _new_table(s)
    try:
        C.copy_into(s, t, G.json_stage(s, d), FileFormat.json(), EVENT_SCHEMA, AS_OF)
        outcome = "loaded"
    except C.LoadAborted:
        outcome = "aborted"
    before = 0 if t.current() is None else t.read().count()
    C.copy_into(s, t, G.json_stage(s, d, False), FileFormat.json(), EVENT_SCHEMA, AS_OF)
    return t.read().agg(F.lit(outcome).alias("faulty_files"), F.lit(before).cast("bigint").alias("rows_after_abort"), F.count(F.lit(1)).alias("rows_after_clean"))


_reg("copy_abort", _abort, """
SELECT CASE WHEN sum(bad) > 0 THEN 'aborted' ELSE 'loaded' END AS faulty_files, 0::BIGINT AS rows_after_abort, sum(parsed)::BIGINT AS rows_after_clean FROM files """)


def _twice(s, d, **second):
    t = _new_table(s)
    stage = G.json_stage(s, d)
    for kw in ({}, second):
        C.copy_into(s, t, stage, FileFormat.json(), EVENT_SCHEMA, kw.pop("as_of", AS_OF), on_error="CONTINUE", **kw)
    return t.read().agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("event_id").alias("ids"))


_COUNT = "SELECT (count(*) * {n})::BIGINT AS row_count, count(DISTINCT event_id)::BIGINT AS ids FROM staged WHERE NOT b1 AND NOT b2 "
_reg("copy_tracked", lambda s, d: _twice(s, d), _COUNT.replace("{n}", "1"))
_reg("copy_forced", lambda s, d: _twice(s, d, force=True), _COUNT.replace("{n}", "2"))
_reg("copy_tracking_expired", lambda s, d: _twice(s, d, as_of="2024-04-05 00:00:00"), _COUNT.replace("{n}", "2"))
_reg("copy_pattern", lambda s, d: _load(s, d, pattern=r"d=2024-01-1[0-9]/.*")[0].read().select("event_id"), """
SELECT event_id FROM staged WHERE NOT b1 AND NOT b2 AND d BETWEEN '2024-01-10' AND '2024-01-19' """)
_reg("copy_prefix", lambda s, d: _load(s, d, prefix="d=2024-01-15/")[0].read().select("event_id"), """
SELECT event_id FROM staged WHERE NOT b1 AND NOT b2 AND d = '2024-01-15' """)
_reg("copy_chunks", lambda s, d: C.copy_chunks(
    s, _new_table(s), G.json_stage(s, d), FileFormat.json(), EVENT_SCHEMA, AS_OF, ["d=2024-01-0.*", "d=2024-01-1.*", "d=2024-01-[23].*"], on_error="CONTINUE"
).groupBy("pattern").agg(F.count(F.lit(1)).alias("files"), F.sum("rows_loaded").alias("rows_loaded")), """
SELECT CASE substr(file, 11, 1) WHEN '0' THEN 'd=2024-01-0.*' WHEN '1' THEN 'd=2024-01-1.*' ELSE 'd=2024-01-[23].*' END AS pattern, count(*)::BIGINT AS files,
  sum(parsed - bad)::BIGINT AS rows_loaded FROM files GROUP BY 1 """)
_reg("copy_transform", lambda s, d: _load(
    s, d, select=[F.col("event_id").cast("string"), F.upper("event_type"), F.get_json_object("payload", "$.k").cast("int"), F.round("value", 0)],
    where=(F.col("value") > 10) & F.col("event_id").isNotNull(), target_columns=["id", "kind", "k", "rounded"])[0].read().select("id", "kind", "k"), """
SELECT event_id::VARCHAR AS id, upper(event_type) AS kind, json_extract_string(props, '$.k')::INTEGER AS k FROM staged WHERE NOT b1 AND NOT b2 AND value > 10 """)
_reg("copy_distinct", lambda s, d: _load(s, d, select=[F.col("user_id"), F.col("event_type")], distinct=True)[0].read(), """
SELECT DISTINCT user_id, event_type FROM staged WHERE NOT b1 AND NOT b2 """)
_reg("copy_raw_record", lambda s, d: _load(s, d, columns=C.Columns(EVENT_SCHEMA, raw_column="raw_data"))[0].read().select(
    "event_id", F.expr("variant_get(raw_data, '$.payload.k', 'int')").alias("k"), F.expr("raw_data:event_type::string").alias("kind")), """
SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k, event_type AS kind FROM staged WHERE NOT b1 AND NOT b2 """)
_reg("copy_case_insensitive", lambda s, d: _load(s, d, columns=C.Columns(
    "EVENT_ID bigint, Event_Type string, VALUE double", match="CASE_INSENSITIVE"))[0].read(), """
SELECT event_id AS "EVENT_ID", event_type AS "Event_Type", value AS "VALUE" FROM staged WHERE NOT b1 AND NOT b2 """)
_reg("copy_length_errors", lambda s, d: _load(s, d, columns=C.Columns(EVENT_SCHEMA, lengths={"event_type": 6}))[0].read().groupBy("event_type").count()
     .withColumnRenamed("count", "n"), """
SELECT event_type, count(*)::BIGINT AS n FROM staged WHERE NOT b1 AND NOT b2 AND length(event_type) <= 6 GROUP BY 1 """)
_reg("copy_truncate_columns", lambda s, d: _load(s, d, columns=C.Columns(EVENT_SCHEMA, lengths={"event_type": 4}, truncate=True))[0].read()
     .groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), """
SELECT substr(event_type, 1, 4) AS event_type, count(*)::BIGINT AS n FROM staged WHERE NOT b1 AND NOT b2 GROUP BY 1 """)
_reg("copy_load_history", lambda s, d: ledger.history(_load(s, d)[0]).groupBy("table_name", "status").agg(
    F.count(F.lit(1)).alias("files"), F.sum("row_parsed").alias("row_parsed"), F.sum("row_count").alias("row_count")), """
SELECT 'raw.events' AS table_name, CASE WHEN bad = 0 THEN 'LOADED' ELSE 'PARTIALLY_LOADED' END AS status, count(*)::BIGINT AS files, sum(parsed)::BIGINT AS row_parsed,
  sum(parsed - bad)::BIGINT AS row_count FROM files GROUP BY 2 """)
_reg("reload_staging", lambda s, d: _restaged(s, d), _COUNT.replace("{n}", "1"))


def _restaged(s, d):
    t, _ = _load(s, d)
    C.reload_staging(s, t, G.json_stage(s, d), FileFormat.json(), EVENT_SCHEMA, AS_OF, on_error="CONTINUE")
    return t.read().agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("event_id").alias("ids"))


# ---- validation --------------------------------------------------------------------------


def _validate(s, d, mode):
    return C.validate(s, G.json_stage(s, d), FileFormat.json(), EVENT_SCHEMA, mode).withColumn("file", G.file_dir("file"))


_ERR = """
SELECT CASE WHEN b2 THEN 'Record: cannot be parsed' ELSE 'Numeric value: not recognized' END AS error, 'd=' || d || '/batch=' || batch::VARCHAR AS file, line,
  CASE WHEN b2 THEN NULL ELSE 'value' END AS column_name FROM staged WHERE (b1 OR b2) """
_reg("validate_all_errors", lambda s, d: _validate(s, d, "RETURN_ALL_ERRORS").select("error", "file", "line", "column_name"), _ERR)
_reg("validate_first_errors", lambda s, d: _validate(s, d, "RETURN_ERRORS").select("error", "file", "line", "column_name"), _ERR +
     "QUALIFY row_number() OVER (PARTITION BY d, batch ORDER BY line) = 1")
_reg("error_summary", lambda s, d: C.error_summary(_validate(s, d, "RETURN_ALL_ERRORS")).select("error", "file", "line", "column_name", "occurrence_count"),
     _ERR.replace("AS column_name FROM", "AS column_name, 1::BIGINT AS occurrence_count FROM"))


def _some_rows(s, d):
    """Ten rows are asked for: how many came, and how many of them are rows of the source."""
    some = C.validate(s, G.json_stage(s, d), FileFormat.json(), EVENT_SCHEMA, "RETURN_10_ROWS")
    known = D.table(s, d, "events").select("event_id", "event_type", F.lit(True).alias("known"))
    return some.join(known, ["event_id", "event_type"], "left").agg(F.count(F.lit(1)).alias("n"), F.count("known").alias("known"))


query("validate_n_rows", "SELECT least(10, count(*))::BIGINT AS n, least(10, count(*))::BIGINT AS known FROM events")(_some_rows)

# ---- other formats -----------------------------------------------------------------------
ORDER_SCHEMA = "order_id bigint, customer_id bigint, status string, order_total double, order_date date"


def _csv(s, d, **kw):
    t = _new_table(s)
    fmt = FileFormat.csv(delimiter="|", skip_header=1, null_if=("NULL",), date_format="DD/MM/YYYY")
    return t, C.copy_into(s, t, G.csv_stage(s, d), fmt, ORDER_SCHEMA, AS_OF, on_error="CONTINUE", **kw)


_reg("copy_csv_rows", lambda s, d: _csv(s, d)[0].read(), """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderstatus END AS status, o_totalprice AS order_total,
  o_orderdate::DATE AS order_date FROM orders WHERE o_orderkey % 97 <> 0 """, head="")
_reg("copy_csv_report", lambda s, d: _report(_csv(s, d)[1]).drop("first_error_line"), """
SELECT 'y=' || year(o_orderdate)::VARCHAR AS file, CASE WHEN count(*) FILTER (o_orderkey % 97 = 0) = 0 THEN 'LOADED' ELSE 'PARTIALLY_LOADED' END AS status,
  count(*)::BIGINT AS rows_parsed, count(*) FILTER (o_orderkey % 97 <> 0)::BIGINT AS rows_loaded, count(*) FILTER (o_orderkey % 97 = 0)::BIGINT AS errors_seen
FROM orders GROUP BY 1 """, head="")
for _kind in ("parquet", "orc"):
    _reg(f"copy_{_kind}", lambda s, d, k=_kind: _columnar(s, d, k), """
SELECT o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus, o_totalprice FROM orders """, head="")


def _columnar(s, d, kind):
    t = _new_table(s)
    schema = "o_orderkey bigint, o_custkey string, o_orderstatus string, o_totalprice double"
    C.copy_into(s, t, G.parquet_stage(s, d, "orders", kind), FileFormat(kind), schema, AS_OF)
    return t.read()


_reg("load_batch", lambda s, d: C.load_batch(s, {
    "raw.events": dict(table=_new_table(s), stage=G.json_stage(s, d), fmt=FileFormat.json(), columns=EVENT_SCHEMA, on_error="CONTINUE"),
    "raw.orders": dict(table=_new_table(s), stage=G.parquet_stage(s, d), fmt=FileFormat.parquet(), columns=D.table(s, d, "orders").schema, on_error="SKIP_FILE"),
}, AS_OF).drop("files"), """
SELECT 'raw.events' AS table_name, sum(parsed)::BIGINT AS rows_parsed, sum(parsed - bad)::BIGINT AS rows_loaded, round(sum(bad)::DOUBLE * 100.0::DOUBLE / sum(parsed)::DOUBLE, 2) AS skip_pct,
  CASE WHEN sum(bad) * 100.0 / sum(parsed) > 5 THEN 'FAIL' ELSE 'PASS' END AS status FROM files
UNION ALL SELECT 'raw.orders', count(*)::BIGINT, count(*)::BIGINT, 0.0::DOUBLE, 'PASS' FROM orders """)

# ---- staged reads ------------------------------------------------------------------------


def _listed(s, d):
    """Every file of the stage, its size against the bytes of its lines, and whether its time is known."""
    stage = G.json_stage(s, d)
    read = s.read.text(stage, recursiveFileLookup=True).groupBy(ST.file_name(stage).alias("name")).agg(F.sum(F.octet_length("value") + 1).alias("bytes"))
    listing = ST.list_stage(s, stage)
    return listing.join(read, "name").select(G.file_dir("name").alias("file"), (F.col("size") == F.col("bytes")).alias("size_right"), F.col("last_modified").isNotNull().alias("has_time"))


_reg("list_stage", _listed, "SELECT file, true AS size_right, true AS has_time FROM files")
_reg("stage_file_count", lambda s, d: ST.list_stage(s, G.json_stage(s, d)).select(G.file_dir("name").alias("file")), "SELECT file FROM files")
_reg("stage_size_limit", lambda s, d: ST.select_files(
    ST.list_stage(s, G.json_stage(s, d)), size_limit=1).agg(F.count(F.lit(1)).alias("files")), "SELECT 1::BIGINT AS files", head="")
_reg("stage_variant", lambda s, d: ST.stage_variant(s, G.json_stage(s, d), G.json_stage(s, d)).groupBy(G.file_dir("file_name").alias("file")).agg(
    F.count(F.lit(1)).alias("records"), F.count("v").alias("parsed"), F.sum(F.expr("try_variant_get(v, '$.payload.k', 'bigint')")).alias("k")), """
SELECT 'd=' || d || '/batch=' || batch::VARCHAR AS file, count(*)::BIGINT AS records, count(*) FILTER (NOT b2)::BIGINT AS parsed,
  sum(CASE WHEN NOT b2 THEN json_extract_string(props, '$.k')::BIGINT END)::BIGINT AS k FROM staged GROUP BY 1 """)
_reg("stage_positional", lambda s, d: ST.stage_positional(s, G.csv_stage(s, d), G.csv_stage(s, d), 5, FileFormat.csv(delimiter="|", skip_header=1)).select(
    "c1", "c2", "c4", G.file_dir("file_name").alias("file")), """
SELECT o_orderkey::VARCHAR AS c1, o_custkey::VARCHAR AS c2, CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE o_totalprice::VARCHAR END AS c4,
  'y=' || year(o_orderdate)::VARCHAR AS file FROM orders """, head="")
_reg("stage_line_numbers", lambda s, d: ST.numbered_lines(s, G.json_stage(s, d), G.json_stage(s, d)).select(
    G.file_dir("file_name").alias("file"), "line_number", F.md5("line").alias("_h")).drop("_h"), """
SELECT 'd=' || d || '/batch=' || batch::VARCHAR AS file, line AS line_number FROM staged """)
_reg("rows_per_file", lambda s, d: ST.with_file_metadata(ST.read_stage(
    s, G.json_stage(s, d), FileFormat.json(), "event_id bigint, event_type string"), G.json_stage(s, d))
    .groupBy(G.file_dir("metadata_filename").alias("file")).agg(F.count(F.lit(1)).alias("row_count")), "SELECT file, parsed AS row_count FROM files")
_reg("wildcard_read", lambda s, d: ST.read_stage(
    s, G.json_stage(s, d, False) + "/d=2024-01-2*/*/*", FileFormat.json(), "event_id bigint, event_type string"), """
SELECT event_id, event_type FROM staged WHERE d BETWEEN '2024-01-20' AND '2024-01-29' """)


def _manifest(s, d):
    """A manifest written for the staged files and read back."""
    def make():
        path = work_path(s, "manifest")
        stage = G.json_stage(s, d)
        ST.file_checksums(s, stage, stage).select(G.file_dir("file_name").alias("file_name"), "row_count", "checksum").coalesce(1).write.json(path)
        return path

    return ST.read_manifest(s, G.once(s, (d, "manifest"), make)).select("file_name", "expected_rows", (F.length("expected_checksum") == 32).alias("has_checksum"))


_reg("read_manifest", _manifest, "SELECT file AS file_name, parsed AS expected_rows, true AS has_checksum FROM files")


def _copied_twice(s, d):
    """The stage beside an identical copy of its files of one batch."""
    from ..session import work_path as wp

    src = G.json_stage(s, d)
    both = G.once(s, (d, "twice"), lambda: wp(s, "stage-twice"))
    from ..sources import fs

    if not fs.exists(s, both):
        lines = G.event_lines(s, d)
        G._by_day(lines).text(both)
        G._by_day(lines.where("batch = '1'").withColumn("batch", F.lit("1-again"))).mode("append").text(both)
    return both


_reg("duplicate_content", lambda s, d: ST.duplicate_content(ST.file_checksums(s, _copied_twice(s, d), _copied_twice(s, d))).select(
    G.file_dir("file_name").alias("file"), "row_count", "file_count"), """
SELECT file, parsed AS row_count, 2::BIGINT AS file_count FROM files WHERE file LIKE '%batch=1'
UNION ALL SELECT file || '-again', parsed, 2::BIGINT FROM files WHERE file LIKE '%batch=1' """)


def _manifest_check(s, d):
    """Sums of the clean stage as the manifest, sums of the faulty stage as what arrived."""
    good, got = G.json_stage(s, d, False), G.json_stage(s, d)
    manifest = ST.file_checksums(s, good, good).select(
        G.file_dir("file_name").alias("file_name"), F.col("row_count").alias("expected_rows"), F.col("checksum").alias("expected_checksum"))
    arrived = ST.file_checksums(s, got, got).withColumn("file_name", G.file_dir("file_name"))
    return ST.file_checksum_check(arrived, manifest).select("file_name", "expected_rows", "actual_rows", "status")


_reg("file_checksum", _manifest_check, """
SELECT file AS file_name, parsed AS expected_rows, parsed AS actual_rows, CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL - Checksum mismatch' END AS status FROM files """)


def _mixed_dates(s, d):
    """Order dates written in three formats, every tenth unreadable, read back."""
    o = D.table(s, d, "orders")
    k, ts = F.col("o_orderkey"), F.col("o_orderdate")
    text = (F.when(k % 10 == 9, "not a date").when(k % 3 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .when(k % 3 == 1, F.date_format(ts, "MM/dd/yyyy")).otherwise(F.upper(F.date_format(ts, "dd-MMM-yyyy"))))
    return o.select("o_orderkey", parse_timestamp(text, "YYYY-MM-DD HH24:MI:SS", "MM/DD/YYYY", "DD-MON-YYYY").alias("parsed_timestamp"))


_reg("mixed_dates", _mixed_dates, """
SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 9 THEN NULL ELSE o_orderdate END AS parsed_timestamp FROM orders """, head="")
