"""Schema inference, drift and JSON shapes."""

from pyspark.sql import functions as F, types as T

from ..operators import schema as O
from ..operators.versioned import Table
from ..session import work_path
from ..sources.formats import FileFormat
from . import derive as D, stages as G
from .derive import AS_OF, table
from .registry import query

S = f"TIMESTAMP '{AS_OF}'"
# Spark names of the types DuckDB reports for the given tables.
_TYPES = "CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END"


def _columns(name):
    return f"(SELECT column_name, {_TYPES} AS data_type, ordinal_position::INTEGER AS ordinal_position FROM information_schema.columns WHERE table_name = '{name}')"


def _versions(s, d):
    """The orders schema and a changed one: a column dropped, one added, one retyped, one renamed in case."""
    old = table(s, d, "orders")
    new = old.drop("o_orderpriority").withColumn("o_totalprice", F.col("o_totalprice").cast("string")).withColumn(
        "o_channel", F.lit("web")).withColumnRenamed("o_custkey", "O_CUSTKEY")
    return O.schema_frame(s, new.schema), O.schema_frame(s, old.schema)


_DIFF = f"""
WITH t AS {_columns('orders')},
s AS (SELECT CASE column_name WHEN 'o_custkey' THEN 'O_CUSTKEY' ELSE column_name END AS column_name, CASE column_name WHEN 'o_totalprice' THEN 'string' ELSE data_type END AS data_type FROM t WHERE column_name <> 'o_orderpriority'
  UNION ALL SELECT 'o_channel', 'string'),
diff AS (SELECT coalesce(upper(s.column_name), upper(t.column_name)) AS column_name, s.data_type AS source_type, t.data_type AS target_type,
  CASE WHEN s.column_name IS NULL THEN 'REMOVED - Column no longer in source' WHEN t.column_name IS NULL THEN 'NEW - Column added to source' WHEN s.data_type <> t.data_type THEN 'TYPE_CHANGE' ELSE 'OK' END AS drift_status
  FROM s FULL JOIN t ON upper(s.column_name) = upper(t.column_name)) """


def _no_flags(df):
    """Nullability is compared after both sides are read from files, where all columns are nullable."""
    return df.withColumn("nullable", F.lit(True))


def _pair(s, d):
    a, b = _versions(s, d)
    return _no_flags(a), _no_flags(b)


query("infer_schema", f"""
SELECT column_name AS "COLUMN_NAME", data_type AS "TYPE", true AS "NULLABLE", '$1:' || column_name || '::' || upper(data_type) AS "EXPRESSION", ordinal_position - 1 AS "ORDER_ID" FROM {_columns('orders')} """)(
    lambda s, d: O.infer_schema(s, G.parquet_stage(s, d), FileFormat.parquet()).drop("FILENAMES"))
query("infer_schema_json", """
SELECT * FROM (VALUES ('event_id', 'string'), ('event_timestamp', 'string'), ('event_type', 'string'), ('payload', 'struct<k:bigint>'), ('user_id', 'bigint'), ('value', 'double')) v("COLUMN_NAME", "TYPE")
WHERE "COLUMN_NAME" <> 'event_id' UNION ALL SELECT 'event_id', 'bigint' """)(
    lambda s, d: O.infer_schema(s, G.json_stage(s, d, False), FileFormat.json()).where("COLUMN_NAME not in ('d', 'batch')").select("COLUMN_NAME", "TYPE"))
query("schema_template", f"SELECT count(*)::BIGINT AS n FROM {_columns('orders')}")(
    lambda s, d: O.template(O.infer_schema(s, G.parquet_stage(s, d), FileFormat.parquet())).select(F.size("columns").cast("bigint").alias("n")))
query("schema_diff", _DIFF + "SELECT * FROM diff")(lambda s, d: O.schema_diff(*_pair(s, d)).drop("source_nullable", "target_nullable"))
query("new_columns", "SELECT 'o_channel' AS column_name, 'string' AS data_type")(lambda s, d: O.new_columns(*_pair(s, d)))
for _allow in (False, True):
    query("validate_schema" + ("_allow_new" if _allow else ""), _DIFF + """
SELECT count(*) FILTER (drift_status LIKE 'REMOVED%' OR drift_status = 'TYPE_CHANGE')::BIGINT AS breaking, count(*) FILTER (drift_status LIKE 'NEW%')::BIGINT AS added,
  'FAIL: ' || count(*) FILTER (drift_status LIKE 'REMOVED%' OR drift_status = 'TYPE_CHANGE') || ' breaking schema changes detected' AS result FROM diff """)(
        lambda s, d, a=_allow: O.validate_schema(*_pair(s, d), allow_new=a))
query("log_drift", _DIFF + f"""
SELECT {S} AS detected_at, 'stage/orders' AS source_location, 'raw.orders' AS target_table, column_name,
  CASE WHEN drift_status LIKE 'REMOVED%' THEN 'REMOVED' WHEN drift_status LIKE 'NEW%' THEN 'NEW' ELSE 'TYPE_CHANGED' END AS change_type, target_type AS old_value, source_type AS new_value
FROM diff WHERE drift_status <> 'OK' """)(lambda s, d: O.log_drift(*_pair(s, d), "stage/orders", "raw.orders", AS_OF).drop("drift_id", "action_taken", "resolved_at"))


def _snapshots(s, d):
    new, old = _pair(s, d)
    first = O.schema_snapshot(old, "stage/orders", "2024-01-01 00:00:00")
    return first.unionByName(O.schema_snapshot(old, "stage/orders", "2024-01-02 00:00:00")).unionByName(O.schema_snapshot(new, "stage/orders", "2024-01-03 00:00:00"))


query("schema_snapshot_diff", f"""
WITH t AS {_columns('orders')},
s AS (SELECT CASE column_name WHEN 'o_custkey' THEN 'O_CUSTKEY' ELSE column_name END AS column_name, CASE column_name WHEN 'o_totalprice' THEN 'string' ELSE data_type END AS data_type FROM t WHERE column_name <> 'o_orderpriority'
  UNION ALL SELECT 'o_channel', 'string')
SELECT coalesce(s.column_name, t.column_name) AS column_name, t.data_type AS previous_type, s.data_type AS current_type,
  CASE WHEN t.column_name IS NULL THEN 'NEW' WHEN s.column_name IS NULL THEN 'REMOVED' ELSE 'TYPE_CHANGED' END AS change_type
FROM s FULL JOIN t ON s.column_name = t.column_name WHERE s.column_name IS NULL OR t.column_name IS NULL OR s.data_type <> t.data_type """)(
    lambda s, d: O.snapshot_diff(_snapshots(s, d)))


def _evolved(s, d):
    """New columns appear on a table by a schema-only version; old rows read as NULL there."""
    t = Table(s, work_path(s, "evolved"))
    t.append(table(s, d, "orders"), AS_OF)
    wider = table(s, d, "orders").withColumn("o_channel", F.lit("web"))
    O.handle_drift(t, wider.schema, AS_OF)
    t.append(wider.where("o_orderstatus = 'F'"), AS_OF)
    return t.read().groupBy("o_channel").agg(F.count(F.lit(1)).alias("n"))


query("handle_schema_drift", """
SELECT NULL::VARCHAR AS o_channel, count(*)::BIGINT AS n FROM orders UNION ALL SELECT 'web', count(*)::BIGINT FROM orders WHERE o_orderstatus = 'F' """)(_evolved)
query("create_from_template", "SELECT 0::BIGINT AS rows_now, 9::BIGINT AS columns_now")(lambda s, d: _created(s, d))


def _created(s, d):
    t = Table(s, work_path(s, "template"))
    extra = [T.StructField("_source_file", T.StringType()), T.StructField("_loaded_at", T.TimestampNTZType()), T.StructField("raw", T.StringType())]
    O.create_from_template(s, t, G.parquet_stage(s, d), FileFormat.parquet(), AS_OF, extra)
    return t.read().agg(F.count(F.lit(1)).alias("rows_now"), F.lit(len(t.schema().fields)).cast("bigint").alias("columns_now"))


def _documents(s, d):
    """Event documents with nested values of several shapes."""
    e = D.raw_events(s, d)
    doc = F.to_json(F.struct(
        F.col("event_id"), F.when(F.col("user_id") % 2 == 0, F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name"))).alias("user"),
        F.array(F.struct(F.col("value").alias("v")), F.struct((F.col("value") + 1).alias("v"))).alias("items"),
        F.when(F.col("user_id") % 3 == 0, F.lit("x")).alias("note")), {"ignoreNullFields": "true"})
    return e.select(F.parse_json(doc).alias("v"))


query("json_keys", """
SELECT 'event_id' AS column_name, 'number' AS data_type, count(*)::BIGINT AS occurrence_count FROM events
UNION ALL SELECT 'items', 'array', count(*)::BIGINT FROM events UNION ALL SELECT 'user', 'object', count(*)::BIGINT FROM events WHERE user_id % 2 = 0
UNION ALL SELECT 'note', 'string', count(*)::BIGINT FROM events WHERE user_id % 3 = 0 """)(lambda s, d: O.json_keys(_documents(s, d), "v"))
query("json_paths", """
SELECT 'event_id' AS json_path, 'number' AS value_types, count(*)::BIGINT AS occurrences FROM events
UNION ALL SELECT 'items', 'array', count(*)::BIGINT FROM events UNION ALL SELECT 'items[]', 'object', 2 * count(*)::BIGINT FROM events UNION ALL SELECT 'items[].v', 'number', 2 * count(*)::BIGINT FROM events
UNION ALL SELECT 'user', 'object', count(*)::BIGINT FROM events WHERE user_id % 2 = 0 UNION ALL SELECT 'user.id', 'number', count(*)::BIGINT FROM events WHERE user_id % 2 = 0
UNION ALL SELECT 'user.name', 'string', count(*)::BIGINT FROM events WHERE user_id % 2 = 0 UNION ALL SELECT 'note', 'string', count(*)::BIGINT FROM events WHERE user_id % 3 = 0 """)(
    lambda s, d: O.json_paths(_documents(s, d), "v"))
query("peek_keys", "SELECT 'k' AS k, count(*)::BIGINT AS n FROM events")(lambda s, d: O.peek(table(s, d, "events"), "props").select(
    F.explode("top_level_keys").alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n")))
