"""Schemas as DataFrames: inference, comparison, drift, and JSON shape profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.numbers import rows
from ..functions.times import ntz
from ..sources.formats import FileFormat, reader
from .versioned import Table

SCHEMA_COLUMNS = "column_name string, data_type string, nullable boolean, ordinal_position int"


def schema_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One row per top-level column; as many rows as a table has columns."""
    data = [(f.name, f.dataType.simpleString(), f.nullable, i + 1) for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(data, SCHEMA_COLUMNS)


def infer_schema(spark: SparkSession, path, fmt: FileFormat, files: list[str] | None = None, sampling_ratio: float | None = None) -> DataFrame:
    """COLUMN_NAME, TYPE, NULLABLE, EXPRESSION, FILENAMES, ORDER_ID of staged files.

    Columnar files are inferred from footers, JSON from (a share of) the records. CSV has
    no names or types to infer.
    """
    if fmt.kind == "csv":
        raise ValueError("CSV columns cannot be inferred; give a schema")
    r = reader(spark, fmt)
    if fmt.kind == "parquet":
        r = r.option("mergeSchema", "true")
    if fmt.kind == "json":
        r = spark.read.option("recursiveFileLookup", "true")
        if sampling_ratio:
            r = r.option("samplingRatio", sampling_ratio)
        r = r.format("json")
    where = files if files is not None else path
    found = r.load(where).schema
    shown = ", ".join(files) if files is not None else str(path)
    return schema_frame(spark, found).select(
        F.col("column_name").alias("COLUMN_NAME"), F.col("data_type").alias("TYPE"), F.col("nullable").alias("NULLABLE"),
        F.concat(F.lit("$1:"), "column_name", F.lit("::"), F.upper("data_type")).alias("EXPRESSION"),
        F.lit(shown).alias("FILENAMES"), (F.col("ordinal_position") - 1).alias("ORDER_ID"),
    )


def template(inferred: DataFrame) -> DataFrame:
    """The inferred rows as one array of objects; bounded by the number of columns."""
    return inferred.agg(F.array_sort(F.collect_list(F.struct("ORDER_ID", "COLUMN_NAME", "TYPE", "NULLABLE"))).alias("columns"))


def create_from_template(spark: SparkSession, table: Table, path, fmt: FileFormat, as_of, add: list[T.StructField] = ()) -> int:
    """An empty table with the inferred columns, plus audit columns if wanted."""
    found = reader(spark, fmt).load(path).schema
    return table.append(spark.createDataFrame([], T.StructType(found.fields + list(add))), as_of, "create")


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Full comparison by upper-cased name: OK, NEW, REMOVED, TYPE_CHANGE, NULLABLE_CHANGE."""
    def side(df, prefix):
        return df.select(F.upper("column_name").alias("column_name"), F.col("data_type").alias(f"{prefix}_type"),
                         F.col("nullable").alias(f"{prefix}_nullable"), F.col("ordinal_position").alias(f"{prefix}_pos"))

    joined = side(source, "source").join(side(target, "target"), "column_name", "full_outer")
    drift = (
        F.when(F.col("source_pos").isNull(), "REMOVED - Column no longer in source")
        .when(F.col("target_pos").isNull(), "NEW - Column added to source")
        .when(~F.col("source_type").eqNullSafe(F.col("target_type")), "TYPE_CHANGE")
        .when(~F.col("source_nullable").eqNullSafe(F.col("target_nullable")), "NULLABLE_CHANGE").otherwise("OK")
    )
    return joined.withColumn("drift_status", drift).orderBy(F.coalesce("source_pos", "target_pos"), "column_name").select(
        "column_name", "source_type", "target_type", "source_nullable", "target_nullable", "drift_status")


def new_columns(source: DataFrame, target: DataFrame) -> DataFrame:
    known = target.select(F.upper("column_name").alias("_k"))
    return source.withColumn("_k", F.upper("column_name")).join(known, "_k", "left_anti").select("column_name", "data_type")


def schema_snapshot(schema: DataFrame, location: str, as_of) -> DataFrame:
    """Rows for ops.schema_snapshots; all rows of one snapshot share an id."""
    return schema.select(
        F.md5(F.lit(f"{location}|{as_of}")).alias("snapshot_id"), ntz(as_of).alias("snapshot_time"), F.lit(location).alias("source_location"),
        "column_name", "data_type", "nullable", "ordinal_position")


def snapshot_diff(snapshots: DataFrame) -> DataFrame:
    """Changes between the last two snapshots, found by scalar subqueries."""
    newest = snapshots.agg(F.max("snapshot_time")).scalar()
    before = snapshots.where(F.col("snapshot_time") < newest).agg(F.max("snapshot_time")).scalar()
    c = snapshots.where(F.col("snapshot_time") == newest).select("column_name", F.col("data_type").alias("current_type"))
    p = snapshots.where(F.col("snapshot_time") == before).select("column_name", F.col("data_type").alias("previous_type"))
    change = (F.when(F.col("previous_type").isNull(), "NEW").when(F.col("current_type").isNull(), "REMOVED")
              .when(F.col("previous_type") != F.col("current_type"), "TYPE_CHANGED").otherwise("UNCHANGED"))
    return c.join(p, "column_name", "full_outer").select("column_name", "previous_type", "current_type", change.alias("change_type")).where(
        "change_type <> 'UNCHANGED'")


def handle_drift(table: Table, source: T.StructType, as_of) -> str:
    """Add the source's new columns to the table: one schema-only version."""
    have = {n.upper() for n in table.schema().names}
    fresh = [T.StructField(f.name, f.dataType, True) for f in source if f.name.upper() not in have]
    if fresh:
        table.add_columns(fresh, as_of)
    return f"Added {len(fresh)} new columns"


def validate_schema(source: DataFrame, target: DataFrame, allow_new=False) -> DataFrame:
    """One row: FAIL on missing or retyped columns, WARN on new ones unless allowed, else PASS."""
    status = F.col("drift_status")
    n = schema_diff(source, target).agg(
        F.count_if(status.startswith("REMOVED") | (status == "TYPE_CHANGE")).alias("breaking"),
        F.count_if(status.startswith("NEW")).alias("added"))
    return n.select(
        "breaking", "added",
        F.when(F.col("breaking") > 0, F.concat(F.lit("FAIL: "), F.col("breaking").cast("string"), F.lit(" breaking schema changes detected")))
        .when((F.col("added") > 0) & F.lit(not allow_new), F.concat(F.lit("WARN: "), F.col("added").cast("string"), F.lit(" new columns in source (not blocking)")))
        .otherwise("PASS: Schema compatible").alias("result"))


def log_drift(source: DataFrame, target: DataFrame, location: str, table: str, as_of) -> DataFrame:
    """Rows for ops.schema_drift_log: new, removed and retyped columns."""
    status = F.col("drift_status")
    kind = F.when(status.startswith("REMOVED"), "REMOVED").when(status.startswith("NEW"), "NEW").when(status == "TYPE_CHANGE", "TYPE_CHANGED")
    return schema_diff(source, target).withColumn("change_type", kind).where("change_type is not null").select(
        F.md5(F.concat_ws("|", F.lit(location), F.lit(table), "column_name", F.lit(str(as_of)))).alias("drift_id"), ntz(as_of).alias("detected_at"),
        F.lit(location).alias("source_location"), F.lit(table).alias("target_table"), "column_name", "change_type",
        F.col("target_type").alias("old_value"), F.col("source_type").alias("new_value"), F.lit(None).cast("string").alias("action_taken"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"))


# ---- JSON shapes -----------------------------------------------------------------------------


def _type_name(v):
    """Type of a VARIANT value in short: object, array, string, number, boolean, null."""
    t = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | F.is_variant_null(v), "null").when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array")
        .when(t == "STRING", "string").when(t == "BOOLEAN", "boolean").otherwise("number")
    )


def _children(item):
    """(path, value) of the members of an object or the elements of an array, as an array."""
    path, v = item["path"], item["v"]
    fields = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    elements = F.try_variant_get(v, "$", "array<variant>")
    named = F.transform(fields, lambda e: F.struct(
        F.when(path == "", e["key"]).otherwise(F.concat_ws(".", path, e["key"])).alias("path"), e["value"].alias("v")))
    listed = F.transform(elements, lambda e: F.struct(F.concat(path, F.lit("[]")).alias("path"), e.alias("v")))
    return F.coalesce(named, listed, F.array().cast("array<struct<path:string,v:variant>>"))


def json_keys(df: DataFrame, variant: str) -> DataFrame:
    """Top-level keys of all documents with value type and number of occurrences."""
    root = F.struct(F.lit("").alias("path"), F.col(variant).alias("v"))
    pairs = df.where(F.col(variant).isNotNull()).select(F.explode(_children(root)).alias("n"))
    return pairs.groupBy(F.col("n.path").alias("column_name"), _type_name(F.col("n.v")).alias("data_type")).agg(
        rows("occurrence_count")).orderBy("column_name", "data_type")


def json_paths(df: DataFrame, variant: str, depth: int = 4) -> DataFrame:
    """Every path, at any depth, with its value types and occurrences.

    Each document is unrolled inside its row, level by level, and exploded once; array
    elements share the path `name[]`. No document is sampled away. `depth` is a first guess
    at the number of levels: while some document has values below, it is doubled.
    """
    level = F.array(F.struct(F.lit("").alias("path"), F.col(variant).alias("v")))
    start = df.where(F.col(variant).isNotNull()).select(level.alias("l0"))
    while True:
        out = start
        for i in range(depth):
            out = out.withColumn(f"l{i + 1}", F.flatten(F.transform(F.col(f"l{i}"), _children)))
        if out.where(F.size(F.flatten(F.transform(F.col(f"l{depth}"), _children))) > 0).isEmpty():
            break
        depth *= 2
    nodes = out.select(F.explode(F.concat(*[F.col(f"l{i + 1}") for i in range(depth)])).alias("n"))
    counted = nodes.groupBy(F.col("n.path").alias("path"), _type_name(F.col("n.v")).alias("t")).agg(rows("n"))
    return counted.groupBy(F.col("path").alias("json_path")).agg(
        # at most six type names per path
        F.array_join(F.array_sort(F.collect_set("t")), ", ").alias("value_types"), F.sum("n").alias("occurrences"),
    ).orderBy("json_path")


def peek(df: DataFrame, text: str) -> DataFrame:
    """Documents with the list of their top-level keys."""
    return df.select(F.col(text).alias("raw_json"), F.json_object_keys(text).alias("top_level_keys"))
