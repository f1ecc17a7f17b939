"""Per-file load history of a table, written by every load before its version is published."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources import fs
from .versioned import Table

# Days a load is remembered for, by bulk loads and by pipes.
BULK_TRACKING_DAYS = 64
PIPE_TRACKING_DAYS = 14

HISTORY_SCHEMA = (
    "table_name string, stage_location string, file_name string, pipe_name string, status string, row_parsed bigint, "
    "row_count bigint, file_size bigint, error_limit bigint, errors_seen bigint, first_error_message string, "
    "first_error_line_number bigint, first_error_character bigint, first_error_column_name string, "
    "last_load_time timestamp_ntz, file_modified timestamp_ntz, load_id string"
)


def record(table: Table, rows: DataFrame, load_id: str) -> DataFrame:
    """Store the rows of one load, by the day the files were last changed, and return them as stored.

    Whoever looks for a file reads the days of its change only, however long the history is.
    """
    root = f"{table.path}/history"
    day = F.coalesce(F.date_format("file_modified", "yyyy-MM-dd"), F.lit("none"))
    out = rows.drop("load_id").withColumns({"file_day": day, "load_id": F.lit(load_id)})
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_day", "load_id").parquet(root)
    return _read(table, [f"{root}/{d}/load_id={load_id}" for d in _days(table) if fs.exists(table.spark, f"{root}/{d}/load_id={load_id}")])


def _days(table: Table) -> list[str]:
    return [d for d in fs.children(table.spark, f"{table.path}/history") if d.startswith("file_day=")]


def _read(table: Table, paths: list[str]) -> DataFrame:
    if not paths:
        return table.spark.createDataFrame([], HISTORY_SCHEMA)
    rows = table.spark.read.schema(HISTORY_SCHEMA + ", file_day string").option("basePath", f"{table.path}/history").parquet(*paths)
    return rows.drop("file_day")


def history(table: Table, committed_only: bool = True, days: list[str] | None = None) -> DataFrame:
    """Load history of a table, or its part on files last changed on some days (`yyyy-MM-dd`).

    Rows of loads that never published a version do not count; which did is looked up only if there are rows.
    """
    known = _days(table)
    chosen = known if days is None else [d for d in known if d in {f"file_day={x}" for x in days} | {"file_day=none"}]
    rows = _read(table, [f"{table.path}/history/{d}" for d in chosen])
    if not committed_only or not chosen or (days is not None and rows.isEmpty()):
        return rows
    return rows.join(table.committed_loads(), "load_id", "left_semi")


def load_report(history_rows: DataFrame, return_failed_only: bool = False) -> DataFrame:
    """The report a load returns, one row per file."""
    out = history_rows.select(
        F.col("file_name").alias("file"), "status", F.col("row_parsed").alias("rows_parsed"), F.col("row_count").alias("rows_loaded"),
        "error_limit", "errors_seen", F.col("first_error_message").alias("first_error"),
        F.col("first_error_line_number").alias("first_error_line"), F.col("first_error_character").alias("first_error_character"),
        "first_error_column_name",
    )
    return out.where("errors_seen > 0") if return_failed_only else out
