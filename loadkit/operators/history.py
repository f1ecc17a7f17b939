"""Questions to the load history: what loaded, failed, was skipped, repeated or is late.

The history has one row per file and load (see `ledger.HISTORY_SCHEMA`). Look-back windows
are literals computed from `as_of`, so they are pushed into the history scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import pct, rows, total
from ..functions.text import base_name, error_type
from ..functions.times import diff, ntz, trunc, within
from ..functions.windows import lag_over_time

LOADED, PARTIAL, FAILED = "LOADED", "PARTIALLY_LOADED", "LOAD_FAILED"


def _recent(hist: DataFrame, as_of, **interval) -> DataFrame:
    return hist.where(within("last_load_time", as_of, **interval)) if interval else hist


def copy_history(hist: DataFrame, table: str | None, start) -> DataFrame:
    """Rows of one table (all tables when None) since `start`, newest first."""
    rows_ = hist.where(F.col("last_load_time") >= ntz(start))
    if table is not None:
        rows_ = rows_.where(F.lower("table_name") == table.lower())
    return rows_.orderBy(F.desc("last_load_time"), "file_name")


def status_summary(hist: DataFrame, as_of, days=7, by_pipe=False) -> DataFrame:
    keys = ["pipe_name", "status"] if by_pipe else ["status"]
    return _recent(hist, as_of, days=days).groupBy(*keys).agg(
        rows("file_count"),
        total("row_count").alias("total_rows_loaded"),
        total("row_parsed").alias("total_rows_parsed"),
        total(F.col("row_parsed") - F.col("row_count")).alias("rows_skipped"),
        F.min("last_load_time").alias("earliest_load"),
        F.max("last_load_time").alias("latest_load"),
    ).orderBy(*keys)


def failed_loads(hist: DataFrame, as_of, days=7) -> DataFrame:
    return _recent(hist, as_of, days=days).where(F.col("status") != LOADED).select(
        "file_name", "pipe_name", "status", "first_error_message", "first_error_line_number",
        "first_error_column_name", "row_parsed", "row_count", "last_load_time",
    ).orderBy(F.desc("last_load_time"), "file_name")


def failed_files(hist: DataFrame, as_of, days=7, statuses=(FAILED, PARTIAL)) -> DataFrame:
    """Distinct files that failed or loaded in part, the input of a retry."""
    return _recent(hist, as_of, days=days).where(F.col("status").isin(*statuses)).select(
        "file_name", "stage_location", "status").distinct()


def hourly_volume(hist: DataFrame, as_of, days=1) -> DataFrame:
    return _recent(hist, as_of, days=days).where(F.col("status") == LOADED).groupBy(
        trunc("hour", "last_load_time").alias("load_hour")
    ).agg(
        rows("files_loaded"), total("row_count").alias("rows_loaded"),
        F.round(F.avg("row_count"), 6).alias("avg_rows_per_file"),
    ).orderBy(F.desc("load_hour"))


def daily_by_table(hist: DataFrame, as_of, days=30) -> DataFrame:
    return _recent(hist, as_of, days=days).groupBy(
        "table_name", trunc("day", "last_load_time").alias("load_date")
    ).agg(
        rows("files_loaded"), total("row_count").alias("total_rows"),
        F.count_if(F.col("status") != LOADED).alias("failed_files"),
    ).orderBy(F.desc("load_date"), F.desc("total_rows"))


def error_patterns(hist: DataFrame, as_of, days=30) -> DataFrame:
    return _recent(hist, as_of, days=days).where(F.col("status") != LOADED).groupBy(
        error_type("first_error_message").alias("error_type")
    ).agg(
        rows("occurrence_count"), F.count_distinct("file_name").alias("affected_files"),
        F.max("last_load_time").alias("most_recent"),
    ).orderBy(F.desc("occurrence_count"), "error_type")


def duplicate_files(hist: DataFrame, as_of, days=30, loaded_only=True) -> DataFrame:
    recent = _recent(hist, as_of, days=days)
    if loaded_only:
        recent = recent.where(F.col("status") == LOADED)
    return recent.groupBy("file_name", "table_name").agg(
        rows("load_count"), F.min("last_load_time").alias("first_load"), F.max("last_load_time").alias("last_load"),
    ).where("load_count > 1").orderBy(F.desc("load_count"), "file_name")


def load_sla(hist: DataFrame, as_of, minutes=60, days=1) -> DataFrame:
    """Gap to the table's previous load; LATE when longer than `minutes`."""
    loaded = _recent(hist, as_of, days=days).where(F.col("status") == LOADED).select(
        "table_name", "file_name", "last_load_time")
    lagged = lag_over_time(loaded, ["table_name"], "last_load_time", "prev_load_time", ["file_name"])
    gap = diff("minute", "prev_load_time", "last_load_time")
    return lagged.where("prev_load_time is not null").select(
        "table_name", "last_load_time", "prev_load_time", gap.alias("minutes_since_last"),
        F.when(gap > minutes, "LATE").otherwise("OK").alias("sla_status"),
    )


def hours_since_load(hist: DataFrame, as_of, days=7) -> DataFrame:
    last = _recent(hist, as_of, days=days).where(F.col("status") == LOADED).groupBy("table_name").agg(
        F.max("last_load_time").alias("last_load"))
    return last.withColumn("hours_since_load", diff("hour", "last_load", ntz(as_of)))


def migration_progress(hist: DataFrame, as_of, days=7) -> DataFrame:
    return _recent(hist, as_of, days=days).groupBy(trunc("hour", "last_load_time").alias("hour")).agg(
        rows("files_loaded"), total("row_count").alias("rows_loaded"),
        F.round(F.sum("file_size").cast("double") / 1e9, 9).alias("gb_loaded"),
    ).orderBy("hour")


def incremental_history(hist: DataFrame, as_of, days=7) -> DataFrame:
    return _recent(hist, as_of, days=days).groupBy(trunc("day", "last_load_time").alias("load_date")).agg(
        rows("load_count"), total("row_count").alias("total_rows"),
        F.round(F.avg("row_count"), 6).alias("avg_rows_per_load"),
    ).orderBy(F.desc("load_date"))


def pipe_history(hist: DataFrame, as_of, hours=24) -> DataFrame:
    """Loads made by pipes only."""
    return _recent(hist, as_of, hours=hours).where("pipe_name is not null").select(
        "pipe_name", "file_name", "status", "row_count", "first_error_message", "last_load_time",
    ).orderBy(F.desc("last_load_time"), "file_name")


def pipe_throughput(hist: DataFrame, as_of, days=1) -> DataFrame:
    return _recent(hist, as_of, days=days).where("pipe_name is not null").groupBy(
        "pipe_name", trunc("hour", "last_load_time").alias("hour")
    ).agg(
        rows("files_loaded"), total("row_count").alias("rows_loaded"),
        F.round(F.avg("row_count"), 6).alias("avg_rows_per_file"),
        F.count_if(F.col("status") != LOADED).alias("failed_files"),
    ).orderBy(F.desc("hour"))


def failing_patterns(hist: DataFrame, as_of, hours=24) -> DataFrame:
    """Pipe failures grouped by base name, to spot one bad producer."""
    return _recent(hist, as_of, hours=hours).where(
        F.col("pipe_name").isNotNull() & (F.col("status") != LOADED)
    ).groupBy(
        "pipe_name", base_name("file_name").alias("file_name_only"), "status", "first_error_message"
    ).agg(rows("occurrence")).orderBy(F.desc("occurrence"), "file_name_only")


def skipped_rows(hist: DataFrame, as_of, days=7) -> DataFrame:
    skipped = F.col("row_parsed") - F.col("row_count")
    return _recent(hist, as_of, days=days).where("row_parsed > row_count").select(
        "file_name", "status", "row_parsed", "row_count", skipped.alias("skipped_rows"),
        pct(skipped, "row_parsed").alias("skip_pct"), "first_error_message", "first_error_line_number",
    ).orderBy(F.desc("skipped_rows"), "file_name")


def error_rate_daily(hist: DataFrame, as_of, days=30) -> DataFrame:
    return _recent(hist, as_of, days=days).groupBy(trunc("day", "last_load_time").alias("load_date"), "status").agg(
        rows("file_count"), total("row_parsed").alias("total_parsed"), total("row_count").alias("total_loaded"),
    ).withColumn("error_pct", pct(F.col("total_parsed") - F.col("total_loaded"), "total_parsed")).orderBy(
        F.desc("load_date"), "status")


def skip_rate_weekly(hist: DataFrame, as_of, days=30) -> DataFrame:
    return _recent(hist, as_of, days=days).groupBy(trunc("week", "last_load_time").alias("week")).agg(
        total("row_parsed").alias("total_parsed"), total("row_count").alias("total_loaded"),
        total(F.col("row_parsed") - F.col("row_count")).alias("total_skipped"),
    ).withColumn("skip_pct", pct("total_skipped", "total_parsed")).orderBy(F.desc("week"))


def unmonitored_tables(hist: DataFrame, rejects: DataFrame, as_of, days=7) -> DataFrame:
    """Tables that skipped rows while nothing captured their rejects.

    An anti join, so a NULL target_table in the rejects cannot empty the answer.
    """
    skipping = _recent(hist, as_of, days=days).where("row_parsed > row_count").select("table_name").distinct()
    captured = rejects.select(F.col("target_table").alias("table_name")).distinct()
    return skipping.join(captured, "table_name", "left_anti")


def load_health(hist: DataFrame, as_of, days=30, issues_only=False) -> DataFrame:
    health = _recent(hist, as_of, days=days).groupBy(
        trunc("day", "last_load_time").alias("load_date"), "table_name"
    ).agg(
        rows("load_count"), total("row_parsed").alias("total_parsed"), total("row_count").alias("total_loaded"),
        total(F.col("row_parsed") - F.col("row_count")).alias("total_skipped"),
        F.count_if(F.col("status") == FAILED).alias("failed_loads"),
    ).withColumn("skip_pct", pct("total_skipped", "total_parsed"))
    if issues_only:
        health = health.where("skip_pct > 1 or failed_loads > 0")
    return health.orderBy(F.desc("load_date"), "table_name")


def load_tracking(hist: DataFrame, as_of, minutes=None) -> DataFrame:
    """External tracking rows (id, file, hash of identity, time, rows) from the history.

    The id is a hash of file and load time, so recording the same load twice gives the same id.
    """
    recent = _recent(hist, as_of, minutes=minutes) if minutes else hist
    return recent.select(
        F.md5(F.concat_ws("|", "table_name", "file_name", F.col("last_load_time").cast("string"))).alias("load_id"),
        "file_name",
        F.md5(F.concat_ws("|", "file_name", F.col("file_size").cast("string"))).alias("file_hash"),
        F.col("last_load_time").alias("loaded_at"), "row_count",
    )
