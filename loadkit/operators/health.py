"""Pipe health: status rows, notification lag and the combined health check."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import rows, total
from ..functions.times import diff, ntz, within

# Health thresholds.
MAX_PENDING_FILES = 1000
MAX_LAG_MINUTES = 30
MIN_FILES_PER_HOUR = 1
MAX_SKIPPED_ROWS = 100


def parse_status(status: DataFrame) -> DataFrame:
    """Typed columns from the status document of each pipe."""
    def field(name, cast):
        return F.get_json_object("status_json", f"$.{name}").cast(cast)

    return status.select(
        "pipe_name", field("executionState", "string").alias("state"),
        field("pendingFileCount", "int").alias("pending_files"),
        field("lastReceivedMessageTimestamp", "timestamp_ntz").alias("last_message"),
        field("notificationChannelName", "string").alias("notification_channel"),
    )


def pipe_issues(status: DataFrame, max_pending=MAX_PENDING_FILES) -> DataFrame:
    return parse_status(status).where(
        F.col("state").isin("PAUSED", "STALLED") | (F.col("pending_files") > max_pending))


def notification_health(status: DataFrame, as_of, warn=60, check=15) -> DataFrame:
    lag = diff("minute", "last_message", ntz(as_of))
    return parse_status(status).select(
        "pipe_name", "last_message", lag.alias("minutes_since_last_message"),
        F.when(lag > warn, "WARNING").when(lag > check, "CHECK").otherwise("OK").alias("health_status"),
    ).orderBy(F.desc("minutes_since_last_message"), "pipe_name")


def health_check(
    status: DataFrame, hist: DataFrame, loaded: DataFrame, as_of, loaded_at="_loaded_at", hours=1,
    max_pending=MAX_PENDING_FILES, max_lag=MAX_LAG_MINUTES, min_files=MIN_FILES_PER_HOUR, max_skipped=MAX_SKIPPED_ROWS,
) -> DataFrame:
    """All issues of all pipes as (check_name, subject, value) rows; empty means healthy.

    Failed loads and skipped rows are counted per table of the history, so every pipe is
    judged by its own target.
    """
    parsed = parse_status(status)
    recent = hist.where(within("last_load_time", as_of, hours=hours))
    per_table = recent.where("status = 'LOAD_FAILED' or row_parsed > row_count").groupBy("table_name").agg(
        rows("failed"), total(F.col("row_parsed") - F.col("row_count")).alias("skipped"))
    lag = loaded.agg(diff("minute", F.max(loaded_at), ntz(as_of)).alias("value"))
    files = recent.agg(F.count_distinct("file_name").alias("value"))

    def issue(df, name, subject, value):
        return df.select(F.lit(name).alias("check_name"), subject.alias("subject"), F.col(value).cast("bigint").alias("value"))

    parts = [
        issue(parsed.where("state = 'STALLED'"), "stalled", F.col("pipe_name"), "pending_files"),
        issue(parsed.where("state = 'PAUSED'"), "paused", F.col("pipe_name"), "pending_files"),
        issue(parsed.where(F.col("pending_files") > max_pending), "backlog", F.col("pipe_name"), "pending_files"),
        issue(per_table.where("failed > 0"), "failed_loads", F.col("table_name"), "failed"),
        issue(per_table.where(F.col("skipped") > max_skipped), "skipped_rows", F.col("table_name"), "skipped"),
        issue(lag.where(F.col("value") > max_lag), "behind", F.lit("all"), "value"),
        issue(files.where(F.col("value") < min_files), "few_files", F.lit("all"), "value"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def pipe_metrics(status: DataFrame, as_of) -> DataFrame:
    """Rows for the metrics trend table."""
    return parse_status(status).select(
        ntz(as_of).alias("check_time"), "pipe_name", F.col("state").alias("execution_state"), "pending_files")


def load_transform_status(hist: DataFrame, transforms: DataFrame, as_of, hours=24, prefix="stg_") -> DataFrame:
    """Last load of each table beside the last run of its transform (`stg_` + table)."""
    loads = hist.where(within("last_load_time", as_of, hours=hours)).groupBy("table_name").agg(
        F.max("last_load_time").alias("loaded_at"), total("row_count").alias("rows_loaded"))
    runs = transforms.where(within("run_started_at", as_of, hours=hours)).groupBy("model_name", "status").agg(
        F.max("completed_at").alias("transformed_at"))
    keyed = loads.withColumn("model_name", F.concat(F.lit(prefix), F.lower(F.split_part("table_name", F.lit("."), F.lit(-1)))))
    return keyed.join(runs, "model_name", "left").select(
        "table_name", "loaded_at", "rows_loaded", "transformed_at", F.col("status").alias("transform_status"),
        diff("minute", "loaded_at", "transformed_at").alias("load_to_transform_minutes"),
    )
