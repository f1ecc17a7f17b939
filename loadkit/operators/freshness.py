"""Freshness of tables, its history, and gates that run a transform only on fresh data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import pct, rows
from ..functions.times import diff, ntz, within

# Minutes before a table is late, and is in error.
LIMITS = {"events": (15, 30), "customers": (360, 720), "orders": (60, 120)}


def staleness(tables: dict[str, tuple[DataFrame, str]], as_of) -> DataFrame:
    """Minutes since the newest load of each table: one max per table, stacked."""
    out = None
    for name, (df, loaded_at) in tables.items():
        one = df.agg(F.max(loaded_at).alias("max_loaded_at")).select(F.lit(name).alias("table_name"), "max_loaded_at")
        out = one if out is None else out.unionByName(one)
    return out.select(
        "table_name", "max_loaded_at", ntz(as_of).alias("checked_at"),
        diff("minute", "max_loaded_at", ntz(as_of)).alias("minutes_stale"),
    )


def freshness(tables: dict[str, tuple[DataFrame, str]], as_of, limits: dict | None = None) -> DataFrame:
    """pass / warn / error per table by its limits (at or above)."""
    limits = limits or LIMITS
    spark = next(iter(tables.values()))[0].sparkSession
    config = spark.createDataFrame([(t, w, e) for t, (w, e) in limits.items()], "table_name string, warn_minutes int, error_minutes int")
    stale = F.col("minutes_stale")
    # one row per configured table: the configuration is written by hand
    return staleness(tables, as_of).join(F.broadcast(config), "table_name").withColumn(
        "freshness_status",
        F.when(stale >= F.col("error_minutes"), "error").when(stale >= F.col("warn_minutes"), "warn").otherwise("pass"),
    )


def freshness_record(status: DataFrame, source: str = "raw") -> DataFrame:
    """Rows for ops.source_freshness_history."""
    return status.select(
        F.lit(source).alias("source_name"), "table_name", "max_loaded_at", F.col("checked_at").alias("snapshotted_at"),
        "freshness_status", F.col("error_minutes").alias("error_after_minutes"),
        F.col("warn_minutes").alias("warn_after_minutes"), F.col("minutes_stale").alias("actual_freshness_minutes"),
    )


def stale_message(status: DataFrame) -> DataFrame:
    """One message naming every table in error; no row when there is none. The list is as long as the configuration."""
    item = F.format_string("%s (%dm)", F.col("table_name"), F.col("minutes_stale"))
    return status.where("freshness_status = 'error'").agg(
        F.array_sort(F.collect_list(item)).alias("_items")).where(F.size("_items") > 0).select(
        F.lit("stale_data").alias("alert_type"),
        F.concat(F.lit("Stale tables: "), F.array_join("_items", ", ")).alias("message"))


def run_if_fresh(status: DataFrame, transform: Callable[[], object], min_rows: int = 0, source: DataFrame | None = None):
    """Run `transform` only when no source is in error and, if asked, enough rows arrived.

    Returns (message, result). Both gates look at one row.
    """
    stale = status.where("freshness_status = 'error'").count()
    if stale:
        return f"Skipped: {stale} stale sources", None
    if source is not None and min_rows and source.limit(min_rows).count() < min_rows:
        return f"Skipped: fewer than {min_rows} rows", None
    return "Triggered", transform()


def freshness_summary(history: DataFrame, as_of, days=7) -> DataFrame:
    status = F.col("freshness_status")
    return history.where(within("snapshotted_at", as_of, days=days)).groupBy("table_name").agg(
        F.round(F.avg("actual_freshness_minutes"), 6).alias("avg_minutes_stale"),
        F.max("actual_freshness_minutes").alias("max_minutes_stale"),
        F.count_if(status == "error").alias("error_count"), F.count_if(status == "warn").alias("warn_count"), rows("total_checks"),
    ).orderBy(F.desc("avg_minutes_stale"))


def freshness_by_hour(history: DataFrame, as_of, days=30) -> DataFrame:
    return history.where(within("snapshotted_at", as_of, days=days)).groupBy(
        "table_name", F.hour("snapshotted_at").alias("hour_of_day")
    ).agg(F.round(F.avg("actual_freshness_minutes"), 6).alias("avg_staleness")).orderBy("table_name", "hour_of_day")


def freshness_by_weekday(history: DataFrame, as_of, days=30) -> DataFrame:
    return history.where(within("snapshotted_at", as_of, days=days)).groupBy(
        "table_name", F.dayname("snapshotted_at").alias("day_of_week")
    ).agg(
        F.count_if(F.col("freshness_status").isin("warn", "error")).alias("stale_count"), rows("total_checks"),
    ).withColumn("stale_pct", pct("stale_count", "total_checks", 1)).orderBy("table_name", F.desc("stale_pct"))


def load_freshness(hist: DataFrame, status: DataFrame, as_of, hours=24) -> DataFrame:
    """Recent loads beside their table's freshness; names compare in any case, schema left out."""
    def short(c):
        return F.upper(F.split_part(c, F.lit("."), F.lit(-1)))

    s = status.select(short("table_name").alias("_t"), "max_loaded_at", "minutes_stale", "freshness_status")
    return hist.where(within("last_load_time", as_of, hours=hours)).withColumn("_t", short("table_name")).join(s, "_t", "left").select(
        "table_name", "file_name", "row_count", "last_load_time", "max_loaded_at", "minutes_stale", "freshness_status",
        diff("minute", "last_load_time", "max_loaded_at").alias("load_to_freshness_minutes"),
    )
