"""Cost and usage reports over usage rows (pipe usage, stream migrations, statement history)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import exact_ratio, ratio, rounded_sum, rows, total
from ..functions.text import copy_target
from ..functions.times import back, diff, ntz, trunc, within

# Credits per hour by warehouse size.
CREDITS_PER_HOUR = {"X-Small": 1, "Small": 2, "Medium": 4, "Large": 8, "X-Large": 16}
DEFAULT_CREDITS_PER_HOUR = 4
# Sizes that count as large.
LARGE_SIZES = ("X-Large", "2X-Large", "3X-Large", "4X-Large")
MS_PER_HOUR = 3600000.0


def _gb(c: str) -> Column:
    return F.round(F.sum(c).cast("double") / 1e9, 9)


def pipe_usage(usage: DataFrame, as_of, unit="day", **window) -> DataFrame:
    window = window or ({"days": 30} if unit == "day" else {"months": 3})
    return usage.where(within("start_time", as_of, **window)).groupBy(
        "pipe_name", trunc(unit, "start_time").alias(unit)
    ).agg(
        rounded_sum("credits_used").alias("credits"), total("files_inserted").alias("files_loaded"),
        _gb("bytes_inserted").alias("gb_loaded"),
        F.round(ratio(F.sum("credits_used"), F.sum("files_inserted")), 6).alias("credits_per_file"),
    ).orderBy("pipe_name", F.desc(unit))


def _method_costs(pipes: DataFrame, migrations: DataFrame, statements: DataFrame, rate: float, unit: str, names) -> DataFrame:
    bucket = trunc(unit, "start_time").alias(unit)
    parts = [
        pipes.groupBy(bucket).agg(F.sum("credits_used").alias("credits")).withColumn("method", F.lit(names[0])),
        migrations.groupBy(bucket).agg(F.sum("credits_used").alias("credits")).withColumn("method", F.lit(names[1])),
        statements.where("query_type = 'COPY'").groupBy(bucket)
        .agg((F.sum("execution_time").cast("double") / MS_PER_HOUR * rate).alias("credits"))
        .withColumn("method", F.lit(names[2])),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select(unit, "method", F.round("credits", 4).alias("credits"))


def cost_by_method(pipes, migrations, statements, as_of, days=30, credits_per_hour=DEFAULT_CREDITS_PER_HOUR) -> DataFrame:
    """Credits per day for file pipe, row stream and bulk copy (three aggregates, one union)."""
    recent = [d.where(within("start_time", as_of, days=days)) for d in (pipes, migrations, statements)]
    return _method_costs(*recent, credits_per_hour, "day", ("pipe", "stream", "copy")).orderBy(F.desc("day"), "method")


def cost_monthly(pipes, migrations, statements, as_of, months=6, credits_per_hour=DEFAULT_CREDITS_PER_HOUR) -> DataFrame:
    recent = [d.where(within("start_time", as_of, months=months)) for d in (pipes, migrations, statements)]
    return _method_costs(*recent, credits_per_hour, "month", ("pipe", "stream", "copy")).orderBy(F.desc("month"), "method")


def cost_by_table(usage: DataFrame, pipes: DataFrame, as_of, days=30) -> DataFrame:
    """Usage per table, read from the copy text of each pipe.

    Usage is summed per pipe first, so the join sees one row per pipe.
    """
    per_pipe = usage.where(within("start_time", as_of, days=days)).groupBy("pipe_name").agg(
        F.sum("credits_used").alias("c"), F.sum("files_inserted").alias("f"), F.sum("bytes_inserted").alias("b"))
    targets = pipes.select("pipe_name", copy_target("definition").alias("target_table"))
    return per_pipe.join(targets, "pipe_name").groupBy("target_table").agg(
        rounded_sum("c").alias("total_credits"), total("f").alias("total_files"), _gb("b").alias("total_gb"),
        F.round(ratio(F.sum("c"), F.sum("f")), 6).alias("credits_per_file"),
    ).orderBy(F.desc("total_credits"), "target_table")


def unit_costs(usage: DataFrame, as_of, days=30) -> DataFrame:
    return usage.where(within("start_time", as_of, days=days)).groupBy("pipe_name").agg(
        rounded_sum("credits_used").alias("total_credits"), total("files_inserted").alias("total_files"),
        _gb("bytes_inserted").alias("total_gb"),
        F.round(ratio(F.sum("credits_used"), F.sum("files_inserted")), 6).alias("credits_per_file"),
        F.round(ratio(F.sum("credits_used"), F.sum("bytes_inserted").cast("double") / 1e9), 4).alias("credits_per_gb"),
    ).orderBy(F.desc("total_credits"), "pipe_name")


def stream_unit_costs(migrations: DataFrame, as_of, days=30, by="table") -> DataFrame:
    """Credits per million rows, by table or by day."""
    key = F.col("table_name") if by == "table" else trunc("day", "start_time").alias("day")
    return migrations.where(within("start_time", as_of, days=days)).groupBy(key).agg(
        rounded_sum("credits_used").alias("total_credits"), total("num_rows_migrated").alias("total_rows"),
        _gb("num_bytes_migrated").alias("total_gb"),
        F.round(ratio(F.sum("credits_used"), F.sum("num_rows_migrated").cast("double") / 1e6), 4)
        .alias("credits_per_million_rows"),
    )


def cost_anomalies(usage: DataFrame, as_of, days=14, threshold=0.5) -> DataFrame:
    """Days whose credits moved by more than `threshold` against the day before."""
    daily = usage.where(within("start_time", as_of, days=days)).groupBy(trunc("day", "start_time").alias("day")).agg(
        rounded_sum("credits_used").alias("credits"))
    # one row per day, so the unpartitioned window holds `days` rows
    lagged = daily.withColumn("prev_day_credits", F.lag("credits").over(Window.orderBy("day")))
    change = F.col("credits") - F.col("prev_day_credits")
    return lagged.where(
        F.col("prev_day_credits").isNotNull() & (ratio(F.abs(change), "prev_day_credits") > threshold)
    ).select(
        "day", "credits", "prev_day_credits", F.round(change, 6).alias("change"),
        F.round(ratio(change, "prev_day_credits") * 100, 1).alias("pct_change"),
    ).orderBy(F.desc("day"))


def warehouse_cost(statements: DataFrame, as_of, days=30, rates: dict | None = None) -> DataFrame:
    """Estimated credits by warehouse and day. The rate table is a literal map, not a join."""
    rates = rates or CREDITS_PER_HOUR
    table = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    rate = F.coalesce(table[F.col("warehouse_size")], F.lit(DEFAULT_CREDITS_PER_HOUR)).cast("double")
    return statements.where((F.col("query_type") == "COPY") & within("start_time", as_of, days=days)).groupBy(
        "warehouse_name", "warehouse_size", trunc("day", "start_time").alias("day")
    ).agg(rows("copy_operations"), F.sum("execution_time").alias("_ms")).select(
        "warehouse_name", "warehouse_size", "day", "copy_operations",
        F.round(F.col("_ms").cast("double") / 1000, 6).alias("total_execution_seconds"),
        F.round(F.col("_ms").cast("double") / MS_PER_HOUR * rate, 6).alias("estimated_credits"),
    ).orderBy(F.desc("day"), F.desc("estimated_credits"))


def file_size_advice(usage: DataFrame, as_of, days=7) -> DataFrame:
    per_file = ratio("bytes_inserted", "files_inserted")
    size = F.avg(per_file)
    return usage.where(within("start_time", as_of, days=days)).groupBy("pipe_name").agg(
        F.round(size / 1e6, 6).alias("avg_mb_per_file"), total("files_inserted").alias("total_files"),
        rounded_sum("credits_used").alias("total_credits"),
        F.when(size < 10000000, "SMALL FILES - Consider batching")
        .when(size < 100000000, "MODERATE - Acceptable")
        .otherwise("GOOD - Well-sized files").alias("recommendation"),
    ).orderBy("avg_mb_per_file")


def warehouse_use(statements: DataFrame, as_of, days=7) -> DataFrame:
    return statements.where((F.col("query_type") == "COPY") & within("start_time", as_of, days=days)).groupBy(
        "warehouse_name", "warehouse_size", "query_type"
    ).agg(
        rows("query_count"), F.round(F.avg("execution_time") / 1000, 6).alias("avg_seconds"),
        F.round(F.avg("total_elapsed_time") / 1000, 6).alias("avg_elapsed_seconds"),
        F.round(F.avg("bytes_scanned") / 1e9, 6).alias("avg_gb_scanned"),
        rounded_sum("credits_used_cloud_services").alias("total_credits"),
    ).orderBy("warehouse_name", "warehouse_size")


def short_jobs_on_large(statements: DataFrame, as_of, days=7, max_ms=60000, sizes=LARGE_SIZES) -> DataFrame:
    return statements.where(
        (F.col("query_type") == "COPY") & F.col("warehouse_size").isin(*sizes)
        & (F.col("execution_time") < max_ms) & within("start_time", as_of, days=days)
    ).select(
        "query_id", "warehouse_name", "warehouse_size",
        F.round(F.col("execution_time").cast("double") / 1000, 6).alias("seconds"),
        F.round(F.col("bytes_scanned").cast("double") / 1e9, 9).alias("gb_scanned"),
    ).orderBy("seconds", "query_id")


def warehouse_weekly(statements: DataFrame, as_of, weeks=4) -> DataFrame:
    return statements.where((F.col("query_type") == "COPY") & within("start_time", as_of, weeks=weeks)).groupBy(
        trunc("week", "start_time").alias("week"), "warehouse_name", "warehouse_size"
    ).agg(
        rows("copy_jobs"), F.round(F.avg("execution_time") / 1000, 6).alias("avg_seconds"),
        rounded_sum("credits_used_cloud_services").alias("total_credits"), _gb("bytes_scanned").alias("total_gb"),
        F.round(ratio(F.sum("bytes_scanned").cast("double") / 1e9, F.sum("credits_used_cloud_services")), 2)
        .alias("gb_per_credit"),
    ).orderBy(F.desc("week"), F.desc("total_credits"))


def scan_efficiency(statements: DataFrame, table: str, as_of, days=1) -> DataFrame:
    """One efficiency row for a table: statements, mean share of partitions read, GB."""
    hits = statements.where(
        F.col("query_text").ilike(f"%{table}%") & within("start_time", as_of, days=days) & (F.col("partitions_total") > 0))
    return hits.agg(
        F.lit(back(as_of).date()).alias("check_date"), F.lit(table).alias("table_name"), rows("query_count"),
        F.round(F.avg(ratio(F.col("partitions_scanned") * 100.0, "partitions_total")), 6).alias("avg_pct_scanned"),
        _gb("bytes_scanned").alias("total_gb_scanned"),
    )


def poor_pruning(statements: DataFrame, table: str, as_of, days=7, min_partitions=100, share=0.5) -> DataFrame:
    scanned = ratio("partitions_scanned", "partitions_total")
    return statements.where(
        F.col("query_text").ilike(f"%{table}%") & within("start_time", as_of, days=days)
        & (F.col("partitions_total") > min_partitions) & (scanned > share)
    ).select(
        "query_id", "query_text", F.round(F.col("bytes_scanned").cast("double") / 1e9, 9).alias("gb_scanned"),
        "partitions_scanned", "partitions_total", F.round(scanned * 100, 1).alias("pct_scanned"),
    ).orderBy(F.desc("gb_scanned"), "query_id")


# ---- row-stream migrations -------------------------------------------------------------


def migration_list(migrations: DataFrame, as_of, days=1) -> DataFrame:
    return migrations.where(within("start_time", as_of, days=days)).select(
        "database_name", "schema_name", "table_name", "start_time", "end_time",
        diff("second", "start_time", "end_time").alias("duration_seconds"),
        F.round("credits_used", 6).alias("credits_used"),
        F.round(F.col("num_bytes_migrated").cast("double") / 1e6, 6).alias("mb_migrated"), "num_rows_migrated",
    ).orderBy(F.desc("start_time"), "table_name")


def stream_throughput(migrations: DataFrame, as_of, days=7) -> DataFrame:
    return migrations.where(within("start_time", as_of, days=days)).groupBy(
        trunc("hour", "start_time").alias("hour")
    ).agg(
        rows("migration_count"), rounded_sum("credits_used").alias("hourly_credits"),
        total("num_rows_migrated").alias("rows_migrated"),
        F.round(F.sum("num_bytes_migrated").cast("double") / 1e6, 6).alias("mb_migrated"),
        exact_ratio(F.sum("num_rows_migrated"), 3600, 4).alias("rows_per_second"),
        exact_ratio(F.sum("num_bytes_migrated"), 3600 * 1000000, 6).alias("mb_per_second"),
    ).orderBy(F.desc("hour"))


def stream_table_totals(migrations: DataFrame, as_of, days=30) -> DataFrame:
    return migrations.where(within("start_time", as_of, days=days)).groupBy(
        "database_name", "schema_name", "table_name"
    ).agg(
        rows("migration_count"), rounded_sum("credits_used").alias("total_credits"),
        total("num_rows_migrated").alias("total_rows"), _gb("num_bytes_migrated").alias("total_gb"),
        F.max("end_time").alias("last_migration"),
    ).orderBy(F.desc("total_credits"), "table_name")


def long_migrations(migrations: DataFrame, as_of, minutes=5, days=7) -> DataFrame:
    duration = diff("minute", "start_time", "end_time")
    return migrations.where(within("start_time", as_of, days=days) & (duration > minutes)).select(
        "table_name", "start_time", "end_time", duration.alias("duration_minutes"), "num_rows_migrated",
        F.round(F.col("num_bytes_migrated").cast("double") / 1e6, 6).alias("mb_migrated"),
        F.round("credits_used", 6).alias("credits_used"),
    ).orderBy(F.desc("duration_minutes"), "start_time")


def no_stream_data(migrations: DataFrame, as_of, minutes=30) -> DataFrame:
    """One row when nothing has migrated for `minutes`, none otherwise (HAVING without GROUP BY)."""
    last = migrations.agg(F.max("end_time").alias("last_migration"))
    return last.withColumn("minutes_since_last", diff("minute", "last_migration", ntz(as_of))).where(
        F.col("minutes_since_last") > minutes)


def stream_cost_over(migrations: DataFrame, as_of, credits=100, days=1) -> DataFrame:
    return migrations.where(within("start_time", as_of, days=days)).groupBy(trunc("day", "start_time").alias("day")).agg(
        rounded_sum("credits_used").alias("daily_credits")).where(F.col("daily_credits") > credits)


def view_refresh_history(refreshes: DataFrame, as_of, days=30) -> DataFrame:
    """Materialized-view refreshes and credits per view and day."""
    return refreshes.where(within("start_time", as_of, days=days)).groupBy(
        "materialized_view_name", trunc("day", "start_time").alias("day")
    ).agg(rows("refresh_count"), rounded_sum("credits_used").alias("total_credits")).orderBy(
        F.desc("day"), "materialized_view_name")
