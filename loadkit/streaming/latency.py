"""Latency of arriving rows: per minute, hour and channel, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import rows
from ..functions.times import diff, trunc, within


def _seconds(source: str, arrived: str):
    return diff("second", source, arrived)


def latency_by(df: DataFrame, source: str, arrived: str, unit: str = "minute") -> DataFrame:
    """Rows and latency (mean, p95, max) per minute or hour of arrival.

    The percentile is exact: latencies are whole seconds, so its state is one counter per
    distinct second and merges before the shuffle.
    """
    latency = _seconds(source, arrived)
    return df.groupBy(trunc(unit, arrived).alias(unit)).agg(
        rows("row_count"), F.round(F.avg(latency), 6).alias("avg_latency_sec"),
        F.round(F.percentile(latency, 0.95), 6).alias("p95_latency_sec"), F.max(latency).alias("max_latency_sec"),
    ).orderBy(F.desc(unit))


def latency_by_channel(df: DataFrame, source: str, arrived: str, channel: str) -> DataFrame:
    latency = _seconds(source, arrived)
    return df.groupBy(channel).agg(
        rows("rows_ingested"), F.min(arrived).alias("first_insert"), F.max(arrived).alias("last_insert"),
        F.round(F.avg(latency), 6).alias("avg_latency_sec"), F.min(latency).alias("min_latency_sec"), F.max(latency).alias("max_latency_sec"),
    ).orderBy(channel)


def ingest_lag(df: DataFrame, source: str, arrived: str, as_of, minutes: int = 5) -> DataFrame:
    """Newest message time against newest arrival in the last minutes."""
    recent = df.where(within(arrived, as_of, minutes=minutes))
    a = recent.agg(F.max(source).alias("latest_source_time"), F.max(arrived).alias("latest_insert_time"), rows("recent_rows"))
    return a.withColumn("processing_lag_sec", diff("second", "latest_source_time", "latest_insert_time"))


def latency_stream(stream: DataFrame, source: str, arrived: str, delay: str = "10 minutes", minutes: int = 1) -> DataFrame:
    """The same per tumbling window over a stream; windows come out once the watermark passes them.

    The percentile is exact here too: its state is one counter per distinct second of an open window.
    """
    latency = _seconds(source, arrived)
    timed = stream.withColumn("_at", F.col(arrived).cast("timestamp")).withColumn("_latency", latency).withWatermark("_at", delay)
    return timed.groupBy(F.window("_at", f"{minutes} minutes")).agg(
        rows("row_count"), F.avg("_latency").alias("avg_latency_sec"), F.max("_latency").alias("max_latency_sec"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY _latency)").cast("bigint").alias("p95_latency_sec"),
    ).select(F.col("window.start").cast("timestamp_ntz").alias("minute"), "row_count", "avg_latency_sec", "p95_latency_sec", "max_latency_sec")


def dedupe_stream(stream: DataFrame, keys: list[str], event_time: str, delay: str = "1 hour") -> DataFrame:
    """First row per key while within the watermark."""
    timed = stream.withColumn("_at", F.col(event_time).cast("timestamp")).withWatermark("_at", delay)
    return timed.dropDuplicatesWithinWatermark(keys).drop("_at")
