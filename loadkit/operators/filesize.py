"""File-size reports over a stage listing (name, size, last_modified)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import pct, ratio, rows
from ..functions.text import path_part
from ..functions.times import back
from ..functions.windows import exact_percentile

# Upper limit in bytes, whether it belongs to the bucket, and name of each size bucket; the last is open.
SIZE_BUCKETS = (
    (1000000, False, "Under 1MB"), (10000000, True, "1-10MB"), (100000000, True, "10-100MB"), (250000000, True, "100-250MB (optimal)"),
    (500000000, True, "250-500MB"), (None, False, "Over 500MB"),
)
TINY_BUCKETS = (
    (100000, False, "Under 100KB (problem)"), (1000000, False, "100KB-1MB (suboptimal)"), (10000000, False, "1-10MB (acceptable)"),
    (100000000, False, "10-100MB (good)"), (250000000, False, "100-250MB (optimal)"), (None, False, "Over 250MB"),
)


def _bucket(size: Column, table, value) -> Column:
    out = F.lit(value(len(table) - 1, table[-1][2]))
    for i in range(len(table) - 2, -1, -1):
        limit, inside, name = table[i]
        out = F.when(size <= limit if inside else size < limit, F.lit(value(i, name))).otherwise(out)
    return out


def _by_bucket(listing: DataFrame, table, *aggs: Column) -> DataFrame:
    """Group by bucket rank and name; the rank sorts and is dropped."""
    size = F.col("size")
    return listing.groupBy(
        _bucket(size, table, lambda i, n: i).alias("_rank"), _bucket(size, table, lambda i, n: n).alias("size_bucket")
    ).agg(rows("file_count"), *aggs).orderBy("_rank").drop("_rank")


def size_distribution(listing: DataFrame) -> DataFrame:
    mb = 1e6
    return _by_bucket(
        listing, SIZE_BUCKETS, F.round(F.sum("size").cast("double") / 1e9, 2).alias("total_gb"),
        F.round(F.avg("size") / mb, 2).alias("avg_mb"), F.round(F.min("size").cast("double") / mb, 2).alias("min_mb"),
        F.round(F.max("size").cast("double") / mb, 2).alias("max_mb"),
    )


def tiny_file_report(listing: DataFrame) -> DataFrame:
    return _by_bucket(listing, TINY_BUCKETS, F.round(F.sum("size").cast("double") / 1e6, 2).alias("total_mb"))


def tiny_file_flags(listing: DataFrame, share=50.0, avg_mb=10.0) -> DataFrame:
    """Red flags: more than half of the files under 1 MB, or a small mean size."""
    a = listing.agg(
        rows("file_count"), F.count_if(F.col("size") < 1000000).alias("files_under_1mb"),
        F.count_if(F.col("size").between(1000000, 10000000)).alias("files_1_to_10mb"),
        F.count_if(F.col("size") > 100000000).alias("files_over_100mb"), (F.avg("size") / 1e6).alias("_avg"),
    )
    return a.select(
        "file_count", "files_under_1mb", "files_1_to_10mb", "files_over_100mb", F.round("_avg", 2).alias("avg_mb"),
        (ratio(F.col("files_under_1mb") * 100.0, "file_count") > share).alias("too_many_tiny"),
        (F.col("_avg") < avg_mb).alias("mean_too_small"),
    )


def file_stats(listing: DataFrame) -> DataFrame:
    size = F.col("size")
    mb = size.cast("double") / 1e6
    a = listing.agg(
        rows("total_files"), F.round(F.sum(size).cast("double") / 1e9, 2).alias("total_gb"), F.round(F.avg(mb), 2).alias("avg_mb"),
        F.round(F.min(mb), 2).alias("min_mb"), F.round(F.max(mb), 2).alias("max_mb"),
        F.count_if(mb < 10).alias("files_under_10mb"), F.count_if(mb.between(100, 250)).alias("files_optimal_range"),
        F.count_if(mb > 500).alias("files_over_500mb"),
    )
    median = exact_percentile(listing, [], "size", 0.5, "_m").select(F.round(F.col("_m") / 1e6, 2).alias("median_mb"))
    return _beside(a, median)


def _beside(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two one-row frames as one row, by stacking and folding."""
    columns = one.columns + other.columns
    return one.unionByName(other, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in columns])


def small_files(listing: DataFrame, below=10000000, top=100) -> DataFrame:
    """The smallest files: a top-k report."""
    return listing.where(F.col("size") < below).orderBy("size", "name").limit(top).select(
        F.col("name").alias("file_path"), F.round(F.col("size").cast("double") / 1e6, 2).alias("size_mb"))


def files_by_date(listing: DataFrame, year=3, month=4, day=5) -> DataFrame:
    return listing.groupBy(
        path_part("name", year).alias("year"), path_part("name", month).alias("month"), path_part("name", day).alias("day")
    ).agg(
        rows("file_count"), F.round(F.sum("size").cast("double") / 1e6, 2).alias("total_mb"),
        F.round(F.avg("size") / 1e6, 2).alias("avg_mb"),
    ).orderBy("year", "month", "day")


def size_snapshot(listing: DataFrame, stage: str, as_of) -> DataFrame:
    """One row for ops.file_size_history."""
    size = F.col("size")
    a = listing.agg(
        rows("file_count"), F.round(F.avg(size) / 1e6, 6).alias("avg_size_mb"),
        F.count_if(size < 10000000).alias("_u10"), F.count_if(size < 1000000).alias("_u1"),
        F.count_if(size.between(100000000, 250000000)).alias("_opt"),
    )
    median = exact_percentile(listing, [], "size", 0.5, "_m").select(F.round(F.col("_m") / 1e6, 6).alias("median_size_mb"))
    return _beside(a, median).select(
        F.lit(back(as_of).date()).alias("check_date"), F.lit(stage).alias("stage_name"), "file_count", "avg_size_mb",
        "median_size_mb", pct("_u10", "file_count", 6).alias("pct_under_10mb"), pct("_opt", "file_count", 6).alias("pct_optimal"),
        pct("_u1", "file_count", 6).alias("pct_under_1mb"),
    )


def degrading(history: DataFrame, column="pct_under_1mb", limit=50) -> DataFrame:
    return history.where(F.col(column) > limit).orderBy(F.desc("check_date"))
