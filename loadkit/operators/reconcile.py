"""Reconciliation: counts, duplicates, checksums and row deltas between two sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.hashing import checksum, row_hash, word_sum
from ..functions.numbers import pct, rows, total
from ..functions.times import ntz, within


def _one_row(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row frames side by side: tagged, stacked and folded, not cross-joined."""
    lcols, rcols = left.columns, right.columns
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in lcols + rcols])


def reconcile_counts(staged: DataFrame, loaded: DataFrame) -> DataFrame:
    pair = _one_row(staged.agg(rows("staged_rows")), loaded.agg(rows("loaded_rows")))
    return pair.select(
        "staged_rows", "loaded_rows", (F.col("staged_rows") - F.col("loaded_rows")).alias("difference"),
        F.when(F.col("staged_rows") == F.col("loaded_rows"), "PASS").otherwise("FAIL").alias("status"),
    )


def reconcile_history(hist: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows the history reports as loaded against rows in the table."""
    stats = hist.agg(total("row_count").alias("reported_loaded"), total("row_parsed").alias("reported_parsed"))
    pair = _one_row(stats, loaded.agg(rows("actual_rows")))
    gap = F.col("reported_loaded") - F.col("actual_rows")
    return pair.select(
        "reported_loaded", "reported_parsed", (F.col("reported_parsed") - F.col("reported_loaded")).alias("reported_errors"),
        "actual_rows", gap.alias("discrepancy"),
        F.when(gap == 0, "PASS").otherwise("FAIL - Check for deletes or duplicates").alias("status"),
    )


def reconcile_files(expected: DataFrame, hist: DataFrame) -> DataFrame:
    """expected(file_name, expected_rows) against the latest load of each file."""
    latest = hist.groupBy("file_name").agg(F.max_by("row_count", "last_load_time").alias("loaded"))
    actual = F.coalesce("loaded", F.lit(0))
    return expected.join(latest, "file_name", "left").select(
        "file_name", "expected_rows", actual.alias("actual_rows"), (F.col("expected_rows") - actual).alias("difference"),
        F.when(F.col("expected_rows") == actual, "PASS").when(F.col("loaded").isNull(), "FAIL - File not loaded")
        .otherwise("FAIL - Row count mismatch").alias("status"),
    )


def reconcile_manifest(manifest: DataFrame, hist: DataFrame) -> DataFrame:
    """Manifest rows against loads whose file name is contained in the manifest's name.

    Containment as an equi-join: a loaded name is known by its last 1, 2, 4, 8 ... characters,
    the most that it has, and a manifest's name yields its pieces of just those lengths. Pieces
    that meet are verified on the whole loaded name. However many lengths loaded names have,
    a manifest's name yields no more pieces than a few times its length.
    """
    loads = hist.groupBy("file_name").agg(F.max_by("row_count", "last_load_time").alias("row_count"))
    n = F.length("file_name")
    loads = loads.withColumn("_size", F.when(n == 0, 0).otherwise(F.expr("shiftleft(1, length(bin(length(file_name))) - 1)")))
    sizes = loads.agg(F.collect_set("_size").alias("_sizes")).scalar()
    name = F.col("file_name")

    def cut(size: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(name) - size + 1)
        return F.when(F.length(name) >= size, F.transform(starts, lambda p: F.substring(name, p, size))).otherwise(F.array().cast("array<string>"))

    parts = F.array_distinct(F.flatten(F.transform(F.col("_sizes"), cut)))
    pieces = manifest.withColumn("_sizes", sizes).withColumn("_piece", F.explode(parts))
    known = loads.select(F.expr("right(file_name, _size)").alias("_piece"), F.col("file_name").alias("_loaded"), "row_count")
    found = pieces.join(known, "_piece").where(F.contains(name, F.col("_loaded")))
    keys = ["file_name", "expected_rows"]
    hits = found.groupBy(*keys).agg(F.max("row_count").alias("_hit"))
    actual = F.coalesce("_hit", F.lit(0))
    return manifest.select(*keys).join(hits, keys, "left").select(
        *keys, actual.alias("actual_rows"), F.when(F.col("expected_rows") == actual, "PASS").otherwise("FAIL").alias("status"))


def daily_counts(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("event_date")).agg(rows("row_count")).orderBy("event_date")


def daily_deviation(df: DataFrame, ts: str, tolerance=0.2) -> DataFrame:
    """Each day against the mean of the up to seven days before it."""
    daily = df.groupBy(F.to_date(ts).alias("event_date")).agg(rows("row_count"))
    # one row per day: the unpartitioned window holds days, not events
    week = Window.orderBy("event_date").rowsBetween(-7, -1)
    expected = F.col("_expected")
    off = (F.col("row_count") - expected) / expected
    return daily.withColumn("_expected", F.avg("row_count").over(week)).select(
        "event_date", "row_count", F.round(expected, 0).alias("expected_rows"), F.round(off * 100, 1).alias("pct_diff"),
        F.when(F.abs(off) < tolerance, "PASS").otherwise("WARN - >20% deviation from expected").alias("status"),
    ).orderBy(F.desc("event_date"))


def missing_days(df: DataFrame, ts: str, first, last) -> DataFrame:
    """Every day of the range with its row count, zero where nothing arrived."""
    spark = df.sparkSession
    calendar = spark.sql(f"SELECT explode(sequence(date '{first}', date '{last}')) AS event_date")
    counts = df.groupBy(F.to_date(ts).alias("event_date")).agg(rows("row_count"))
    filled = F.coalesce("row_count", F.lit(0))
    return calendar.join(counts, "event_date", "left").select(
        "event_date", filled.alias("row_count"), (filled == 0).alias("is_gap"))


def duplicates(df: DataFrame, key: str, top: int | None = 100) -> DataFrame:
    """Repeated keys: the top of the list, or all of them with top=None."""
    repeated = df.groupBy(key).agg(rows("occurrence_count")).where("occurrence_count > 1")
    return repeated.orderBy(F.desc("occurrence_count"), key).limit(top) if top else repeated


def duplicate_summary(df: DataFrame, key: str) -> DataFrame:
    a = df.agg(rows("total_rows"), F.count_distinct(key).alias("unique_ids"))
    extra = F.col("total_rows") - F.col("unique_ids")
    return a.select("total_rows", "unique_ids", extra.alias("duplicate_rows"), pct(extra, "total_rows").alias("duplicate_pct"))


def reconcile_load(df: DataFrame, expected: int) -> DataFrame:
    """(metric, value, status) for an expected row count."""
    value = F.col("value")
    return df.agg(rows("value")).select(
        F.lit("row_count").alias("metric"), "value",
        F.when(value == expected, "PASS").when(value > expected, "WARN - More rows than expected")
        .otherwise("FAIL - Missing rows").alias("status"),
    )


def reconciliation_log(df: DataFrame, table: str, expected: int, as_of) -> DataFrame:
    """The log row of one check, ready to append to ops.reconciliation_log."""
    n = F.col("actual_rows")
    return df.agg(rows("actual_rows")).select(
        F.md5(F.concat_ws("|", F.lit(table), F.lit(str(as_of)))).alias("reconciliation_id"), ntz(as_of).alias("check_time"),
        F.lit(table).alias("table_name"), F.lit(expected).cast("bigint").alias("expected_rows"), "actual_rows",
        (F.lit(expected) - n).alias("difference"), F.when(n == expected, "PASS").otherwise("FAIL").alias("status"),
        F.lit(None).cast("string").alias("notes"),
    )


# ---- checksums -------------------------------------------------------------------------


def row_hashes(df: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    return df.select(*key, row_hash(columns).alias("row_hash"))


def batch_checksum(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Row count and order-free checksum of a whole batch, or of each group of `by`.

    The checksum merges, so neither a table nor one hot group is gathered or sorted.
    """
    hashed = df.select(*by, row_hash(columns).alias("_h"))
    return hashed.groupBy(*by).agg(rows("row_count"), checksum(F.col("_h")).alias("batch_checksum"))


def numeric_sums(df: DataFrame, key: str, sums: dict[str, str]) -> DataFrame:
    """Count, sum of the key's hashes (60 bits of its MD5, as text) and plain sums of numeric columns (NULL as 0)."""
    return df.agg(
        rows("row_count"), word_sum(key).cast("string").alias("id_checksum"),
        *[F.round(F.sum(F.coalesce(F.col(c), F.lit(0))), 2).alias(name) for name, c in sums.items()],
    )


def numeric_checksum(df: DataFrame, column: str, expected_rows: int, expected_total: float) -> DataFrame:
    """Loaded count and total against expected values (compared in cents)."""
    a = df.agg(rows("loaded_rows"), F.round(F.sum(F.coalesce(F.col(column), F.lit(0))), 2).alias("loaded_total"))
    good = (F.col("loaded_rows") == expected_rows) & (F.col("loaded_total") == F.round(F.lit(float(expected_total)), 2))
    return a.select(
        "loaded_rows", F.lit(expected_rows).cast("bigint").alias("expected_rows"), "loaded_total",
        F.lit(float(expected_total)).alias("expected_total"), F.when(good, "PASS").otherwise("FAIL").alias("status"),
    )


def delta_compare(source: DataFrame, target: DataFrame, key: str, columns: list[str], all_rows=False) -> DataFrame:
    """Source rows against the target by key and row hash: MATCH / NEW / MISMATCH.

    Both target sides are distinct, so a repeated key never multiplies rows, and the
    comparison is null-safe.
    """
    s = source.select(key, row_hash(columns).alias("source_hash"))
    t = target.select(key, row_hash(columns).alias("target_hash"))
    per_key = t.groupBy(key).agg(F.min("target_hash").alias("target_hash"), F.lit(True).alias("_key"))
    same = t.select(key, F.col("target_hash").alias("source_hash")).distinct().withColumn("_same", F.lit(True))
    joined = s.join(per_key, key, "left").join(same, [key, "source_hash"], "left")
    out = joined.select(
        key, "source_hash", F.when(F.col("_same"), F.col("source_hash")).otherwise(F.col("target_hash")).alias("target_hash"),
        F.when(F.col("_same"), "MATCH").when(F.col("_key").isNull(), "NEW - Not in target").otherwise("MISMATCH").alias("status"),
    )
    return out if all_rows else out.where("status <> 'MATCH'")


def validate_checksum(df: DataFrame, columns: list[str], expected: str, table: str, batch: str, as_of) -> DataFrame:
    """Log row of a checksum check: computed beside expected, PASS or FAIL."""
    return batch_checksum(df, columns).select(
        F.md5(F.concat_ws("|", F.lit(table), F.lit(batch), F.lit(str(as_of)))).alias("check_id"),
        ntz(as_of).alias("check_time"), F.lit(table).alias("table_name"), F.lit(batch).alias("load_batch"),
        F.lit(expected).alias("expected_checksum"), F.col("batch_checksum").alias("computed_checksum"), "row_count",
        F.when(F.col("batch_checksum") == expected, "PASS").otherwise("FAIL").alias("status"),
    )


def log_since(log: DataFrame, as_of, days=7, time="check_time") -> DataFrame:
    return log.where(within(time, as_of, days=days)).orderBy(F.desc(time))


def stable_sample(df: DataFrame, key: str, percent=1) -> DataFrame:
    """A sample decided by the key's hash: the same rows on every run and on both sides."""
    return df.where(F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(100)) < percent)


def sample_checksum(df: DataFrame, key: str, columns: list[str], percent=1) -> DataFrame:
    out = batch_checksum(stable_sample(df, key, percent), columns)
    return out.select(F.col("row_count").alias("sample_size"), F.col("batch_checksum").alias("sample_checksum"))


# ---- merge diagnostics -----------------------------------------------------------------


def not_newer(staged: DataFrame, target: DataFrame, key: str, ts: str) -> DataFrame:
    """Staged rows that a newest-wins merge would ignore, with both times."""
    t = target.select(key, F.col(ts).alias("target_updated_at"))
    return staged.select(key, F.col(ts).alias("staged_updated_at")).join(t, key).where(
        "staged_updated_at <= target_updated_at")

