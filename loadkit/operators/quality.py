"""Data-quality checks: each is one aggregation pass over the loaded rows.

A `loaded` frame is whatever the caller wants judged; `recent()` narrows it to one load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import pct, ratio, rows
from ..functions.text import is_email, is_phone, is_uuid
from ..functions.times import diff, ntz, within

# Score weights and grade limits.
SCORE_WEIGHTS = {"id": 25, "type": 20, "timestamp": 20, "valid_timestamp": 15, "unique": 20}
GRADES = ((95, "EXCELLENT"), (85, "GOOD"), (70, "ACCEPTABLE"))
OLDEST = "2020-01-01 00:00:00"
SUSPICIOUS_TOTAL = 1000000


def recent(df: DataFrame, as_of, loaded_at="_loaded_at", hours=1) -> DataFrame:
    return df.where(within(loaded_at, as_of, hours=hours))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(rows("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def null_rules(df: DataFrame, rules: dict[str, float]) -> DataFrame:
    """Null share per column against a limit in percent; limit 0 marks a required column.

    One aggregate computes all counts, then its single row is unpivoted.
    """
    counts = df.agg(rows("total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in rules])
    long = counts.unpivot(["total"], list(rules), "column_name", "null_count")
    limits = F.create_map(*[F.lit(x) for c, v in rules.items() for x in (c, float(v))])
    limit, share = limits[F.col("column_name")], ratio(F.col("null_count") * 100.0, "total")
    over = F.format_string("WARN - >%s%% null", limit.cast("int").cast("string"))
    return long.select(
        "column_name", "null_count", F.round(share, 2).alias("null_pct"),
        F.when((limit == 0) & (F.col("null_count") > 0), "FAIL - Required field")
        .when((limit > 0) & (share > limit), over).otherwise("PASS").alias("status"),
    )


def duplicate_keys(df: DataFrame, key: list[str], top=20) -> DataFrame:
    """The most repeated keys: a top-k report."""
    return df.groupBy(*key).agg(rows("occurrence_count")).where("occurrence_count > 1").orderBy(
        F.desc("occurrence_count"), *key).limit(top)


def uniqueness(df: DataFrame, key: str) -> DataFrame:
    counts = df.agg(rows("total_rows"), F.count_distinct(key).alias("unique_ids"))
    return counts.select(
        "total_rows", "unique_ids", (F.col("total_rows") - F.col("unique_ids")).alias("duplicate_count"),
        F.when(F.col("total_rows") == F.col("unique_ids"), "PASS").otherwise("FAIL - Duplicates found").alias("status"),
    )


def range_report(df: DataFrame, amount: str, quantity: str, large=SUSPICIOUS_TOTAL) -> DataFrame:
    return df.agg(
        rows("total_rows"), F.count_if(F.col(amount) < 0).alias("negative_totals"),
        F.count_if(F.col(amount) > large).alias("suspiciously_large"),
        F.count_if(F.col(quantity) <= 0).alias("invalid_quantities"),
        F.min(amount).alias("min_total"), F.max(amount).alias("max_total"), F.round(F.avg(amount), 4).alias("avg_total"),
    )


def ts_range_report(df: DataFrame, ts: str, as_of, oldest=OLDEST) -> DataFrame:
    return df.agg(
        rows("total_rows"), F.count_if(F.col(ts) < ntz(oldest)).alias("too_old"),
        F.count_if(F.col(ts) > ntz(as_of)).alias("future_dates"),
        F.min(ts).alias("earliest"), F.max(ts).alias("latest"),
    )


def format_checks(df: DataFrame, checks: dict[str, tuple[str, str]]) -> DataFrame:
    """checks: name -> (column, kind), kind one of email, phone, uuid, hash64. NULLs are not judged."""
    kinds = {
        "email": is_email, "phone": is_phone, "uuid": is_uuid,
        "hash64": lambda c: F.length(F.col(c)) == 64,
    }
    counts = df.agg(*[
        agg for name, (column, kind) in checks.items() for agg in (
            F.count(column).alias(f"{name}_total"), F.count_if(kinds[kind](F.col(column) if kind != "hash64" else column)).alias(f"{name}_valid"))
    ])
    per = [F.struct(F.lit(n).alias("check_name"), F.col(f"{n}_total").alias("total"), F.col(f"{n}_valid").alias("valid_count"),
                    (F.col(f"{n}_total") - F.col(f"{n}_valid")).alias("invalid_count")) for n in checks]
    return counts.select(F.explode(F.array(*per)).alias("c")).select("c.*")


def loose_formats(df: DataFrame, email: str, phone: str, digest: str) -> DataFrame:
    """Cheap shape checks: `x@y.z`, 10 or 11 characters, 64 characters."""
    return df.agg(
        rows("total_rows"), F.count_if((F.length(email) > 0) & F.col(email).like("%@%.%")).alias("valid_emails"),
        F.count_if(F.length(phone).isin(10, 11)).alias("valid_phones"),
        F.count_if(F.length(digest) == 64).alias("valid_hashes"),
    )


def _keyed_counts(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """One row per child key with its row count and whether a parent has it.

    Counting before the join means a key with a third of all rows joins as one row.
    """
    per_key = child.groupBy(F.col(child_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    known = parent.select(F.col(parent_key).alias("_k")).where("_k is not null").distinct().withColumn("_hit", F.lit(True))
    return per_key.join(known, "_k", "left")


def orphan_count(child, parent, child_key, parent_key) -> DataFrame:
    counts = _keyed_counts(child, parent, child_key, parent_key)
    return counts.where("_hit is null").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows"))


def referential(child, parent, child_key, parent_key) -> DataFrame:
    """Rows and share of VALID and ORPHAN children. Shares come from the same small frame."""
    status = F.when(F.col("_hit"), "VALID").otherwise("ORPHAN")
    by_status = _keyed_counts(child, parent, child_key, parent_key).groupBy(status.alias("key_status")).agg(
        F.sum("_n").alias("row_count"))
    return with_share(by_status, "row_count")


def with_share(grouped: DataFrame, count: str, out="pct") -> DataFrame:
    """Share of each group in the total: a window over the aggregated frame."""
    from pyspark.sql import Window

    everything = Window.partitionBy(F.lit(1))
    return grouped.withColumn(out, pct(F.col(count), F.sum(count).over(everything)))


def value_frequency(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(rows("row_count")).orderBy(F.desc("row_count"), column)


def allowed_values(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Frequency of each value with VALID / INVALID, compared in lower case.

    The allowed set is a literal list, so values are judged after counting and without a join.
    """
    ok = F.lower(F.col(column)).isin(*[a.lower() for a in allowed])
    return value_frequency(df, column).withColumn("validation", F.when(ok, "VALID").otherwise("INVALID"))


def batch_zscore(df: DataFrame, column: str, in_batch: Column, in_history: Column) -> DataFrame:
    """Mean of the batch against history, in standard deviations: both from one scan."""
    stats = df.agg(
        F.avg(F.when(in_batch, F.col(column))).alias("current_avg"),
        F.avg(F.when(in_history, F.col(column))).alias("historical_avg"),
        F.stddev_samp(F.when(in_history, F.col(column))).alias("_dev"),
    )
    z = ratio(F.abs(F.col("current_avg") - F.col("historical_avg")), "_dev")
    return stats.select(
        F.round("current_avg", 4).alias("current_avg"), F.round("historical_avg", 4).alias("historical_avg"),
        F.round(z, 6).alias("z_score"),
        F.when(z > 3, "ANOMALY - >3 std devs").when(z > 2, "WARN - >2 std devs").otherwise("NORMAL").alias("status"),
    )


def quality_report(df: DataFrame, table: str, as_of, key="event_id", kind="event_type", ts="event_timestamp", oldest=OLDEST) -> DataFrame:
    a = df.agg(
        rows("total_rows"), F.count(key).alias("_k"), F.count(kind).alias("_t"), F.count(ts).alias("_ts"),
        F.count_distinct(key).alias("unique_event_ids"),
        F.count_if(F.col(ts) > ntz(as_of)).alias("future_timestamps"),
        F.count_if(F.col(ts) < ntz(oldest)).alias("ancient_timestamps"), F.max(ts).alias("latest_event"),
    )
    return a.select(
        F.lit(table).alias("table_name"), ntz(as_of).alias("check_time"), "total_rows",
        pct("_k", "total_rows").alias("event_id_completeness"), pct("_t", "total_rows").alias("event_type_completeness"),
        pct("_ts", "total_rows").alias("timestamp_completeness"), "unique_event_ids",
        (F.col("total_rows") - F.col("unique_event_ids")).alias("duplicate_count"),
        "future_timestamps", "ancient_timestamps", "latest_event",
        diff("minute", "latest_event", ntz(as_of)).alias("minutes_behind"),
    )


def quality_score(df: DataFrame, as_of, key="event_id", kind="event_type", ts="event_timestamp") -> DataFrame:
    w = SCORE_WEIGHTS
    a = df.agg(
        rows("n"), F.count(key).alias("i"), F.count(kind).alias("t"), F.count(ts).alias("s"),
        F.count_if(F.col(ts) <= ntz(as_of)).alias("v"), F.count_distinct(key).alias("u"),
    )
    score = (
        ratio("i", "n") * w["id"] + ratio("t", "n") * w["type"] + ratio("s", "n") * w["timestamp"]
        + ratio("v", "n") * w["valid_timestamp"] + ratio("u", "n") * w["unique"]
    )
    grade = F.lit("POOR")
    for limit, name in reversed(GRADES):
        grade = F.when(F.col("quality_score") >= limit, name).otherwise(grade)
    return a.select(F.round(score, 1).alias("quality_score")).withColumn("quality_grade", grade)


def run_quality_checks(df: DataFrame, key: str, required: list[str], ts: str, as_of) -> DataFrame:
    """(check_name, result, status) rows for one table, from a single aggregate."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required]
    a = df.agg(rows("row_count"), F.count_distinct(key).alias("keys"), F.count_if(F.col(ts) > ntz(as_of)).alias("future"), *nulls)

    def check(name, value, good):
        return F.struct(F.lit(name).alias("check_name"), value.cast("string").alias("result"),
                        F.when(good, "PASS").otherwise("FAIL").alias("status"))

    checks = [check("row_count", F.col("row_count"), F.col("row_count") > 0),
              check("duplicate_keys", F.col("row_count") - F.col("keys"), F.col("row_count") == F.col("keys")),
              check("future_timestamps", F.col("future"), F.col("future") == 0)]
    checks += [check(f"null_{c}", F.col(f"null_{c}"), F.col(f"null_{c}") == 0) for c in required]
    return a.select(F.explode(F.array(*checks)).alias("c")).select("c.*")
