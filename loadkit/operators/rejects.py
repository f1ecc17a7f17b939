"""Rejected records: capture, reports, retry, expiry and the dead letter queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import pct, rows
from ..functions.times import ntz, older, parse_timestamp, trunc, within
from . import merge as M

PENDING, RESOLVED, PERMANENT = "PENDING", "RESOLVED", "PERMANENT_FAILURE"


def capture_rejects(errors: DataFrame, table: str, as_of) -> DataFrame:
    """ops.rejected_records rows from validation errors. The id is a hash of where the record was."""
    return errors.where("error is not null").select(
        F.md5(F.concat_ws("|", F.lit(table), "file", F.col("line").cast("string"), F.lit(str(as_of)))).alias("rejection_id"),
        ntz(as_of).alias("rejection_time"), F.lit(table).alias("target_table"), F.col("file").alias("source_file"),
        F.col("line").alias("source_line"), F.col("error").alias("error_message"), F.col("column_name").alias("error_column"),
        F.col("rejected_record").alias("rejected_data"), F.lit(PENDING).alias("retry_status"), F.lit(0).alias("retry_count"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
    )


def classify_rejects(df: DataFrame, rules: list[tuple[Column, str]], out="error_message") -> DataFrame:
    """Rows failing any rule, with the first failed rule's message. A rule is (is bad, message)."""
    reason = F.coalesce(*[F.when(bad, F.lit(text)) for bad, text in rules])
    return df.withColumn(out, reason).where(F.col(out).isNotNull())


def rejects_by_error(rejects: DataFrame, as_of, days=7) -> DataFrame:
    return rejects.where(within("rejection_time", as_of, days=days)).groupBy("error_message").agg(
        rows("occurrence_count"), F.min("rejection_time").alias("first_seen"), F.max("rejection_time").alias("last_seen"),
    ).orderBy(F.desc("occurrence_count"), "error_message")


def rejects_by_file(rejects: DataFrame, as_of, days=1) -> DataFrame:
    """Errors per file with the list of distinct messages.

    Counted per (file, message) first: the list sees each message once, and messages come
    from a fixed set of the loader.
    """
    recent = rejects.where(within("rejection_time", as_of, days=days))
    pairs = recent.groupBy("source_file", "error_message").agg(rows("_n"))
    return pairs.groupBy("source_file").agg(
        F.sum("_n").alias("error_count"), F.array_join(F.array_sort(F.collect_list("error_message")), ", ").alias("error_types"),
    ).orderBy(F.desc("error_count"), "source_file")


def rejects_by_column(rejects: DataFrame) -> DataFrame:
    return rejects.where("error_column is not null").groupBy("error_column", "error_message").agg(rows("row_count")).orderBy(F.desc("row_count"))


def rejects_hourly(rejects: DataFrame, as_of, days=7) -> DataFrame:
    return rejects.where(within("rejection_time", as_of, days=days)).groupBy(trunc("hour", "rejection_time").alias("hour")).agg(
        rows("rejected_count")).orderBy("hour")


def _fixable(fixed: Column) -> Column:
    return (F.col("retry_status") == PENDING) & F.col("rejected_data").isNotNull() & fixed.isNotNull()


def fixed_timestamp(field="$.timestamp", fmt="MM/DD/YYYY") -> Column:
    """The reject's time read with another format, when its message speaks of timestamps."""
    text = F.get_json_object("rejected_data", field)
    return F.when(F.lower("error_message").like("%timestamp%"), parse_timestamp(text, fmt))


def retry_rejects(rejects: DataFrame, fixed: Column, as_of, columns: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows to insert, rejects with the fixed ones RESOLVED). Both use the same condition."""
    hit = _fixable(fixed)
    rows_ = rejects.where(hit).select(*[c.alias(n) for n, c in columns.items()])
    updated = M.update_where(rejects, {"retry_status": F.lit(RESOLVED), "resolved_at": ntz(as_of)}, hit)
    return rows_, updated


def expire_rejects(rejects: DataFrame, as_of, days=7) -> DataFrame:
    """Pending rejects older than `days` fail for good."""
    old = (F.col("retry_status") == PENDING) & older("rejection_time", as_of, days=days)
    return M.update_where(rejects, {"retry_status": F.lit(PERMANENT), "retry_count": F.col("retry_count") + 1}, old)


def to_dead_letters(rejects: DataFrame, queue: DataFrame | None, as_of) -> DataFrame:
    """Permanent failures not yet in the queue; an anti join, safe against NULL ids there."""
    lost = rejects.where(F.col("retry_status") == PERMANENT)
    if queue is not None:
        lost = lost.join(queue.select(F.col("original_rejection_id").alias("rejection_id")), "rejection_id", "left_anti")
    return lost.select(
        F.md5(F.concat(F.lit("dlq|"), F.col("rejection_id").cast("string"))).alias("dlq_id"), F.col("rejection_id").alias("original_rejection_id"),
        "target_table", "source_file", "error_message", "rejected_data", ntz(as_of).alias("moved_at"), F.lit(None).cast("string").alias("notes"),
    )


def reject_report(rejects: DataFrame, as_of, days=30) -> DataFrame:
    return rejects.where(within("rejection_time", as_of, days=days)).groupBy(
        trunc("day", "rejection_time").alias("day"), "target_table", "retry_status"
    ).agg(rows("row_count")).orderBy(F.desc("day"), "target_table")


def resolution_rate(rejects: DataFrame) -> DataFrame:
    status = F.col("retry_status")
    return rejects.groupBy(trunc("week", "rejection_time").alias("week")).agg(
        rows("total_rejected"), F.count_if(status == RESOLVED).alias("resolved"),
        F.count_if(status == PERMANENT).alias("permanent_failures"), F.count_if(status == PENDING).alias("pending"),
    ).withColumn("resolution_rate_pct", pct("resolved", "total_rejected", 1)).orderBy(F.desc("week"))


def split_bad_rows(df: DataFrame, casts: dict[str, str], row_id: str) -> tuple[DataFrame, DataFrame]:
    """Row-insert error split: (good typed rows, (row, column, error) of the bad ones)."""
    typed = df.select(
        row_id, *[F.col(c).try_cast(t).alias(c) for c, t in casts.items()],
        F.filter(F.array(*[F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in casts.items()]),
                 lambda x: x.isNotNull()).alias("_bad"))
    good = typed.where(F.size("_bad") == 0).drop("_bad")
    bad = typed.where(F.size("_bad") > 0).select(row_id, F.explode("_bad").alias("column_name")).withColumn(
        "error", F.concat(F.lit("not recognized: "), F.col("column_name")))
    return good, bad


# ---- recovery --------------------------------------------------------------------------------


def retry_failed_loads(spark, table, stage, fmt, columns, as_of, hours=24, on_error="CONTINUE", **kw) -> tuple[DataFrame, DataFrame]:
    """Load again the files that failed lately. Returns (report, recovery-log row)."""
    from . import copy as C, ledger
    from .history import FAILED, failed_files

    hist = ledger.history(table)
    names = [r["file_name"] for r in failed_files(hist, as_of, days=max(1, -(-hours // 24)), statuses=(FAILED,)).select("file_name").distinct().collect()]
    if not names:
        return ledger.load_report(hist.where("false")), recovery_row(table, [], as_of, hist.where("false"))
    report = C.copy_into(spark, table, stage, fmt, columns, as_of, files=names, force=True, on_error=on_error, **kw)
    return report, recovery_row(table, names, as_of, report.withColumnRenamed("rows_loaded", "row_count"))


def recovery_row(table, names, as_of, loaded: DataFrame) -> DataFrame:
    name = table.path.rsplit("/", 1)[-1]
    n = F.coalesce(F.sum("row_count"), F.lit(0))
    return loaded.agg(
        F.md5(F.concat_ws("|", F.lit(name), F.lit(str(as_of)))).alias("recovery_id"), F.lit(name).alias("table_name"),
        F.array(*[F.lit(x) for x in sorted(names)]).cast("array<string>").alias("files"), ntz(as_of).alias("attempted_at"), ntz(as_of).alias("completed_at"),
        n.alias("rows_recovered"), F.when(n > 0, "COMPLETED").otherwise("NOTHING TO DO").alias("status"), F.lit(None).cast("string").alias("notes"),
    )


def reload_overlap(staged: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Counts that decide whether a reload may be inserted: rows, unique ids, repeats, already there.

    One row per key meets the target, however often a key was staged.
    """
    per_key = staged.groupBy(key).agg(rows("_n"))
    known = target.select(key).distinct().withColumn("_hit", F.lit(True))
    return per_key.join(known, key, "left").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("staged_rows"), F.count(key).alias("unique_ids"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count(key)).alias("duplicates_in_staged"),
        F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_n"))), F.lit(0)).alias("already_exists"),
    )


def staged_duplicates(staged: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Staged ids that the target has already, as ordered rows: a list of any length."""
    return staged.select(key).distinct().join(target.select(key).distinct(), key, "left_semi").orderBy(key)


def staged_quality(df: DataFrame, file: str, required: list[str], checks: dict[str, Column]) -> DataFrame:
    """Per file: rows, NULLs of required fields, rows meeting each bad-value check."""
    return df.groupBy(file).agg(
        rows("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required],
        *[F.count_if(bad).alias(n) for n, bad in checks.items()],
    )


def validate_before_load(listing: DataFrame, report: DataFrame, max_skip_pct=5.0) -> DataFrame:
    """Gate rows (check_name, status, details): files exist, rows readable, skip rate."""
    files = listing.agg(rows("n")).select(
        F.lit("files_exist").alias("check_name"), F.when(F.col("n") > 0, "PASS").otherwise("FAIL").alias("status"),
        F.concat(F.col("n").cast("string"), F.lit(" files")).alias("details"))
    a = report.agg(F.coalesce(F.sum("rows_parsed"), F.lit(0)).alias("p"), F.coalesce(F.sum("errors_seen"), F.lit(0)).alias("e"))
    share = F.coalesce(pct("e", "p"), F.lit(0.0))
    checks = F.array(
        F.struct(F.lit("file_readable").alias("check_name"), F.when(F.col("p") > F.col("e"), "PASS").otherwise("FAIL").alias("status"),
                 F.concat((F.col("p") - F.col("e")).cast("string"), F.lit(" rows readable")).alias("details")),
        F.struct(F.lit("skip_rate").alias("check_name"), F.when(share > max_skip_pct, "FAIL").otherwise("PASS").alias("status"),
                 F.concat(share.cast("string"), F.lit("% bad rows")).alias("details")))
    return files.unionByName(a.select(F.explode(checks).alias("c")).select("c.*"))


def gate(checks: DataFrame) -> None:
    """Raise when a check failed."""
    failed = checks.where("status = 'FAIL'").select("check_name", "details").collect()
    if failed:
        raise RuntimeError("; ".join(f"{r['check_name']}: {r['details']}" for r in failed))
