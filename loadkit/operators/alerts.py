"""Alert rules as conditions over DataFrames, evaluated together and logged."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import ratio
from ..functions.times import ntz, within
from .health import parse_status

# Rule limits.
LIMITS = {
    "error_pct": 5, "daily_credits": 100, "rejects_per_hour": 100, "pending_files": 1000, "quiet_hours": 4, "skip_pct": 5,
}
QUOTA_STEPS = (75, 90, 100)


@dataclass(frozen=True)
class Rule:
    """`measure` is a one-row frame with a column `value`; the alert fires when `fires` holds."""

    name: str
    measure: DataFrame
    fires: Column
    severity: str = "error"


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("double").alias("value"))


def copy_failures(hist: DataFrame, as_of, hours=1) -> Rule:
    failed = hist.where(within("last_load_time", as_of, hours=hours) & (F.col("status") == "LOAD_FAILED"))
    return Rule("copy_failures", _count(failed), F.col("value") > 0)


def pipe_stalled(status: DataFrame) -> Rule:
    bad = parse_status(status).where((F.col("state") == "STALLED") | (F.col("pending_files") > LIMITS["pending_files"]))
    return Rule("pipe_stalled", _count(bad), F.col("value") > 0)


def no_recent_data(df: DataFrame, ts: str, as_of, hours=LIMITS["quiet_hours"]) -> Rule:
    lag = df.agg(((F.unix_seconds(ntz(as_of).cast("timestamp")) - F.unix_seconds(F.max(ts).cast("timestamp"))) / 3600.0).alias("value"))
    return Rule("no_recent_data", lag, F.col("value") > hours)


def _skip_share(hist: DataFrame, as_of, hours) -> DataFrame:
    recent = hist.where(within("last_load_time", as_of, hours=hours))
    return recent.agg(F.sum("row_parsed").alias("p"), F.sum("row_count").alias("c")).select(
        F.round(ratio((F.col("p") - F.col("c")) * 100.0, "p"), 6).alias("value"))


def error_rate(hist: DataFrame, as_of, hours=1, limit=LIMITS["error_pct"]) -> Rule:
    return Rule("error_rate", _skip_share(hist, as_of, hours), F.col("value") > limit)


def skip_rate(hist: DataFrame, as_of, hours=24, limit=LIMITS["skip_pct"]) -> Rule:
    return Rule("skip_rate", _skip_share(hist, as_of, hours), F.col("value") > limit)


def daily_cost(usage: list[DataFrame], as_of, days=1, limit=LIMITS["daily_credits"]) -> Rule:
    spent = usage[0].select("start_time", "credits_used")
    for more in usage[1:]:
        spent = spent.unionByName(more.select("start_time", "credits_used"))
    return Rule("daily_cost", spent.where(within("start_time", as_of, days=days)).agg(
        F.round(F.sum("credits_used"), 6).alias("value")), F.col("value") > limit)


def reject_rate(rejects: DataFrame, as_of, hours=1, limit=LIMITS["rejects_per_hour"]) -> Rule:
    return Rule("reject_rate", _count(rejects.where(within("rejection_time", as_of, hours=hours))), F.col("value") > limit)


def duplicate_keys(df: DataFrame, key: str) -> Rule:
    extra = df.agg((F.count(F.lit(1)) - F.count_distinct(key)).cast("double").alias("value"))
    return Rule("duplicate_keys", extra, F.col("value") > 0)


def schema_drift(diff: DataFrame) -> Rule:
    changed = diff.where("drift_status <> 'OK' and drift_status <> 'NULLABLE_CHANGE'")
    return Rule("schema_drift", _count(changed), F.col("value") > 0)


def stale_source(freshness: DataFrame) -> Rule:
    return Rule("stale_source", _count(freshness.where("freshness_status = 'error'")), F.col("value") > 0)


def quota(usage: DataFrame, as_of, monthly_quota: float) -> list[Rule]:
    """Spend of the month so far against 75, 90 and 100 percent of a quota."""
    month = F.date_trunc("month", ntz(as_of)).cast("timestamp_ntz")
    share = usage.where((F.col("start_time") >= month) & (F.col("start_time") <= ntz(as_of))).agg(
        F.round(F.coalesce(F.sum("credits_used"), F.lit(0.0)) * 100.0 / monthly_quota, 6).alias("value"))
    return [Rule(f"quota_{step}", share, F.col("value") >= step, "warn" if step < 100 else "error") for step in QUOTA_STEPS]


def evaluate_alerts(rules: list[Rule], as_of) -> DataFrame:
    """(alert_type, severity, fired, value, created_at), one row per rule; each measure is one aggregated row."""
    out = None
    for rule in rules:
        row = rule.measure.select(
            F.lit(rule.name).alias("alert_type"), F.lit(rule.severity).alias("severity"), F.coalesce(rule.fires, F.lit(False)).alias("fired"),
            F.col("value").cast("double").alias("value"), ntz(as_of).alias("created_at"))
        out = row if out is None else out.unionByName(row)
    return out


def alert_log(evaluated: DataFrame) -> DataFrame:
    """Fired alerts as rows of ops.alert_log."""
    return evaluated.where("fired").select(
        "alert_type", F.concat("alert_type", F.lit(": "), F.round("value", 2).cast("string")).alias("message"), "created_at", "fired")


def alert_history(log: DataFrame, as_of, days=7, suspended: list[str] = ()) -> DataFrame:
    """Alerts of a period, those of suspended rules left out."""
    recent = log.where(within("created_at", as_of, days=days) & (F.col("created_at") <= ntz(as_of)))
    return recent.where(~F.col("alert_type").isin(list(suspended))) if suspended else recent
