"""Window results computed so that one hot partition never lands in one task whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import staged
from .times import trunc


def lag_over_time(df: DataFrame, keys: list[str], ts: str, out: str, tiebreak: list[str] = (), unit="hour") -> DataFrame:
    """LAG(ts) per key in time order.

    Rows are windowed per (key, time slice); only the first row of a slice needs the last
    value of an earlier slice, and that comes from a frame with one row per key and slice.
    """
    sliced = df.withColumn("_slice", trunc(unit, ts))
    last = sliced.groupBy(*keys, "_slice").agg(F.max(ts).alias("_last"))
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    before = last.select(*keys, "_slice", F.lag("_last").over(by_slice).alias("_before"))
    inside = Window.partitionBy(*keys, "_slice").orderBy(ts, *tiebreak)
    # null-safe, so that rows without a time or a key keep their place
    renamed = before.toDF(*[f"_b_{c}" for c in (*keys, "_slice")], "_before")
    same = [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in (*keys, "_slice")]
    joined = sliced.withColumn("_inside", F.lag(ts).over(inside)).join(renamed, same, "left").drop(*renamed.columns[:-1])
    return joined.withColumn(out, F.coalesce("_inside", "_before")).drop("_slice", "_inside", "_before")


def running_before(df: DataFrame, value: str, ts: str, tiebreak: list[str], out: str) -> DataFrame:
    """Sum of `value` over all rows ordered before this one, in (ts, tiebreak) order.

    Two levels: a running sum over per-hour totals, then one inside each hour.
    """
    sliced = df.withColumn("_slice", trunc("hour", ts))
    totals = sliced.groupBy("_slice").agg(F.sum(value).alias("_sum"))
    # one row per hour of data: a frame of thousands, not of files
    ahead = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_slice", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_slice").orderBy(ts, *tiebreak).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(offsets.withColumnRenamed("_slice", "_of"), F.col("_slice").eqNullSafe(F.col("_of")))
        .withColumn(out, F.col("_inside") + F.col("_offset"))
        .drop("_slice", "_of", "_inside", "_offset")
    )


def latest_by(df: DataFrame, keys: list[str], order: list[Column], tiebreak: Column | None = None, newest=True) -> DataFrame:
    """One row per key: the newest (or oldest), as ROW_NUMBER() = 1 would give.

    Done as max_by/min_by, which combines before the shuffle, so a key holding a third of
    all rows sends one row per task instead of all of them. NULL order values lose, whichever
    end is asked for.
    """
    everything = F.struct(*[F.col(c) for c in df.columns])
    tie = tiebreak if tiebreak is not None else F.xxhash64(*[F.col(c) for c in df.columns if not _complex(df, c)])
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    rank = F.struct(*columns, tie) if newest else F.struct(*[x for c in columns for x in (c.isNull(), c)], tie)
    pick = F.max_by if newest else F.min_by
    return df.groupBy(*keys).agg(pick(everything, rank).alias("_row")).select("_row.*")


def _complex(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() in ("map", "variant")


def exact_percentile(df: DataFrame, keys: list[str], value: str, p: float, out: str, accuracy: int = 10000) -> DataFrame:
    """PERCENTILE_CONT(p) per key, exact, without gathering a group's values.

    A mergeable sketch brackets the quantile; only values inside the bracket (about
    10 / accuracy of the distinct values) are grouped and ranked, everything below is just counted. The
    sketch is off by n / accuracy ranks at most, so the bracket holds both neighbours once its
    other four parts in `accuracy` are two rows or more; a group too small for that is ranked whole.
    The brackets, a row per group, are stored, so that Spark knows their size when it joins the rows to them.
    """
    if not keys:
        return exact_percentile(df.withColumn("_all", F.lit(0)), ["_all"], value, p, out, accuracy).drop("_all")
    eps = 5.0 / accuracy
    lo_p, hi_p = max(0.0, p - eps), min(1.0, p + eps)
    present = df.where(F.col(value).isNotNull())
    bounds = present.groupBy(*keys).agg(
        F.count(value).alias("_n"),
        F.percentile_approx(value, [lo_p, hi_p], accuracy).alias("_near"),
        F.array(F.min(value), F.max(value)).alias("_ends"),
    )
    bounds = bounds.select(*keys, "_n", F.when(F.col("_n") < accuracy, F.col("_ends")).otherwise(F.col("_near")).alias("_b"))
    bounds = staged(bounds.toDF(*[f"_k{i}" for i in range(len(keys))], "_n", "_b"), "brackets")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    near = present.join(bounds, same).where(F.col(value) <= F.col("_b")[1])
    # rows below the bracket are one row of their group, without a value, ahead of the others
    counted = near.groupBy(*keys, "_n", F.when(F.col(value) >= F.col("_b")[0], F.col(value)).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    run = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_reach", F.sum("_c").over(run)).withColumn("_pos", F.lit(p) * (F.col("_n") - 1))
    ends = ranked.groupBy(*keys).agg(
        F.min(F.when(F.col("_reach") > F.floor("_pos"), F.col("_v"))).cast("double").alias("_lo"),
        F.min(F.when(F.col("_reach") > F.ceil("_pos"), F.col("_v"))).cast("double").alias("_hi"),
        F.first("_pos").alias("_pos"),
    )
    fraction = F.col("_pos") - F.floor("_pos")
    return ends.select(*keys, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * fraction).alias(out))
