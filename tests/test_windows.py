import random

import numpy as np
import pytest
from loadkit.functions.windows import exact_percentile, lag_over_time, latest_by
from loadkit.streaming.latency import latency_stream
from pyspark.sql import functions as F


@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 1.0])
def test_percentile_is_exact_for_every_group_size(spark, p):
    rng = random.Random(1)
    rows = []
    for n in (1, 2, 3, 5, 10, 99, 100, 101, 1000, 2000):
        rows += [(f"u{n}", rng.random()) for _ in range(n)] + [(f"d{n}", float(rng.randint(0, 5))) for _ in range(n)]
    rows += [("big", float(rng.randint(0, 10**6))) for _ in range(30_000)]
    df = spark.createDataFrame([*rows, ("none", None), ("u5", None)], "k string, v double")
    got = {r.k: r.p for r in exact_percentile(df, ["k"], "v", p, "p").collect()}
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    for k, v in groups.items():
        assert got[k] == pytest.approx(np.percentile(v, 100 * p), abs=1e-9), k
    assert exact_percentile(df, [], "v", p, "p").first().p == pytest.approx(np.percentile([v for _, v in rows], 100 * p), abs=1e-9)


def test_null_order_values_lose_at_both_ends(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 2, 2), ("a", 1, 3), ("b", None, 4)], "k string, t int, v int")
    assert sorted(r.v for r in latest_by(df, ["k"], ["t"], newest=False).collect()) == [3, 4]
    assert sorted(r.v for r in latest_by(df, ["k"], ["t"]).collect()) == [2, 4]


def test_rows_without_a_time_stay(spark):
    df = spark.createDataFrame([("a", None), ("a", "2024-01-01 01:00:00"), (None, "2024-01-01 02:00:00")], "k string, t string")
    df = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert lag_over_time(df, ["k"], "t", "before").count() == 3


def test_streamed_percentile_is_exact(spark, tmp_path):
    """One window of many latencies; an arrival an hour later closes it."""
    at = spark.range(20_000, numPartitions=7).selectExpr("timestamp_ntz'2024-01-01 00:00:30' a", "(id * 7919) % 5000 lat")
    rows = at.union(spark.sql("select timestamp_ntz'2024-01-01 01:00:00', 0L")).selectExpr("a - make_dt_interval(0, 0, 0, lat) src", "a")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    latency_stream(stream, "src", "a", "0 seconds").writeStream.option("checkpointLocation", str(tmp_path / "c")).outputMode("append").format(
        "parquet").option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
    (row,) = spark.read.parquet(str(tmp_path / "out")).collect()
    assert (row.row_count, row.p95_latency_sec, row.max_latency_sec) == (20_000, 4749, 4999)


def test_percentile_joins_brackets_by_their_size(spark):
    """Rows meet their group's bracket where they are, and only those in it are shuffled; a NULL group is a group."""
    df = spark.range(3_000_000).selectExpr("if(id % 3 = 0, null, id % 3) k", "cast(id as double) v")
    got = exact_percentile(df, ["k"], "v", 0.5, "p")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {r.k: r.p for r in got.collect()} == {None: 1499998.5, 1: 1499999.5, 2: 1500000.5}
