"""Merges, versions, streams and helpers: properties on randomized or hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from loadkit.functions import windows as W
from loadkit.functions.hashing import checksum, row_hash
from loadkit.functions.times import diff, ntz, parse_timestamp, spark_format
from loadkit.operators import merge as M, reconcile as RC, rejects as R, schema as S
from loadkit.operators.versioned import ConcurrentCommit, Table, cluster
from loadkit.sources.rows import rows_frame
from loadkit.streaming import rowstream as RS

AS_OF = "2024-01-31 00:00:00"


def events(spark, seed, n, keys):
    rng = random.Random(seed)
    return spark.createDataFrame([(rng.randrange(keys), rng.randrange(1000), rng.random()) for _ in range(n)], "k bigint, ts bigint, v double")


def newest(rows):
    best = {}
    for k, ts, v in rows:
        if k not in best or ts > best[k]:
            best[k] = ts
    return best


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_order_does_not_matter(spark, folder, seed):
    all_rows = events(spark, seed, 400, 60)
    rows = [tuple(r) for r in all_rows.collect()]
    random.Random(seed).shuffle(rows)
    expected = newest(rows)
    for cut in (1, 4):
        now = spark.createDataFrame([], all_rows.schema)
        for i in range(cut):
            part = spark.createDataFrame(rows[i::cut], all_rows.schema)
            now = spark.createDataFrame(M.result(M.upsert(now, part, "k", "ts")).collect(), all_rows.schema)
        got = {r["k"]: r["ts"] for r in now.collect()}
        assert got == expected and now.count() == len(expected)


def test_merge_paths_agree_and_null_keys_stay(spark):
    t = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (None, 1, "n")], "k bigint, ts bigint, v string")
    s = spark.createDataFrame([(1, 2, "A"), (3, 1, "c"), (None, 5, "m")], "k bigint, ts bigint, v string")
    rules = M.Rules(update_when=F.col("s.ts") > F.col("t.ts"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = []
    for limit in (before, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        found.append(sorted(M.merge(t, s, "k", rules).collect(), key=str))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    a, b = found
    assert a == b
    assert {(r["k"], r["v"], r["_action"]) for r in a} == {
        (1, "A", "updated"), (2, "b", "unchanged"), (None, "n", "unchanged"), (3, "c", "inserted"), (None, "m", "inserted")}


def test_delete_is_final_within_a_batch(spark):
    t = spark.createDataFrame([("1", "old", "2024-01-01")], "id string, name string, at string").select("id", "name", F.col("at").cast("timestamp_ntz").alias("updated_at"))
    feed = spark.createDataFrame([("1", "u", "newer", "2024-01-02"), ("1", "d", None, "2024-01-03")], "id string, operation string, name string, at string")
    changes = feed.select("id", "operation", "name", F.col("at").cast("timestamp_ntz").alias("updated_at"))
    assert M.result(M.merge_cdc(t, changes, "id")).count() == 0


def test_concurrent_overwrite_is_refused_and_appends_are_not(spark, folder):
    t = Table(spark, folder())
    t.append(spark.range(5), AS_OF)
    base = t.current()
    t.append(spark.range(5), AS_OF)
    with pytest.raises(ConcurrentCommit):
        t.overwrite(spark.range(1), AS_OF, base=base)
    assert t.read().count() == 10
    real, calls = Table.current, []

    def stale(self):
        calls.append(1)
        return base if len(calls) <= 2 else real(self)

    Table.current = stale
    try:
        t.append(spark.range(3), AS_OF)
    finally:
        Table.current = real
    assert t.read().count() == 13


def test_expire_keeps_history_and_current(spark, folder):
    t = Table(spark, folder())
    for day in range(1, 6):
        t.append(spark.range(day), f"2024-01-0{day} 00:00:00")
    t.compact("2024-01-06 00:00:00")
    t.expire("2024-02-01 00:00:00")
    assert t.read().count() == 15 and t.snapshots().count() == 1
    assert t.committed_loads().distinct().count() == 6


def test_compact_where_keeps_other_loads(spark, folder):
    t = Table(spark, folder())
    t.append(spark.range(0, 10), AS_OF)
    t.append(spark.range(10, 20), AS_OF)
    untouched = t.current()["load_ids"][1]
    t.compact(AS_OF, where=F.col("id") == 3)
    assert untouched in t.current()["load_ids"] and t.read().count() == 20


def test_added_columns_and_changed_types(spark, folder):
    t = Table(spark, folder())
    t.append(spark.range(2), AS_OF)
    t.append(spark.range(2).withColumn("x", F.lit("a")), AS_OF)
    assert sorted((r["id"], r["x"]) for r in t.read().collect() if r["x"]) == [(0, "a"), (1, "a")]
    with pytest.raises(ValueError):
        t.append(spark.range(2).withColumn("x", F.lit(1)), AS_OF)


def test_add_files_refuses_other_schemas(spark, folder):
    t, stage = Table(spark, folder()), folder("stage")
    t.append(spark.range(3), AS_OF)
    spark.range(3).withColumnRenamed("id", "other").write.parquet(stage)
    with pytest.raises(ValueError):
        t.add_files(stage, AS_OF)


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_exact_percentile_under_skew(spark, p):
    rng = random.Random(5)
    values = [7.0] * 700 + [rng.random() * 100 for _ in range(1301)]
    df = spark.createDataFrame([("hot", v) for v in values] + [("one", 3.0)], "g string, v double")
    expected = {r["g"]: r["e"] for r in df.groupBy("g").agg(F.percentile("v", p).alias("e")).collect()}
    for accuracy in (10000, 100):
        got = {r["g"]: r["x"] for r in W.exact_percentile(df, ["g"], "v", p, "x", accuracy).collect()}
        assert got == pytest.approx(expected)


def test_lag_and_running_sum_match_plain_windows(spark):
    from pyspark.sql import Window

    rng = random.Random(9)
    df = spark.createDataFrame([(rng.choice("aab"), i, rng.randrange(10**5)) for i in range(500)], "k string, id bigint, s bigint").select(
        "k", "id", F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, cast(s as int))").alias("ts"), F.col("id").alias("n"))
    plain = df.withColumn("p", F.lag("ts").over(Window.partitionBy("k").orderBy("ts", "id")))
    assert sorted(W.lag_over_time(df, ["k"], "ts", "p", ["id"]).select("id", "p").collect()) == sorted(plain.select("id", "p").collect())
    run = Window.orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, -1)
    total = df.withColumn("b", F.coalesce(F.sum("n").over(run), F.lit(0)))
    assert sorted(W.running_before(df, "n", "ts", ["id"], "b").select("id", "b").collect()) == sorted(total.select("id", "b").collect())


def test_checksum_ignores_order_and_sees_every_edit(spark):
    rows = [(i, f"t{i}") for i in range(200)]
    sum_of = lambda data: spark.createDataFrame(data, "a bigint, b string").select(row_hash(["a", "b"]).alias("h")).agg(checksum(F.col("h")).alias("c")).head()["c"]
    base = sum_of(rows)
    assert sum_of(rows[::-1]) == base
    for changed in (rows[1:], rows + rows[:1], [(0, "t0 ")] + rows[1:], [(0, None)] + rows[1:]):
        assert sum_of(changed) != base


def test_dates(spark):
    df = spark.createDataFrame([("2024-01-15 10:00:00",), ("01/15/2024",), ("15-JAN-2024",), ("junk",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_timestamp("t", "YYYY-MM-DD HH24:MI:SS", "MM/DD/YYYY", "DD-MON-YYYY").cast("string")).collect()]
    assert got == ["2024-01-15 10:00:00", "2024-01-15 00:00:00", "2024-01-15 00:00:00", None, None]
    assert spark_format("YYYY-MM-DD\"T\"HH24:MI:SS").startswith("yyyy-MM-dd")
    one = spark.range(1).select(diff("minute", ntz("2024-01-01 00:00:59"), ntz("2024-01-01 00:01:01")).alias("m"), diff("hour", ntz("2024-01-01 00:00:59"), ntz("2024-01-01 00:01:01")).alias("h")).head()
    assert (one["m"], one["h"]) == (1, 0)


def test_delta_compare_with_repeated_keys(spark):
    s = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, None)], "id bigint, x string")
    t = spark.createDataFrame([(1, "a"), (1, "z"), (3, None)], "id bigint, x string")
    got = sorted((r["id"], r["status"]) for r in RC.delta_compare(s, t, "id", ["id", "x"], all_rows=True).collect())
    assert got == [(1, "MATCH"), (1, "MISMATCH"), (2, "NEW - Not in target"), (3, "MATCH")]


def test_retry_failed_and_dead_letters_with_null_ids(spark):
    rej = spark.createDataFrame([(1, "PERMANENT_FAILURE"), (2, "PERMANENT_FAILURE")], "rejection_id bigint, retry_status string").select(
        "*", F.lit("t").alias("target_table"), F.lit("f").alias("source_file"), F.lit("m").alias("error_message"), F.lit("d").alias("rejected_data"))
    queue = spark.createDataFrame([(1,), (None,)], "original_rejection_id bigint")
    assert [r["original_rejection_id"] for r in R.to_dead_letters(rej, queue, AS_OF).collect()] == [2]


def test_schema_gate(spark):
    f = lambda *cols: S.schema_frame(spark, T.StructType([T.StructField(n, t) for n, t in cols]))
    a, b = f(("x", T.LongType())), f(("X", T.LongType()), ("y", T.StringType()))
    assert S.validate_schema(b, a).head()["result"].startswith("WARN")
    assert S.validate_schema(b, a, allow_new=True).head()["result"].startswith("PASS")
    assert S.validate_schema(a, b).head()["result"].startswith("FAIL")


def test_rows_frame_keeps_nested_values_as_text(spark):
    df = rows_frame(spark, [{"id": i, "doc": {"k": [i]}} for i in range(250)], T.StructType.fromDDL("id bigint, doc string"))
    assert df.rdd.getNumPartitions() == 3 and df.where("doc = '{\"k\": [7]}'").count() == 1


def test_cluster_spreads_a_hot_key(spark):
    df = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")))
    sizes = [r["n"] for r in cluster(df, ["k"], 6).groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 1000


def test_row_stream_replay(spark, folder):
    stage, ckpt = folder("in"), folder("ckpt")
    spark.range(100).selectExpr("id", "cast(id as string) as v").repartition(5).write.json(stage)
    t = Table(spark, folder())
    source = spark.readStream.schema("id bigint, v string").option("maxFilesPerTrigger", 2).json(stage)
    RS.row_stream(source, t, "ch", ckpt, AS_OF).awaitTermination()
    assert t.read().count() == 100
    # a second checkpoint is a second channel run; the first one has nothing left to do
    RS.row_stream(source, t, "ch", ckpt, AS_OF).awaitTermination()
    assert t.read().count() == 100
    last = sorted(r["load_id"] for r in t.committed_loads().collect())[-1]
    stream, batch = last.rsplit("-", 1)
    assert t.streamed(stream) == int(batch)
    RS._append_once(t, spark.createDataFrame([(1, "x")], "id bigint, v string"), AS_OF, stream, int(batch))
    assert t.read().count() == 100


def test_inferred_payload_schema(spark):
    df = spark.createDataFrame([('{"a": 1, "b": {"c": "x"}}',), ('{"a": 2.5}',)], "value string")
    names = RS.inferred_schema(df).names
    assert sorted(names) == ["a", "b"]


def test_kafka_says_what_is_missing(spark):
    with pytest.raises(RuntimeError, match="kafka"):
        RS.kafka_messages(spark, "localhost:1", ["t"])


def test_add_files_takes_every_file(spark, folder, tmp_path):
    """Names that differ in a slash only are all taken; a file that isn't is an error."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "a").mkdir()
    for name, values in (("a/b.parquet", [1, 2, 3]), ("a_b.parquet", [4, 5, 6, 7, 8])):
        pq.write_table(pa.table({"k": pa.array(values, pa.int64())}), tmp_path / name)
    t = Table(spark, folder("t"))
    t.add_files(str(tmp_path), AS_OF)
    assert sorted(r.k for r in t.read().collect()) == [1, 2, 3, 4, 5, 6, 7, 8]
    pq.write_table(pa.table({"k": pa.array([9], pa.int64())}), tmp_path / "c.parq")
    with pytest.raises(ValueError, match="c.parq"):
        t.add_files(str(tmp_path), AS_OF)
