"""Tables in key-range folders: the same rows as a rewritten table, and only touched folders written."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from loadkit.operators import folders as B, merge as M
from loadkit.operators.versioned import ConcurrentCommit, Table
from loadkit.streaming import rowstream as RS

AS_OF = "2024-01-31 00:00:00"
KINDS = {"bigint": lambda x: x, "string": lambda x: None if x is None else f"é{x}", "date": lambda x: None if x is None else f"2020-{1 + x % 12:02d}-{1 + x // 12 % 28:02d}", "decimal(10,2)": lambda x: x}


def frame(spark, kind, rows):
    df = spark.createDataFrame([(None if k is None else KINDS[kind](k), ts, v) for k, ts, v in rows], f"k {'bigint' if kind.startswith('dec') else 'string' if kind == 'date' else kind}, ts bigint, v double")
    return df.withColumn("k", F.col("k").cast(kind))


@pytest.mark.parametrize("kind", list(KINDS))
def test_merges_equal_those_of_a_rewritten_table(spark, folder, kind):
    rng = random.Random(7)
    ids = rng.sample(range(300), 120)
    first = frame(spark, kind, [(k, rng.randrange(50), rng.random()) for k in ids] + [(None, 1, 0.5)])
    plain, parted = Table(spark, folder("plain")), Table(spark, folder("parted"))
    plain.append(first, AS_OF)
    B.create(parted, first, "k", AS_OF, folder_rows=15)
    assert len(parted.current()["load_ids"]) > 4
    for step in range(3):
        low = rng.randrange(250)
        feed = frame(spark, kind, [(rng.randrange(low, low + 40), rng.randrange(100), rng.random()) for _ in range(30)] + ([(None, 9, 1.0)] if step == 1 else []))
        merging = lambda now, feed=feed: M.upsert(now, feed, "k", "ts")
        counts = [sorted(map(tuple, M.apply(t, merging, AS_OF, source=feed).collect())) for t in (plain, parted)]
        assert counts[0] == counts[1]
        assert sorted(plain.read().collect(), key=str) == sorted(parted.read().collect(), key=str)
        assert parted.current()["rows"] == plain.current()["rows"] == parted.read().count()


def test_only_touched_folders_are_written_and_large_ones_are_parted(spark, folder):
    t = Table(spark, folder())
    B.create(t, spark.range(1000).withColumnRenamed("id", "k").withColumn("v", F.lit(0)), "k", AS_OF, bounds=[100, 200, 900], folder_rows=100)
    was = dict(zip(t.current()["lows"], t.current()["load_ids"], strict=True))
    source = spark.createDataFrame([(150, 1), (5000, 1)], "k bigint, v int")
    w = B.change(t, lambda now: M.merge(now, source, "k"), AS_OF, "merge", source)
    assert (w.touched, w.kept) == (2, 2) and w.actions == {"unchanged": 199, "updated": 1, "inserted": 1, "deleted": 0}
    now = dict(zip(t.current()["lows"], t.current()["load_ids"], strict=True))
    assert {low for low in was if now.get(low) == was[low]} == {None, "200"}
    # the folder from 200 to 900 is seven times too large: the next change there parts it
    w = B.change(t, lambda n: M.update_where(n, {"v": F.lit(2)}, F.col("k") == 300), AS_OF, "update", condition=F.col("k") == 300)
    assert w.touched == 1 and w.written >= 5
    rows = t.read().groupBy("v").count().collect()
    assert sorted(map(tuple, rows)) == [(0, 998), (1, 2), (2, 1)]
    again = B.change(t, lambda n: M.update_where(n, {"v": F.lit(3)}, F.col("k") == 301), AS_OF, "update", condition=F.col("k") == 301)
    assert again.touched == 1 and sum(t.current()["part_rows"]) == 1001


def test_appends_and_empty_tables(spark, folder):
    t = Table(spark, folder())
    empty = spark.createDataFrame([], "k bigint, v int")
    B.create(t, empty, "k", AS_OF)
    assert t.read().count() == 0 and t.current()["load_ids"] == []
    source = spark.createDataFrame([(1, 1), (2, 2), (None, 3)], "k bigint, v int")
    B.change(t, lambda now: M.merge(now, source, "k"), AS_OF, "merge", source)
    t.append(spark.createDataFrame([(9, 9), (None, 4)], "k bigint, v int"), AS_OF)
    assert sorted(map(tuple, t.read().collect()), key=str) == sorted([(1, 1), (2, 2), (None, 3), (9, 9), (None, 4)], key=str)
    gone = B.change(t, lambda now: M.delete_where(now, F.lit(True)), AS_OF, "delete", condition=F.lit(True))
    assert gone.actions["deleted"] == 5 and t.read().count() == 0
    assert B.change(t, lambda now: now, AS_OF, "merge", empty) == B.Written({}, 0, 0, 0)
    with pytest.raises(ValueError, match="append"):
        t.publish_append("x", empty.schema, AS_OF)


def test_a_later_writer_loses_nothing(spark, folder):
    t = Table(spark, folder())
    B.create(t, spark.range(100).withColumnRenamed("id", "k"), "k", AS_OF, bounds=[50])
    base = t.current()
    t.append(spark.createDataFrame([(500,)], "k bigint"), AS_OF)
    source = spark.createDataFrame([(1,)], "k bigint")
    with pytest.raises(ConcurrentCommit):
        B.change(t, lambda now: M.merge(now, source, "k"), AS_OF, "merge", source, base=base)
    assert t.read().count() == 101


def test_ranges_of_many_bounds(spark):
    bounds = [str(b) for b in range(0, 2000, 3)]
    df = spark.range(-5, 2105).select("id", B.range_of(F.col("id"), bounds, spark.range(1).schema["id"].dataType).alias("p"))
    assert all(r.p == sum(int(b) <= r.id for b in bounds) for r in df.collect()[::7])


def test_streams_write_the_folders_they_touch(spark, folder):
    t, stage = Table(spark, folder()), folder("stage")
    B.create(t, spark.range(1000).select(F.col("id").alias("k"), F.lit(0).cast("bigint").alias("ts")), "k", AS_OF, bounds=list(range(100, 1000, 100)))
    before = set(t.current()["load_ids"])
    spark.createDataFrame([(5, 7), (7, -1), (950, 3)], "k bigint, ts bigint").write.json(stage)
    source = spark.readStream.schema("k bigint, ts bigint").json(stage)
    RS.late_merge_stream(source, t, "k", "ts", folder("ckpt"), AS_OF).awaitTermination()
    assert len(before & set(t.current()["load_ids"])) == 8
    assert sorted(map(tuple, t.read().where("ts > 0").collect())) == [(5, 7), (950, 3)]
    assert RS.new_loads(t, "c") == {}
    t.append(spark.createDataFrame([(2000, 1)], "k bigint, ts bigint"), AS_OF)
    seen = []
    assert RS.consume(t, "c", lambda rows: seen.extend(map(tuple, rows.collect()))) == 1 and seen == [(2000, 1)]


def test_ranges_of_many_bounds(spark):
    """Every key meets its range whatever the number of bounds, by an expression that doesn't grow with them."""
    for n in (1, 15, 16, 17, 256, 257, 5000):
        at = B.range_of(F.col("id"), [str(3 * i) for i in range(n)], T.LongType())
        wrong = spark.range(-5, 3 * n + 5).withColumn("p", at).where(f"p <> if(id < 0, 0, least(id div 3 + 1, {n}))")
        assert wrong.count() == 0
        assert str(at).count("split") <= 5
    texts = B.range_of(F.col("v"), ["", "\x01b", "a.b", "é"], T.StringType())
    rows = spark.createDataFrame([(None, 0), ("", 1), ("\x01c", 2), ("a.c", 3), ("é", 4)], "v string, n int")
    assert rows.withColumn("p", texts).where("p <> n").count() == 0
