"""Columnar files that are damaged, or of another type, never lose rows in silence; files are known by more than their name."""

import os

import pytest
from loadkit.operators import copy
from loadkit.operators.versioned import Table
from loadkit.sources.formats import FileFormat
from pyspark.sql import functions as F

AS_OF = "2099-01-31 00:00:00"
SCHEMA = "id bigint, v string"


def stage_of(spark, folder, damage):
    path = folder("stage")
    for name, n in (("good", 50), ("bad", 20_000)):
        spark.range(n).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v")).coalesce(1).write.parquet(f"{path}/{name}")
    (bad,) = [f for f in os.listdir(f"{path}/bad") if f.endswith(".parquet")]
    for f in os.listdir(f"{path}/bad"):
        if f.endswith(".crc"):
            os.remove(f"{path}/bad/{f}")
    damage(f"{path}/bad/{bad}")
    return path


def overwrite_middle(path):
    with open(path, "r+b") as f:
        f.seek(os.path.getsize(path) // 2)
        f.write(b"\xff" * 2000)


def truncate(path):
    with open(path, "r+b") as f:
        f.truncate(os.path.getsize(path) // 2)


@pytest.mark.parametrize("damage", [overwrite_middle, truncate])
def test_damaged_file_fails_alone(spark, folder, damage):
    stage = stage_of(spark, folder, damage)
    for policy in ("CONTINUE", "SKIP_FILE"):
        t = Table(spark, folder("t"))
        report = {r.file.split("/")[0]: (r.status, r.rows_loaded) for r in copy.copy_into(spark, t, stage, FileFormat.parquet(), SCHEMA, AS_OF, on_error=policy, load_uncertain=True).collect()}
        assert report == {"good": ("LOADED", 50), "bad": ("LOAD_FAILED", 0)}
        assert t.read().count() == 50
    with pytest.raises(copy.LoadAborted):
        copy.copy_into(spark, Table(spark, folder("t")), stage, FileFormat.parquet(), SCHEMA, AS_OF, load_uncertain=True)


def test_files_of_two_types_are_both_read(spark, folder):
    stage, t = folder("stage"), Table(spark, folder("t"))
    spark.range(10).select("id", F.lit("a").alias("v")).write.parquet(f"{stage}/numbers")
    spark.range(20, 30).select(F.when(F.col("id") == 25, "x").otherwise(F.col("id").cast("string")).alias("id"), F.lit("b").alias("v")).coalesce(1).write.parquet(f"{stage}/texts")
    report = copy.copy_into(spark, t, stage, FileFormat.parquet(), SCHEMA, AS_OF, on_error="CONTINUE", load_uncertain=True)
    assert report.agg(F.sum("rows_loaded"), F.sum("errors_seen")).first() == (19, 1)
    assert sorted(r.id for r in t.read().collect()) == [*range(10), *(i for i in range(20, 30) if i != 25)]


def test_same_name_in_another_stage_or_rewritten(spark, folder):
    t, one, two = Table(spark, folder("t")), folder("one"), folder("two")
    fmt = FileFormat.json()

    def put(stage, text):
        os.makedirs(stage, exist_ok=True)
        with open(f"{stage}/f.json", "w") as f:
            f.write(text)

    def load(stage):
        return copy.copy_into(spark, t, stage, fmt, SCHEMA, AS_OF, on_error="SKIP_FILE", load_uncertain=True).count()

    put(one, '{"id": 1}\n')
    put(two, '{"id": 2}\n')
    assert (load(one), load(two), load(one)) == (1, 1, 0)
    put(one, '{"id": 33}\n')
    assert load(one) == 1
    put(two, '{"id": "no"}\n')
    assert (load(two), load(two)) == (1, 1)  # failed, so it is taken again
    put(two, '{"id": 4}\n')
    assert (load(two), load(two)) == (1, 0)
    assert sorted(r.id for r in t.read().collect()) == [1, 2, 4, 33]


def test_deletes_outlive_older_changes_in_later_batches(spark):
    from loadkit.operators import merge as M

    def change(op, hour):
        return spark.createDataFrame([("k", op, None if op == "d" else op, f"2024-01-01 0{hour}:00:00")], "id string, operation string, name string, at string").select("id", "operation", "name", F.col("at").cast("timestamp_ntz").alias("updated_at"))

    import itertools

    for order in itertools.permutations([("c", 1), ("u", 2), ("d", 3)]):
        state = spark.createDataFrame([], "id string, name string, updated_at timestamp_ntz, _deleted boolean")
        for op, hour in order:
            state = M.result(M.merge_cdc(state, change(op, hour), "id"))
        assert M.cdc_live(state).count() == 0 and state.count() == 1


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_file_without_rows_is_not_damaged(spark, folder, kind):
    """Spark writes a file for its first partition even if that has no rows; a cut file beside it still fails."""
    stage, table = folder("stage"), Table(spark, folder("table"))
    spark.range(0, 100, 1, 4).where("id >= 50").selectExpr("id", "cast(id as int) v").write.format(kind).save(stage)
    report = copy.copy_into(spark, table, stage, FileFormat(kind), SCHEMA, AS_OF, load_uncertain=True)
    assert sorted((r.status, r.rows_loaded) for r in report.collect()) == [("LOADED", 0), ("LOADED", 25), ("LOADED", 25)]
    assert table.read().agg(F.sum("id")).first()[0] == sum(range(50, 100))
    cut = os.path.join(stage, min(f for f in os.listdir(stage) if f.startswith("part-")))
    os.remove(os.path.join(stage, f".{os.path.basename(cut)}.crc"))
    truncate(cut)
    with pytest.raises(copy.LoadAborted, match="1 files cannot be read"):
        copy.copy_into(spark, Table(spark, folder("other")), stage, FileFormat(kind), SCHEMA, AS_OF, load_uncertain=True)
