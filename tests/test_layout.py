"""Days written by their size; containment of names against all pairs."""

import os
import random

from pyspark.sql import functions as F

from loadkit.operators import external as E, reconcile as RC


def test_a_heavy_day_is_written_in_files_of_like_size(spark, folder):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "512k")
    try:
        day = F.when(F.col("id") < 300_000, 1).otherwise(2 + F.col("id") % 10)
        df = spark.range(330_000).select(F.make_timestamp_ntz(F.lit(2024), F.lit(1), day, F.lit(0), F.lit(0), F.lit(0)).alias("ts"), F.md5(F.col("id").cast("string")).alias("v"))
        E.repartition_layout(df, "ts", path := folder())
    finally:
        spark.conf.set(key, before)
    local = path.removeprefix("file:")
    files = {d: sum(f.endswith(".parquet") for f in os.listdir(f"{local}/year=2024/month=1/day={d}")) for d in range(1, 12)}
    # a day is parted at most by the tasks that read it
    assert files[1] >= 6 and max(files[d] for d in range(2, 12)) <= 2
    assert spark.read.parquet(path).count() == 330_000


def test_containment_of_names_against_all_pairs(spark):
    rng = random.Random(6)
    names = lambda n, k: {"".join(rng.choices("ab/é", k=rng.randint(0, k))) for _ in range(n)}
    loads = [(x, i) for i, x in enumerate(names(40, 9))]
    wanted = [(x, rng.randrange(40)) for x in names(80, 25)]
    hist = spark.createDataFrame([(x, n, f"2024-01-01 00:00:{n % 60:02d}") for x, n in loads], "file_name string, row_count bigint, last_load_time string")
    got = {r.file_name: r.actual_rows for r in RC.reconcile_manifest(spark.createDataFrame(wanted, "file_name string, expected_rows bigint"), hist).collect()}
    assert got == {x: max([n for y, n in loads if y in x], default=0) for x, _ in wanted}
