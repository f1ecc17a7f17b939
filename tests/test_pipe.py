"""Pipes: what makes a file new, damaged files, and work that doesn't grow with the table's age."""

import os
import time

import pytest
from pyspark.sql import functions as F

from loadkit.operators import copy as C, ledger
from loadkit.operators.versioned import Table
from loadkit.sources.formats import FileFormat
from loadkit.streaming.pipe import Pipe

AS_OF = "2024-01-31 00:00:00"
SCHEMA = "id bigint, v string"


def put(stage, name, rows):
    path = os.path.join(stage.removeprefix("file:"), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.writelines(f'{{"id": {i}, "v": "{v}"}}\n' for i, v in rows)


def pipe(spark, stage, table, ckpt, fmt=None, **kw):
    return Pipe(spark, "p", stage, fmt or FileFormat.json(), SCHEMA, table, ckpt, as_of=AS_OF, **kw)


def ids(table):
    return sorted(r.id for r in table.read().collect())


def test_equal_names_in_two_folders_and_two_stages(spark, folder):
    t, a, b = Table(spark, folder("t")), folder("a"), folder("b")
    put(a, "x/f.json", [(1, "a")])
    put(a, "y/f.json", [(2, "a")])
    put(b, "x/f.json", [(3, "b")])
    for stage in (a, b):
        pipe(spark, stage, t, folder("ckpt")).refresh()
    assert ids(t) == [1, 2, 3]
    for stage in (a, b):
        pipe(spark, stage, t, folder("ckpt")).refresh()
    assert ids(t) == [1, 2, 3]


def test_rewritten_and_repaired_files_are_loaded_again(spark, folder):
    t, stage = Table(spark, folder("t")), folder("stage")
    put(stage, "good.json", [(1, "a")])
    put(stage, "bad.json", [("x", "a"), ("y", "b")])
    p = pipe(spark, stage, t, folder("ckpt"), on_error="SKIP_FILE")
    p.refresh()
    assert ids(t) == [1] and [r.name for r in p.pending().collect()] == ["bad.json"]
    p.refresh()
    assert ids(t) == [1]
    time.sleep(1.1)
    put(stage, "bad.json", [(7, "a"), (8, "b")])
    put(stage, "good.json", [(9, "longer")])
    p.refresh()
    assert ids(t) == [1, 7, 8, 9] and p.pending().isEmpty()
    p.refresh()
    assert ids(t) == [1, 7, 8, 9]
    # what a bulk load has loaded, a pipe leaves
    put(stage, "bulk.json", [(20, "z")])
    C.copy_into(spark, t, stage, FileFormat.json(), SCHEMA, AS_OF, files=["bulk.json"])
    p.refresh()
    assert ids(t) == [1, 7, 8, 9, 20]


@pytest.mark.parametrize("policy", ["CONTINUE", "SKIP_FILE"])
def test_damaged_columnar_files_are_reported_and_give_no_rows(spark, folder, policy):
    t, stage = Table(spark, folder("t")), folder("stage")
    spark.range(200_000).select("id", F.md5(F.col("id").cast("string")).alias("v")).coalesce(1).write.parquet(f"{stage}/big")
    spark.range(5).select("id", F.lit("s").alias("v")).coalesce(1).write.parquet(f"{stage}/small")
    spark.range(5).select("id", F.lit("s").alias("v")).coalesce(1).write.parquet(f"{stage}/cut")
    local = stage.removeprefix("file:")

    def part(name):
        return next(os.path.join(local, name, f) for f in os.listdir(os.path.join(local, name)) if f.endswith(".parquet"))

    with open(part("big"), "r+b") as f:
        f.seek(os.path.getsize(part("big")) // 2)
        f.write(b"\x13" * 2000)
    with open(part("cut"), "r+b") as f:
        f.truncate(os.path.getsize(part("cut")) - 9)
    for name in ("big", "small", "cut"):
        crc = os.path.join(os.path.dirname(part(name)), f".{os.path.basename(part(name))}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    p = pipe(spark, stage, t, folder("ckpt"), FileFormat.parquet(), on_error=policy)
    p.refresh()
    status = {r.file_name.split("/")[0]: (r.status, r.row_count) for r in ledger.history(t).where("file_name like '%.parquet'").collect()}
    assert status == {"big": ("LOAD_FAILED", 0), "small": ("LOADED", 5), "cut": ("LOAD_FAILED", 0)}
    assert t.read().count() == 5


def test_batches_read_no_more_as_the_table_ages(spark, folder, monkeypatch):
    """What a batch reads besides its files: one version, and the history of its files' days."""
    t, stage, ckpt = Table(spark, folder("t")), folder("stage"), folder("ckpt")
    reads = []
    whole = Table.snapshots
    monkeypatch.setattr(Table, "snapshots", lambda self: reads.append("all versions") or whole(self))
    seen = ledger._read
    monkeypatch.setattr(ledger, "_read", lambda table, paths: reads.append(len([p for p in paths if "load_id" not in p])) or seen(table, paths))
    old = time.time() - 40 * 86400
    cost = []
    for n in range(6):
        put(stage, f"{n}.json", [(n, "v")])
        path = f"{stage.removeprefix('file:')}/{n}.json"
        os.utime(path, (old + n * 86400, old + n * 86400))
        p = pipe(spark, stage, t, ckpt)
        monkeypatch.setattr(p, "reload_changed", lambda prefix="": None)
        reads.clear()
        p.refresh()
        cost.append(list(reads))
    assert ids(t) == list(range(6))
    assert cost[1] == cost[5] and "all versions" not in cost[5] and max(x for x in cost[5]) <= 1
    # a batch that is replayed finds itself published
    p._load_batch(p.files().sparkSession.createDataFrame([], "path string, name string, size bigint, last_modified timestamp_ntz"), 0, "00000000")
    assert ids(t) == list(range(6))


def test_a_replayed_batch_loads_nothing(spark, folder):
    t, stage = Table(spark, folder("t")), folder("stage")
    put(stage, "a.json", [(1, "v")])
    p = pipe(spark, stage, t, folder("ckpt"))
    files = p.spark.createDataFrame([(f"{stage}/a.json", "a.json", os.path.getsize(f"{stage.removeprefix('file:')}/a.json"), None)], "path string, name string, size bigint, last_modified timestamp_ntz")
    for _ in range(2):
        p._load_batch(files, 3, "abcdef01")
    assert ids(t) == [1] and t.streamed("p-abcdef01") == 3
