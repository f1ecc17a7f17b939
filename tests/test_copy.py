"""Bulk load: policy matrix, thresholds, tracking, formats and faults on small hand-made stages."""

import json
import os

import pytest
from pyspark.sql import functions as F, types as T

from loadkit.operators import copy as C, ledger
from loadkit.operators.versioned import Table
from loadkit.sources.formats import FileFormat
from loadkit.sources.stage import list_stage, numbered_lines, select_files

AS_OF = "2024-01-31 00:00:00"
SCHEMA = "id bigint, value double"
JSON = FileFormat.json()


def put(path, name, text):
    full = os.path.join(path, name)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "w", newline="") as out:
        out.write(text)


def lines(n, bad=(), cut=()):
    return "".join(
        ('{"id": %d, "val' % i if i in cut else json.dumps({"id": i, "value": "abc" if i in bad else i * 1.5})) + "\n" for i in range(1, n + 1))


def load(spark, folder, stage, on_error="CONTINUE", table=None, **kw):
    t = table or Table(spark, folder("table"))
    kw.setdefault("columns", SCHEMA)
    report = C.copy_into(spark, t, stage, kw.pop("fmt", JSON), kw.pop("columns"), kw.pop("as_of", AS_OF), on_error=on_error, **kw)
    return t, {r["file"]: r for r in report.collect()}


CLEAN, ONE, MANY, CORRUPT = lines(50), lines(50, bad={7}), lines(50, bad=set(range(1, 31))), lines(50, cut=set(range(20, 51)))
LOADED, PARTIAL, FAILED = "LOADED", "PARTIALLY_LOADED", "LOAD_FAILED"


@pytest.mark.parametrize("policy,expected", [
    ("CONTINUE", (LOADED, PARTIAL, PARTIAL, PARTIAL)), ("SKIP_FILE", (LOADED, FAILED, FAILED, FAILED)),
    ("SKIP_FILE_10", (LOADED, PARTIAL, FAILED, FAILED)), ("SKIP_FILE_5%", (LOADED, PARTIAL, FAILED, FAILED)),
])
def test_policy_matrix(spark, folder, policy, expected):
    stage = folder("stage")
    for name, text in zip(("clean", "one", "many", "corrupt"), (CLEAN, ONE, MANY, CORRUPT)):
        put(stage, f"{name}.json", text)
    t, report = load(spark, folder, stage, policy)
    assert tuple(report[f"{n}.json"]["status"] for n in ("clean", "one", "many", "corrupt")) == expected
    assert t.read().count() == sum(r["rows_loaded"] for r in report.values())


@pytest.mark.parametrize("text", [ONE, MANY, CORRUPT])
def test_abort_commits_nothing(spark, folder, text):
    stage = folder("stage")
    put(stage, "a.json", CLEAN)
    put(stage, "b.json", text)
    t = Table(spark, folder("table"))
    with pytest.raises(C.LoadAborted):
        load(spark, folder, stage, "ABORT_STATEMENT", t)
    assert t.current() is None and ledger.history(t).isEmpty()
    put(stage, "b.json", CLEAN)
    load(spark, folder, stage, "ABORT_STATEMENT", t)
    assert t.read().count() == 100


@pytest.mark.parametrize("policy,bad,status", [
    ("SKIP_FILE_10", 10, PARTIAL), ("SKIP_FILE_10", 11, FAILED), ("SKIP_FILE_5%", 10, PARTIAL), ("SKIP_FILE_5%", 11, FAILED)])
def test_thresholds_are_strict(spark, folder, policy, bad, status):
    stage = folder("stage")
    put(stage, "f.json", lines(200, bad=set(range(1, bad + 1))))
    assert load(spark, folder, stage, policy)[1]["f.json"]["status"] == status


def test_first_error_position(spark, folder):
    stage = folder("stage")
    put(stage, "f.json", ONE)
    row = load(spark, folder, stage)[1]["f.json"]
    assert (row["first_error_line"], row["first_error_column_name"]) == (7, "value")
    assert row["first_error_character"] > 0


def test_line_numbers_over_many_splits(spark, folder):
    stage = folder("stage")
    put(stage, "big.txt", "".join(f"line {i}\n" for i in range(1, 5001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = numbered_lines(spark, stage, stage)
        assert got.where(F.concat(F.lit("line "), F.col("line_number").cast("string")) != F.col("line")).count() == 0
        assert got.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_tracking_windows(spark, folder):
    stage = folder("stage")
    put(stage, "f.json", CLEAN)
    t, _ = load(spark, folder, stage)
    for as_of, rows in (("2024-02-01 00:00:00", 50), ("2024-04-03 00:00:00", 50), ("2024-04-04 00:00:00", 100)):
        load(spark, folder, stage, table=t, as_of=as_of)
        assert t.read().count() == rows


def test_pipe_window_is_shorter(spark, folder):
    stage = folder("stage")
    put(stage, "f.json", CLEAN)
    t, _ = load(spark, folder, stage, tracking_days=14)
    load(spark, folder, stage, table=t, as_of="2024-02-13 00:00:00", tracking_days=14)
    assert t.read().count() == 50
    load(spark, folder, stage, table=t, as_of="2024-02-14 00:00:00", tracking_days=14)
    assert t.read().count() == 100


def test_uncertain_files(spark, folder):
    stage = folder("stage")
    put(stage, "old.json", CLEAN)
    os.utime(os.path.join(stage, "old.json"), (1, 1))
    t, report = load(spark, folder, stage)
    assert report == {}
    _, report = load(spark, folder, stage, table=t, load_uncertain=True)
    assert report["old.json"]["rows_loaded"] == 50


def test_crash_before_publish_leaves_no_trace(spark, folder):
    stage = folder("stage")
    put(stage, "f.json", CLEAN)
    t = Table(spark, folder("table"))
    original = Table.publish_append
    Table.publish_append = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        with pytest.raises(RuntimeError):
            load(spark, folder, stage, table=t)
    finally:
        Table.publish_append = original
    load(spark, folder, stage, table=t)
    assert t.read().count() == 50


def test_purge_keeps_failed_files(spark, folder):
    stage = folder("stage")
    put(stage, "good.json", CLEAN)
    put(stage, "bad.json", ONE)
    load(spark, folder, stage, purge=True)
    assert [r["name"] for r in list_stage(spark, stage).collect()] == ["bad.json"]


def test_file_selection(spark, folder):
    stage = folder("stage")
    for i in range(4):
        put(stage, f"d/{i}.json", lines(10))
        os.utime(os.path.join(stage, f"d/{i}.json"), (1700000000 + i * 3600 * 5, 1700000000 + i * 3600 * 5))
    listing = list_stage(spark, stage)
    size = listing.head()["size"]
    names = lambda **kw: sorted(r["name"] for r in select_files(listing, **kw).collect())
    assert names(files=["d/1.json", "gone.json"]) == ["d/1.json"]
    assert names(pattern=r".*[23][.]json") == ["d/2.json", "d/3.json"]
    assert names(pattern=r"[23][.]json") == []
    assert names(size_limit=1) == ["d/0.json"]
    assert names(size_limit=2 * size) == ["d/0.json", "d/1.json"]
    assert names(size_limit=2 * size + 1) == ["d/0.json", "d/1.json", "d/2.json"]


def test_names_with_blanks_and_signs(spark, folder):
    stage = folder("stage")
    put(stage, "a b+c%20.json", CLEAN)
    t, report = load(spark, folder, stage)
    assert report["a b+c%20.json"]["rows_loaded"] == 50
    load(spark, folder, stage, table=t)
    assert t.read().count() == 50


def test_json_array_and_raw_record(spark, folder):
    stage = folder("stage")
    put(stage, "a.json", json.dumps([{"id": 1, "value": 1}, {"id": 2, "value": "x"}, {"id": 3, "value": None}]))
    t, report = load(spark, folder, stage, fmt=FileFormat.json(strip_outer_array=True))
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, 1.0), (3, None)]
    assert report["a.json"]["first_error_line"] == 2
    stage = folder("stage")
    put(stage, "b.json", '{"id": 1, "value": 2, "more": {"k": [1, null]}, "none": null}\n')
    for strip, expected in ((False, True), (True, False)):
        t, _ = load(spark, folder, stage, fmt=FileFormat.json(strip_null_values=strip), columns=C.Columns(SCHEMA, raw_column="raw"))
        keys = t.read().select(F.json_object_keys(F.to_json("raw")).alias("k")).head()["k"]
        assert ("none" in keys) is expected and "more" in keys


def test_required_and_length(spark, folder):
    stage = folder("stage")
    put(stage, "a.json", '{"id": null, "name": "abc"}\n{"id": 2, "name": "abcdef"}\n{"id": 3, "name": "abc"}\n')
    cols = C.Columns("id bigint, name string", lengths={"name": 5}, required=("id",))
    t, report = load(spark, folder, stage, columns=cols)
    assert [r["id"] for r in t.read().collect()] == [3] and report["a.json"]["errors_seen"] == 2


def test_csv_forms(spark, folder):
    stage = folder("stage")
    put(stage, "a.csv", 'title line\nid|name|day\n1|"a|b"|2024-01-15\n2|NULL|2024-01-16\n3|c\n4|""|junk\n')
    fmt = FileFormat.csv(delimiter="|", skip_header=2, null_if=("NULL",))
    t, report = load(spark, folder, stage, fmt=fmt, columns="id bigint, name string, day date")
    assert sorted((r["id"], r["name"]) for r in t.read().collect()) == [(1, "a|b"), (2, None)]
    assert report["a.csv"]["errors_seen"] == 2
    t, _ = load(spark, folder, stage, fmt=fmt.with_(error_on_column_count_mismatch=False), columns="id bigint, name string, day date")
    assert sorted(r["id"] for r in t.read().collect()) == [1, 2, 3]
    stage = folder("stage")
    put(stage, "q.csv", '1,"two\nlines"\n2,x\n')
    t, _ = load(spark, folder, stage, fmt=FileFormat.csv(multi_line=True), columns="id bigint, name string")
    assert sorted(tuple(r) for r in t.read().collect()) == [(1, "two\nlines"), (2, "x")]


def test_parquet_with_unreadable_file(spark, folder):
    stage = folder("stage")
    spark.range(100).selectExpr("id", "cast(id as string) as name").repartition(2).write.parquet(stage)
    put(stage, "broken.parquet", "this is no parquet file")
    schema = "id bigint, name string"
    t = Table(spark, folder("table"))
    with pytest.raises(C.LoadAborted):
        load(spark, folder, stage, "ABORT_STATEMENT", t, fmt=FileFormat.parquet(), columns=T.StructType.fromDDL(schema))
    t, report = load(spark, folder, stage, fmt=FileFormat.parquet(), columns=schema)
    assert report["broken.parquet"]["status"] == FAILED and t.read().count() == 100
    t, report = load(spark, folder, stage, fmt=FileFormat.parquet(), columns="id bigint, name int")
    assert report["broken.parquet"]["status"] == FAILED and t.read().schema["name"].dataType == T.IntegerType()


def test_parquet_match_modes(spark, folder):
    stage = folder("stage")
    spark.range(3).selectExpr("id as ID", "id * 2 as Other").coalesce(1).write.parquet(stage)
    rows = lambda **kw: sorted(tuple(r) for r in load(spark, folder, stage, fmt=FileFormat.parquet(), columns=C.Columns("id bigint, other bigint", **kw))[0].read().collect())
    assert rows(match="CASE_INSENSITIVE") == [(0, 0), (1, 2), (2, 4)]
    assert rows(match="NONE") == [(0, 0), (1, 2), (2, 4)]


def test_avro_says_what_is_missing(spark, folder):
    from loadkit.sources.formats import avro_available, reader

    if not avro_available(spark):
        with pytest.raises(RuntimeError, match="spark-avro"):
            reader(spark, FileFormat.avro())


def test_duplicate_keys_in_documents(spark, folder):
    stage = folder("stage")
    put(stage, "a.json", '{"id": 1, "value": 1, "k": 1, "k": 2}\n{"id": 2, "value": 1, "k": 3}\n')
    cols = C.Columns(SCHEMA, raw_column="raw")
    t, report = load(spark, folder, stage, columns=cols)
    assert report["a.json"]["errors_seen"] == 1
    t, _ = load(spark, folder, stage, columns=cols, fmt=FileFormat.json(allow_duplicate=True))
    assert sorted(r["k"] for r in t.read().select(F.expr("raw:k::int").alias("k")).collect()) == [2, 3]


def test_policy_by_environment_and_bad_policy():
    assert [C.policy_for(e) for e in ("dev", "staging", "prod")] == ["ABORT_STATEMENT", "SKIP_FILE_10", "CONTINUE"]
    with pytest.raises(ValueError):
        C.Policy.parse("SKIP_EVERYTHING")


def test_pipe_pauses_and_resumes(spark, folder):
    from loadkit.streaming.pipe import Pipe, if_new_files

    stage = folder("stage")
    put(stage, "1.json", CLEAN)
    t = Table(spark, folder("table"))
    pipe = Pipe(spark, "p", stage, JSON, SCHEMA, t, folder("ckpt"), as_of=AS_OF)
    assert pipe.state() == "PAUSED"
    assert if_new_files(spark, stage, t, lambda: "go") == "go"
    pipe.start(1).processAllAvailable()
    assert pipe.state() == "RUNNING" and t.read().count() == 50
    pipe.pause()
    assert pipe.state() == "PAUSED" and if_new_files(spark, stage, t, lambda: "go") is None
    put(stage, "2.json", CLEAN)
    assert pipe.status().head()["pending_files"] == 1
    pipe.resume(1).processAllAvailable()
    pipe.pause()
    assert t.read().count() == 100
    assert pipe.insert_files(["1.json"]).isEmpty() and t.read().count() == 100


def test_working_copies_are_dropped(spark, folder):
    from loadkit.session import work_root
    from loadkit.sources import fs

    stage = folder("stage")
    put(stage, "a.json", CLEAN)
    before = {n for n in fs.children(spark, work_root(spark)) if n.startswith("parsed-")}
    load(spark, folder, stage)
    assert {n for n in fs.children(spark, work_root(spark)) if n.startswith("parsed-")} == before
