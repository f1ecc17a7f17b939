"""Loads of text write each row once: bytes, working copies, mixed tables, rejects."""

import os
import random

import pytest
from pyspark.sql import functions as F

from loadkit.operators import copy as C, ledger
from loadkit.operators.versioned import Table
from loadkit.sources.formats import FileFormat
from loadkit.streaming import rowstream as RS

AS_OF = "2024-01-31 00:00:00"
SCHEMA = "id bigint, kind string, at timestamp_ntz, value double"


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs if f.endswith(".parquet"))


def events(spark, n=120_000):
    return spark.range(n).select("id", F.concat(F.lit("k"), F.col("id") % 7).alias("kind"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id)").alias("at"), F.rand(3).alias("value"))


@pytest.mark.parametrize("kind", ["json", "csv"])
def test_a_load_writes_little_more_than_its_rows(spark, folder, monkeypatch, kind):
    stage, plain, t = folder("stage"), folder("plain"), Table(spark, folder("t"))
    rows = events(spark).repartition(4)
    rows.write.format(kind).save(stage)
    fmt = FileFormat.json() if kind == "json" else FileFormat.csv(skip_header=0)
    monkeypatch.setattr(C, "staged", lambda *a: pytest.fail("a working copy is written"))
    report = C.copy_into(spark, t, stage, fmt, SCHEMA, AS_OF, on_error="CONTINUE", pattern=r".*part-.*").collect()
    assert {r.status for r in report} == {"LOADED"} and sum(r.rows_loaded for r in report) == 120_000
    t.read().write.parquet(plain)
    assert size(f"{t.path}/data") <= 1.1 * size(plain)
    assert sorted(t.read().collect()) == sorted(rows.collect())


def staged_files(spark, folder, seed=1):
    rng, stage = random.Random(seed), folder("stage")
    os.makedirs(stage.removeprefix("file:"))
    want = {}
    for f in range(6):
        lines, good, first = [], [], None
        for n in range(40):
            bad = f in (1, 4) and rng.random() < 0.2 or f == 5
            i = 100 * f + n
            lines.append(f'{{"id": {"x" if bad else ""}{i}, "kind": "k", "at": "2024-01-01 00:00:00", "value": 1.5}}' if not bad else f'{{"id": "x{i}", "kind": "k"}}')
            if bad:
                first = first or n + 1
            else:
                good.append(i)
        with open(f"{stage.removeprefix('file:')}/{f}.json", "w") as out:
            out.write("\n".join(lines) + "\n")
        want[f"{f}.json"] = (40, good, first)
    return stage, want


@pytest.mark.parametrize("policy", ["CONTINUE", "SKIP_FILE", "SKIP_FILE_5", "ABORT_STATEMENT"])
def test_policies_and_reports(spark, folder, policy):
    stage, want = staged_files(spark, folder)
    t = Table(spark, folder("t"))
    load = lambda: C.copy_into(spark, t, stage, FileFormat.json(), SCHEMA, AS_OF, on_error=policy, where=F.col("id") % 2 == 0)
    if policy == "ABORT_STATEMENT":
        with pytest.raises(C.LoadAborted):
            load()
        assert t.current() is None and size(f"{t.path}/data") == 0
        return
    limit = {"CONTINUE": 10**9, "SKIP_FILE": 0, "SKIP_FILE_5": 5}[policy]
    kept = []
    for r in load().collect():
        n, good, first = want[r.file]
        even = [i for i in good if i % 2 == 0]
        fails = n - len(good) > limit
        assert (r.rows_parsed, r.errors_seen, r.first_error_line) == (n, n - len(good), first)
        assert r.rows_loaded == (0 if fails else len(even))
        kept += [] if fails else even
    assert sorted(r.id for r in t.read().collect()) == sorted(kept)
    assert t.current()["rows"] == len(kept) and not t.committed_loads().isEmpty()
    assert RS.consume(t, "c", lambda rows: None) == len(kept)
    assert ledger.history(t).count() == 6
    assert C.copy_into(spark, t, stage, FileFormat.json(), SCHEMA, AS_OF, on_error=policy, files=["0.json", "2.json"]).isEmpty()


def test_loads_of_all_kinds_in_one_table(spark, folder):
    stage, want = staged_files(spark, folder)
    t = Table(spark, folder("t"))
    C.copy_into(spark, t, stage, FileFormat.json(), SCHEMA, AS_OF, on_error="CONTINUE", files=["0.json"])
    t.append(events(spark, 10), AS_OF)
    C.copy_into(spark, t, stage, FileFormat.json(), SCHEMA, AS_OF, on_error="CONTINUE", files=["1.json", "5.json"])
    ids = sorted([*want["0.json"][1], *want["1.json"][1], *range(10)])
    assert sorted(r.id for r in t.read().collect()) == ids and t.current()["rows"] == len(ids)
    assert t.files().agg(F.sum("record_count")).first()[0] == len(ids)
    t.compact(AS_OF, where=F.col("id") == 3)
    assert sorted(r.id for r in t.read().collect()) == ids
    t.compact(AS_OF)
    t.expire("2025-01-01 00:00:00")
    assert sorted(r.id for r in t.read().collect()) == ids and len(os.listdir(f"{t.path.removeprefix('file:')}/data")) == 1


def test_rejects_are_those_of_a_validation(spark, folder):
    stage, want = staged_files(spark, folder)
    t = Table(spark, folder("t"))
    report, rejects = C.load_with_capture(spark, t, stage, FileFormat.json(), SCHEMA, AS_OF, "t")
    other = C.validate(spark, stage, FileFormat.json(), SCHEMA, "RETURN_ALL_ERRORS")
    assert rejects.count() == other.count() == sum(n - len(g) for n, g, _ in want.values())
    assert sorted(r.line for r in other.collect()) == sorted(r.line for r in C.errors_of(spark.read.schema(C._PLACE_SCHEMA).parquet(f"{t.path}/data/load_id={t.current()['load_id']}")).collect())
    again, none = C.load_with_capture(spark, t, stage, FileFormat.json(), SCHEMA, AS_OF, "t")
    assert again.collect() == [] or {r.status for r in again.collect()} == {"LOAD_FAILED"}
