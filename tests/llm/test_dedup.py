import hashlib

import pytest
from loadkit.llm import dedup, queries
from pyspark.sql import functions as F

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    """[(id, text)] -> sorted (id, keep_id, size, normalised text)."""
    key = lambda t: (t or "").translate(UPPER)
    groups = {}
    for i, t in rows:
        groups.setdefault(key(t), []).append(i)
    top = lambda ids: max((i for i in ids if i is not None), default=None)
    return sorted(((i, top(groups[key(t)]), len(groups[key(t)])) for i, t in rows), key=str)


def test_whole_table(spark, sf):
    got = queries.op3(spark, sf).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == plain(docs)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)
    texts = dict(docs)
    assert all(r.text_sha256 == hashlib.sha256(texts[r.doc_id].translate(UPPER).encode()).hexdigest() for r in got)


ODD = [(1, None), (2, ""), (3, "A"), (4, "a"), (4, "a"), (4, "a"), (5, "É"), (6, "é"), (None, "a"), (None, "only"), (None, "only"), (7, "x" * 300_000), (8, "X" * 300_000), (9, "İ")]


@pytest.mark.parametrize("files", [True, False])
@pytest.mark.parametrize("digest", [dedup.sha256, lambda t: F.substring(F.sha2(t, 256), 1, 1), lambda t: F.lit("same")])
def test_odd_rows_and_clashes(spark, folder, digest, files):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns; digests that stand for several texts."""
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in ODD], "doc_id long, text string, digest string, id int, _locator int")
    if files:
        df.write.parquet(path := folder())
        df = spark.read.parquet(path)
    got = dedup.exact_duplicates(df, digest=digest).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == plain(ODD)
    assert sum(r.kept for r in got) == len({(t or "").translate(UPPER) for _, t in ODD})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert dedup.exact_duplicates(df.limit(0)).collect() == []


def test_state_goes_on(spark, folder):
    """A second run over the same state sees what the first one kept."""
    state, check, path = folder("state"), folder("check"), folder("rows")
    add = lambda ids: spark.createDataFrame([(f"d{i % 3}", i, f"f#{i}") for i in ids], "digest string, id long, locator string").write.mode("append").parquet(path)
    for ids, want in ((range(5), {"d0": 3, "d1": 4, "d2": 2}), (range(5, 8), {"d0": 6, "d1": 7, "d2": 5})):
        add(ids)
        rows = spark.read.parquet(path)
        rows._work_path = path
        got = {r.digest: r.keep.id for r in dedup.remember(rows, state, check).collect()}
        assert got == want


def test_against_its_sql(spark, sf):
    import oracle

    assert oracle.difference(queries.op3(spark, sf), oracle.connect(sf), queries.ORACLE["op3_exact_dedup"]) is None
