import hashlib

from loadkit.llm import merkle, queries
from pyspark.sql import functions as F


def check(spark, rows, got):
    """rows: [(id, text)] without equal ids."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    following = {i: (rows[(k + 1) % len(rows)][1] or "") for k, (i, _) in enumerate(rows)}
    prints = {}
    assert len(got) == len(rows)
    for r in got:
        text = dict(rows)[r.doc_id] or ""
        n = len(text)
        want = text[: n - n // 2] + following[r.doc_id][: n // 2]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.edited_fingerprint == r.fingerprint) == (want == text)
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)


def test_whole_table(spark, sf):
    got = queries.op6(spark, sf).collect()
    check(spark, [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()], got)
    assert sum(r.near_edited for r in got) > sum(r.near_next for r in got) + 0.2 * len(got)


def test_odd_rows(spark, folder):
    """Nulls, empty and long texts, clashing columns, one row, an empty table."""
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, "É. é! 😀? " * 20_000), (-5, "one"), (None, "no id. at all"), (7, "a\nb\nc"), (9, "one")]
    for n, some in enumerate([rows, rows[:1], rows[3:5], [(i, f"t{i}") for i in range(300)]]):
        df = spark.createDataFrame([(i, t, "x", 1) for i, t in some], "doc_id long, text string, fingerprint string, _slice int")
        df.write.parquet(f"{(path := folder(str(n)))}/documents.parquet")
        check(spark, some, queries.op6(spark, path).collect())
    df.limit(0).write.parquet(f"{(path := folder('none'))}/documents.parquet")
    assert queries.op6(spark, path).collect() == []


def test_repeated_rows_are_returned_each(spark, folder):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "doc_id long, text string")
    df.write.parquet(f"{(path := folder())}/documents.parquet")
    assert len(queries.op6(spark, path).collect()) == 5


def test_edits_are_located(spark):
    lines = [f"line {i} of the text.\n" for i in range(60)]
    other = [*lines[:30], "something else.\n", *lines[31:]]
    df = spark.createDataFrame([("".join(lines), "".join(other))], "a string, b string")
    df = merkle.with_fingerprint(merkle.with_fingerprint(df, "a", "fa"), "b", "fb")
    row = df.select("fa", merkle.edits(F.col("fa"), F.col("fb")).alias("e"), merkle.edits(F.col("fa"), F.col("fa")).alias("same"), merkle.likeness(F.col("fa"), F.col("fb")).alias("l")).first()
    groups = [g.split(",") for g in row.fa.split(":")[2].split(";")]
    assert sum(map(len, groups)) == 60 and len(groups) > 3
    ((section, passage),) = row.e
    assert sum(map(len, groups[:section])) + passage == 30
    assert row.same == [] and abs(row.l - 59 / 60) < 1e-9
    nodes = [hashlib.md5(",".join(g).encode()).hexdigest()[:16] for g in groups]
    assert row.fa.split(":")[1].split(",") == nodes
    assert row.fa.split(":")[0] == hashlib.md5(",".join(nodes).encode()).hexdigest()
