import hashlib
import random
import zlib

import pytest
from loadkit.llm import manifest, queries


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def written(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def path(tree, r):
    """(side, sibling) level by level."""
    out = []
    for level in tree[:-1]:
        other = r ^ 1
        out.append(("-", "") if other >= len(level) else ("L" if other < r else "R", level[other]))
        r //= 2
    return out


def plain(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    trees = {}
    for i, text, lang, source, n in rows:
        crc = zlib.crc32(str(i).encode()) if i is not None else 1
        touched = n + 1 if n is not None and crc % 7 == 0 else n
        trees.setdefault(lang, []).append((i, written(i, source, lang, n, text), written(i, source, lang, touched, text)))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in langs:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
        built[lang] = levels([leaf for _, leaf, _ in trees[lang]])
    over = levels([built[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for r, (i, leaf, altered) in enumerate(trees[lang]):
            steps = path(built[lang], r) + path(over, k)
            own = altered
            for side, other in steps:
                own = sha(own if side == "-" else other + own if side == "L" else own + other)
            out.append((i, leaf, built[lang][-1][0], over[-1][0], sha("".join(o for _, o in steps)), own, own == over[-1][0]))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def got(df):
    rows = [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def put(spark, where, rows):
    spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, tree string, rank int").repartition(4).write.parquet(f"{where}/documents.parquet")
    return where


@pytest.mark.parametrize("deep", [1, 2, 8])
def test_trees_of_many_sizes(spark, folder, deep):
    """Buckets of one, two and eight levels give the same digests, for trees of 1 to 70 leaves."""
    rng = random.Random(deep)
    rows, ids = [], rng.sample(range(-5000, 5000), 400)
    for lang, n in ((None, 1), ("a", 2), ("b", 3), ("é", 33), ("c", 64), ("z" * 40, 65), ("d", 70), ("", 5)):
        rows += [(ids.pop(), f"text {rng.random()}", lang, rng.choice([None, "s", "ü"]), rng.choice([None, 7, 10**12])) for _ in range(n)]
    rng.shuffle(rows)
    docs = spark.read.parquet(f"{put(spark, folder(), rows)}/documents.parquet")
    _, proved = manifest.manifest(docs, "lang", "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], {"n_chars": queries.touched()}, deep)
    assert got(queries.proof_digests(proved)) == plain(rows)


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    found = got(queries.op13(spark, sf))
    assert found == plain(rows)
    assert {r[-1] for r in found} == {True, False}


def test_nodes_carry_intervals(spark, folder):
    rows = [(i, f"t{i}", "a" if i % 3 else None, "s", i) for i in range(1000)]
    docs = spark.read.parquet(f"{put(spark, folder(), rows)}/documents.parquet")
    blocks, proved = manifest.manifest(docs, "lang", "doc_id", ["doc_id", "text"])
    nodes = manifest.nodes(blocks).collect()
    for tree, n in (("", 334), ("=a", 666), ("top", 2)):
        mine = [r for r in nodes if r.tree == tree]
        assert len({(r.level, r.low) for r in mine}) == len(mine)
        for level in range((n - 1).bit_length() + 1):
            spans = sorted((r.low, r.high) for r in mine if r.level == level)
            assert spans == [(a, min(a + (1 << level), n)) for a in range(0, n, 1 << level)]
        by = {(r.level, r.low): r for r in mine}
        for r in mine:
            if r.level:
                below = [by[r.level - 1, a] for a in range(r.low, r.high, 1 << (r.level - 1))]
                assert r.digest == sha("".join(b.digest for b in below)) and (below[0].low, below[-1].high) == (r.low, r.high)
    back = manifest.folded(proved, "digest", "again").collect()
    assert len(back) == 1000 and all(r.again == r.root for r in back)


def test_odd_rows(spark, folder):
    """Nulls in every column, equal ids, rows repeated many times, a long text, one row, an empty table."""
    rows = [(None, None, None, None, None), (None, "x", None, None, 3), (1, "", "", "", 0), (1, "", "", "", 0), (1, "b", "", "", 0), (2, "w " * 500_000, "en", "s", 1), *[(7, "same", "en", "s", 4)] * 600]
    assert got(queries.op13(spark, put(spark, folder("some"), rows))) == plain(rows)
    assert got(queries.op13(spark, put(spark, folder("one"), rows[2:3]))) == plain(rows[2:3])
    assert got(queries.op13(spark, put(spark, folder("none"), rows[:0]))) == []
