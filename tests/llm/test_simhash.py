import random

import pytest
import xxhash
from loadkit.llm import queries, simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """[(id, fingerprint)] -> smallest id per row, by comparing all."""
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 2:
                group[top(i)] = top(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[top(i)] = min(key, low.get(top(i), key))
    return [low.get(top(i)) for i in range(len(rows))]


def test_whole_table(spark, sf):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op10(spark, sf).collect()}
    docs = sorted((r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    want = plain_components(docs)
    assert got == {k: (f"{fp:016x}", c) for (k, fp), c in zip(docs, want, strict=True)}


def test_odd_rows(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns."""
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (5, "ONE"), (None, "one"), (None, "alone here now yes"), (6, "É é"), (7, "w " * 100_000), (8, None)]
    df = spark.createDataFrame([(i, t, 0, 1) for i, t in rows], "doc_id long, text string, fp int, tile int")
    got = sorted(((r.doc_id, r.fp & (2**64 - 1), r.component) for r in simhash.near_duplicates(df).collect()), key=str)
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    assert got == sorted(((i, fp, c) for (i, fp), c in zip(fps, plain_components(fps), strict=True)), key=str)
    assert simhash.near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_links_lose_nothing(spark, seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(20)} | {0, 2**64 - 1}
    fps = sorted(f - (f >> 63 << 64) for f in fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    from loadkit.llm.components import components

    roots = {r.node: r.root for r in components(simhash.linked(df)).collect()}
    want = plain_components([(f, f & (2**64 - 1)) for f in fps])
    assert [roots.get(f, f) for f in fps] == want


def test_dense_group_gives_few_links():
    import numpy as np

    x = np.array([1 << i for i in range(60)], np.int64)
    a, b = simhash.spanning(x, x, 2)
    assert len(a) == 59 and set(b) == {1}
