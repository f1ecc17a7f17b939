import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from loadkit.llm import mixing, queries


def plain_targets(sizes):
    """{source: size} -> target by resharing what is over, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values())
    while left > 1e-6:
        free = [s for s in order if target[s] < 2 * sizes[s] - 1e-9]
        if not free:
            break
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = 0
        for s in order:
            left += max(0, target[s] - 2 * sizes[s])
            target[s] = min(target[s], 2 * sizes[s])
    return target


def check(rows, got):
    """rows: (id, text, source); got: rows of op1's shape with id."""
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    target = plain_targets(sizes)
    taken = Counter()
    by_id = {i: s for i, _, s in rows}
    for r in got:
        s = by_id[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6 * max(1, target[s])
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)


def test_whole_table(spark, sf):
    got = queries.op1(spark, sf).collect()
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert len(got) == len(rows)
    check(rows, got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, queries.op1(spark, sf).collect()))


ROWS = [(1, "a b c", "x"), (2, None, "x"), (3, "", "y"), (4, "w " * 60_000, None), (5, "w", "zé"), (6, "o n e", "Z"), (6, "o n e", "Z"), (7, " \t", "only blank"), (8, "p q", ""), (9, "  a", "b")]


def test_odd_rows(spark, folder):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns, an empty table."""
    df = spark.createDataFrame([(*r, 5, "t", 1.0) for r in ROWS], "doc_id long, text string, source string, size int, draw string, target double")
    df.write.parquet(f"{(path := folder())}/documents.parquet")
    got = queries.op1(spark, path).collect()
    assert len(got) == len(ROWS)
    check(ROWS, got)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = Counter()
    for r in got:
        want[r.doc_id] += r.taken
    assert {k: v for k, v in words.items() if v} == {k: v for k, v in want.items() if v}
    assert mixing.mixed_documents(docs.limit(0)).collect() == []


@pytest.mark.parametrize(("quotas", "shards"), [([5, 0, 3], 1), ([1000, 10, 1, 0], 7), ([3], 5), ([5 * 10**9, 7 * 10**8, 3], 64)])
def test_tree_splits_exactly(quotas, shards):
    tree = mixing.SplittingTree(np.array(quotas), shards)
    leaves = tree.leaves()
    assert (leaves >= 0).all() and (leaves.sum(axis=0) == quotas).all()
    assert leaves.sum(axis=1).max() - leaves.sum(axis=1).min() <= 1
    if sum(quotas) < 10**5:
        source = np.repeat(np.arange(len(quotas)), quotas)
        rank = np.concatenate([np.arange(q) for q in quotas])
        found = mixing.SplittingTree(np.array(quotas), shards).find(source, rank)
        for i in range(len(quotas)):
            assert (np.bincount(found[source == i], minlength=shards) == leaves[:, i]).all()
            assert (np.diff(found[source == i]) >= 0).all()


def test_tree_draws_like_sampling_without_replacement():
    """Mean and variance of a leaf's quota are the hypergeometric ones."""
    got = np.array([mixing.SplittingTree(np.array([300, 100]), 4, seed).leaves()[0, 0] for seed in range(1500)])
    mean, var = 100 * 0.75, 100 * 0.75 * 0.25 * 300 / 399
    assert abs(got.mean() - mean) < 4 * (var / 1500) ** 0.5 and 0.85 < got.var() / var < 1.15
