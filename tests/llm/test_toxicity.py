import zlib

import numpy as np
import pytest
from loadkit.llm import queries, toxicity


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def made(n, seed=0):
    """Sentences of made-up words; half of them with an insult, some of these broken up."""
    rng = np.random.default_rng(seed)
    parts = ["the", "on", "er", "st", "ing", "ou", "re", "an", "ti", "ed"]
    word = lambda: "".join(rng.choice(parts, rng.integers(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.integers(5, 40))]
        if i % 2:
            words.insert(rng.integers(len(words)), rng.choice(["moron", "stupid", "worthless", "pathetic"]))
        rows.append((i, " ".join(words) + ".", i % 2))
    return rows


def test_learns_and_bears_gaps():
    model = toxicity.fit([(t, y) for _, t, y in made(600)])
    value = lambda *w: model.probability(model.values(list(w)))
    assert (value("moron", "Stupid!", "st-upid", "stuupid", "mooron", "wortthless", "patthetic") >= 0.7).all()
    assert (value("thering", "another", "stedon", "a", "x", "") < 0.3).all()


def test_features_are_the_kernel():
    """The product of features is the sum over common subsequences of their weights."""
    import itertools

    def plain(w):
        w, out = f"^{w}$", {}
        for at in itertools.combinations(range(len(w)), toxicity.ORDER):
            skipped = at[-1] - at[0] - toxicity.ORDER + 1
            if skipped <= toxicity.SKIPS:
                out.setdefault("".join(w[i] for i in at), []).append(toxicity.DECAY**skipped)
        norm = sum(v * v for vs in out.values() for v in vs) ** 0.5
        return {k: sum(v) / norm for k, v in out.items()}

    words = ["stupid", "stuupid", "lapid", "ab", "moron"]
    which, feature, weight = toxicity.subsequences(words)
    dense = np.zeros((len(words), 1 << toxicity.BITS))
    np.add.at(dense, (which, feature), weight)
    want = [[sum(plain(a).get(k, 0) * v for k, v in plain(b).items()) for b in words] for a in words]
    assert np.allclose(dense @ dense.T, want, atol=1e-9)


@pytest.mark.parametrize("rows", [[], [("a b", 1)], [("a b", 0), ("", 0)], [("", 1), ("", 0)], [("x", 1), ("y", 0)]])
def test_little_to_learn_from(rows):
    model = toxicity.fit(rows)
    assert ((p := model.probability(model.values(["a", "moron"]))) >= 0).all() and (p <= 1).all()


def test_odd_rows(spark):
    """Nulls, empty and long texts, repeated rows and labels, clashing columns, empty tables."""
    rows = [(i, t, 1, "c") for i, t, _ in made(300)] + [(900, None, 1, "c"), (901, "", 1, "c"), (902, "moron", 1, "c"), (None, "moron", 1, "c"), (902, "moron", 1, "c"), (903, "x" * 200_000, 1, "c"), (904, "the on " * 50_000 + "moron", 1, "c"), (905, "1 2 3 \x01\x02", 1, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int, score string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in made(300)] + [(1, 0, 0), (None, 1, 0), (2, None, 0)], "doc_id long, toxic int, text int")
    from pyspark.sql import functions as F

    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.train(docs, labels, held_out)
    got = toxicity.score(docs, model, ["doc_id"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    for r in got:
        if r.doc_id is None or r.doc_id >= 900:
            assert (r.score >= 0.7) == (r.doc_id in (None, 902, 904))
        elif held(r.doc_id):
            assert (r.score >= 0.7) == bool(r.doc_id % 2)
        if r.doc_id == 904:
            assert (r.span_start, r.span_end) == (0, 350_005)
    assert toxicity.score(docs.limit(0), model, ["doc_id"]).collect() == []
    nothing = toxicity.train(docs, labels.limit(0), held_out)
    assert {r.score for r in toxicity.score(docs, nothing, ["doc_id"]).collect()} == {0.0}


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op8(spark, sf).collect()}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if held(r.doc_id)]
    right = sum(got[r.doc_id].predicted == r.toxic for r in labels)
    assert all(r.held_out == held(i) for i, r in got.items())
    assert right >= 0.93 * len(labels)
    assert sum(got[r.doc_id].predicted for r in labels if not r.toxic) <= 1
