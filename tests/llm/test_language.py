import zlib

import numpy as np
from loadkit.llm import language, queries
from pyspark.sql import functions as F


def plain(text):
    """The bundle by the definition: one sequence after the other."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = np.zeros(language.DIMENSIONS)
    for w in words:
        codes = [0, *map(ord, w), 0]
        for a, b, c in zip(codes, codes[1:], codes[2:], strict=False):
            out += np.roll(language.letter(a), 2).astype(int) * np.roll(language.letter(b), 1) * language.letter(c)
    return out


def test_bundles_are_sums_of_bound_letters():
    texts = ["The cat, the  hat!", "", "42 --", "é", "日本語テキスト x\0y", "İstanbul ÀÉÎ", "a b", "word\n\nword 7word"]
    got = language.bundles(texts, list(range(len(texts))), len(texts))
    assert (got == np.array([plain(t) for t in texts])).all()
    merged = language.bundles(texts, [0, 1, 0, 1, 0, 1, 0, 1], 2)
    assert (merged == np.array([got[0::2].sum(axis=0), got[1::2].sum(axis=0)])).all()


def test_held_out_languages(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op7(spark, sf).collect()
    assert len(got) == len(lang) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    out = [r for r in got if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns, empty tables."""
    rows = [(1, "the thing and that", "en"), (2, "das und nicht", "de"), (3, None, "en"), (4, "", None), (5, "12 !?", "de"), (None, "the and", "xx"), (6, "that thing " * 30_000, None), (6, "that thing", None), (6, "that thing", None), (7, "und das", None)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    model = language.learn(df, F.lit(False) & held_out)
    got = sorted(((str(r.doc_id), r.lang_pred) for r in language.identify(df.where("doc_id IS NOT NULL"), {k: model[k] for k in ("de", "en")}, ["doc_id"]).collect()))
    assert got == [("1", "en"), ("2", "de"), ("3", "und"), ("4", "und"), ("5", "und"), ("6", "en"), ("6", "en"), ("6", "en"), ("7", "de")]
    assert language.identify(df.limit(0), model, ["doc_id"]).collect() == []
    nothing = language.learn(df.limit(0), held_out)
    assert nothing == {} and {r.lang_pred for r in language.identify(df, nothing, ["doc_id"]).collect()} == {"und"}


def test_memory_is_bounded_for_texts_of_many_letters_and_long_texts():
    """A million random Han letters have nearly as many sequences; a text of many chunks is cut at blanks."""
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(1)
    text = "".join(map(chr, rng.integers(0x4E00, 0x9FA0, 1_000_000)))
    tracemalloc.start()
    whole = language.bundles([text], [0], 1)
    assert tracemalloc.get_traced_memory()[1] < 700e6
    tracemalloc.stop()
    parts = [text[:300_000], text[300_000:]]
    # only the sequences around the cut differ
    assert np.abs(whole[0] - language.bundles(parts, [0, 1], 2).sum(axis=0)).max() <= 4
    words = " ".join(["alpha", "beta", "gamma\u03a3", "d"] * 200_000)
    pieces = language._cuts(words)
    assert len(pieces) > 2 and "".join(pieces) == words
    one = language.bundles(["alpha beta gamma\u03a3 d"], [0], 1)
    assert (language.bundles([words], [0], 1) == 200_000 * one).all()
    assert (language.bundles([words, "alpha"], [1, 0], 2)[1] == 200_000 * one[0]).all()
