import zlib

import numpy as np
import pyarrow as pa
import pytest
from loadkit.llm import packing, queries, token_files
from loadkit.llm.common import slices
from loadkit.llm.tokens import Encoder
from tokenizers import Tokenizer

ODD = ["", " \n", "<|endoftext|> a<|startoftext|>b", "it's don't 'S 12 3.5 x́ ́y", "a!\x1c!b\x85c d", "ﬁ Ǆ İ ẞ ΣΑΣ", "日本語 😀😀", "Word, word. word?! ...", "x" * 50_000, "w " * 100_000]


def ids_of(text, tokenizer=Tokenizer.from_file(queries.VOCABULARY)):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def u4(ids):
    return np.array(ids, "<u4").tobytes()


def test_words_give_the_ids_of_whole_texts(spark, sf):
    encode = Encoder(queries.VOCABULARY)
    found = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = encode([t.encode() for t in found])
    assert [[*np.frombuffer(g, "<u2").tolist(), 1] for g in got] == [ids_of(t) for t in found]


def test_words_of_hard_characters_give_the_ids_of_whole_texts():
    """Every character below U+20000 among marks and letters, and random strings of those that change when lowered or composed."""
    import random

    fast, whole = Encoder(queries.VOCABULARY), Encoder(queries.VOCABULARY, True)
    for low in range(0, 0x20000, 8192):
        found = [f"x {c}! a{c}b {c}{c}? {c}\u0301".encode() for c in map(chr, range(low, low + 8192)) if not 0xD800 <= ord(c) < 0xE000]
        assert fast(found) == whole(found)
    rng, hard = random.Random(1), "\u0130\u0131\u01c5\u00df\u017f\ufb01\u212b\u00c9e\u0301\u0300\u03a3\u03c2\u200b\u00a0\u3000\ufeff\u00ad\uff8a\uff9e\ud55c\u6f22\u5b57\U0001f600\u200d<|>~^'\"?!.,;:()[]{}_-/ab \n\t09\u0663\u2167\u00b2"
    found = ["".join(rng.choices(hard, k=rng.randint(1, 9))).encode() for _ in range(8000)]
    assert any("\u0130".encode() in t for t in found) and fast(found) == whole(found)


def test_files_of_whole_table(spark, sf):
    got = sorted(tuple(r) for r in queries.op4(spark, sf).collect())
    want, start = [], 0
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = ids_of(r.text)
        want.append((r.doc_id, start, len(ids), zlib.crc32(u4(ids))))
        start += len(ids)
    assert got == want


ROWS = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[3]), (3, "other"), (None, "no id"), (None, None), (-7, "minus"), (2**62, "far")]


def test_files_of_odd_rows(spark, folder):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns, an empty table."""
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in ROWS], "doc_id long, text string, id int, shard string")
    where = folder("ids")
    manifest = token_files.write(df, where, queries.VOCABULARY)
    got = token_files.read(manifest).orderBy("start").collect()
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got]).tolist()[:-1]]
    assert sorted(((r.doc_id, bytes(r.ids)) for r in got), key=str) == sorted(((i, u4(ids_of(t))) for i, t in ROWS), key=str)
    for row in manifest.collect():
        found = token_files.lookup(row.asDict(), [3, 2**62, 12345])
        assert 12345 not in found and len(found.get(3, [0] * 3)) == 3
    assert token_files.read(token_files.write(df.limit(0), folder("none"), queries.VOCABULARY)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(-(2**62), 2**62, n))
    index = token_files.Index.unpack(token_files.Index.build(keys, 0, np.ones(len(keys), np.int64), 2).pack())
    assert sorted(index.hash(keys).tolist()) == list(range(len(keys)))
    first, count = index.find(keys)
    assert (first == np.arange(len(keys))).all() and (count == 1).all()
    assert (index.find(keys + 1)[1] == np.isin(keys + 1, keys)).all()


def check_pieces(rows, pieces, window=2048):
    """Each id once, in gapless sequences, with no padding."""
    docs, sequences = {}, {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        docs.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, p.length, bytes(p.ids)))
    for parts in sequences.values():
        total = 0
        for offset, length in sorted(parts):
            assert offset == total and length > 0
            total += length
        assert total <= window and total & (total - 1) == 0
    got = b"".join(sorted(raw for parts in docs.values() for _, _, raw in parts))
    want = [u4(ids_of(t)) for _, t in rows]
    assert len(got) == sum(map(len, want))
    return docs


def test_packing_of_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = check_pieces(rows, packing.pack(docs, queries.VOCABULARY, shard_ids=30_000).collect())
    for i, t in rows:
        (parts,) = [v for (k, _), v in found.items() if k == i]
        assert b"".join(raw for _, _, raw in sorted(parts)) == u4(ids_of(t))


def test_packing_of_odd_rows(spark):
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in ROWS], "doc_id long, text string, id int, ids string")
    check_pieces(ROWS, packing.pack(df, queries.VOCABULARY).collect())
    check_pieces(ROWS, packing.pack(df, queries.VOCABULARY, window=64, shard_ids=100).collect(), 64)
    assert packing.pack(df.limit(0), queries.VOCABULARY).collect() == []


def test_neighbours_follow_their_seed():
    """Documents of three word lists: those of one list stand together."""
    rng = np.random.default_rng(1)
    docs = [np.append(rng.integers(1000 * (i % 3), 1000 * (i % 3) + 40, 100), 1).astype("<u2") for i in range(60)]
    pieces = list(packing.fill(docs, np.ones(4000, np.float32), 101, 512))
    order = [d % 3 for d, start, *_ in pieces if start == 0]
    assert sum(a != b for a, b in zip(order, order[1:], strict=False)) <= 4


def test_scores_are_bm25():
    docs = [np.array(d) for d in ([5, 5, 7, 9], [5, 7, 7], [9, 9, 9, 8], [3])]
    idf = np.linspace(1, 2, 10).astype(np.float32)
    index = packing.Bm25(docs, idf, 3.0)

    def plain(q, d):
        terms = {t for t in docs[q].tolist() if sum(t in x.tolist() for x in docs) > 1}
        tf = {t: docs[d].tolist().count(t) for t in terms}
        return sum(idf[t] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(docs[d]) / 3)) for t, n in tf.items())

    for q in range(4):
        assert np.allclose(index.scores(q), [plain(q, d) for d in range(4)], atol=1e-5)


def recall(docs, shard_ids):
    """Of the best BM25 score of each document over all others, the part that the best of its shard reaches: mean."""
    held = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=1 << 16)
    idf, mean = np.log1p((len(docs) - held + 0.5) / (held + 0.5)), np.mean([len(d) for d in docs])
    keys = packing.Keys(idf, held, mean)(docs, np.arange(len(docs)))
    order = np.lexsort((np.arange(len(docs)), keys))
    shard = np.empty(len(docs), int)
    shard[order] = np.cumsum([len(docs[i]) for i in order]) // shard_ids
    same, index, found = np.array([hash(d.tobytes()) for d in docs]), packing.Bm25(docs, idf, mean), []
    for i in range(0, len(docs), 3):
        scores = index.scores(i) * (same != same[i])
        if scores.max() > 0:
            found.append((scores * (shard == shard[i])).max() / scores.max())
    return np.mean(found)


def test_neighbours_of_the_whole_table_meet_in_shards(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    docs = [np.array([*ids_of(t), 1], "<u2") for t in texts]
    assert recall(docs, sum(map(len, docs)) // 8) >= 0.9


def test_documents_of_one_subject_meet_in_shards():
    """300 subjects of 6 documents with 5 words of their own among 400 common ones; dealt by chance a sixth of the score is lost."""
    rng = np.random.default_rng(3)
    docs = []
    for i in range(1800):
        own = 1000 + 5 * (i % 300) + rng.integers(0, 5, 12)
        docs.append(np.concatenate([rng.integers(10, 410, 60), own, [1]]).astype("<u2"))
    assert recall(docs, 6000) >= 0.9


def test_copies_are_parted_and_keep_their_key():
    docs = [np.array([5, 5, 9, 1])] * 4000 + [np.array([1])]
    keys = packing.Keys(np.ones(10), np.full(10, 2), 4.0)(docs, np.arange(4001))
    assert len({k >> 47 for k in keys[:4000].tolist()}) == 1 and len(set(keys.tolist())) > 3500


def test_few_remembered_words_give_the_same_ids():
    raws = [" ".join(f"w{i * j} Word, {i}" for j in range(20)).encode() for i in range(60)]
    encode = Encoder(queries.VOCABULARY, words=50)
    for raw, ids in zip(raws, Encoder(queries.VOCABULARY)(raws), strict=True):
        assert encode([raw]) == [ids]
        assert len(encode.cache) <= 50


def test_slices_hold_all_rows_in_order():
    batches = [pa.RecordBatch.from_pydict({"text": pa.array([f"{k}.{i}" for i in range(n)], pa.string())}) for k, n in enumerate((0, 3, 7, 1))]
    parts = list(slices(batches, 3))
    assert [p.num_rows for p in parts] == [3, 3, 3, 1, 1]
    assert [x for p in parts for x in p.column("text").to_pylist()] == [x for b in batches for x in b.column("text").to_pylist()]


def test_packing_in_slices_with_few_words_is_the_same(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").coalesce(1)
    many = packing.pack(docs, queries.VOCABULARY).toArrow().to_pylist()
    monkeypatch.setattr(packing, "SENT", 7)
    few = packing.pack(docs, queries.VOCABULARY, words=100).toArrow().to_pylist()
    assert many and sorted(map(repr, few)) == sorted(map(repr, many))
