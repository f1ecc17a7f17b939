import hashlib
import random
import zlib

import numpy as np
from loadkit.llm import queries, runs


def plain_runs(words, least=6, exponent=4):
    n, out = len(words), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(least, exponent * q):
                part = words[i : i + size]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.add((i, size, q))
            i = j + 1
    return sorted(out)


def plain_lyndon(symbols):
    longest = []
    for i in range(len(symbols)):
        ends = [k for k in range(i + 1, len(symbols) + 1) if all(symbols[i:k] < symbols[m:k] for m in range(i + 1, k))]
        longest.append(ends[-1] - i)
    return longest


def some_texts(rng, kinds):
    texts = [[rng.randrange(kinds) for _ in range(rng.choice([0, 1, 2, 7, 15, 40]))] for _ in range(rng.randint(1, 3))]
    for t in texts:
        if len(t) > 5 and rng.random() < 0.5:
            a, p = rng.randrange(len(t)), rng.randint(1, 5)
            for i in range(a, len(t)):
                t[i] = t[a + (i - a) % p]
    return texts


def test_lyndon_arrays_of_both_orders():
    rng = random.Random(1)
    for _ in range(300):
        texts = some_texts(rng, rng.choice([1, 2, 3, 6]))
        symbols = np.array([s for t in texts for s in [*t, -1]], np.int64)
        for reverse, sign in ((False, 1), (True, -1)):
            length, number = runs.lyndon(symbols, reverse)
            assert length.tolist() == [x for t in texts for x in [*plain_lyndon([sign * s for s in t]), 0]]
            words = {}
            for i, (size, g) in enumerate(zip(length.tolist(), number.tolist(), strict=True)):
                if g >= 0:
                    assert words.setdefault(g, tuple(symbols[i : i + size])) == tuple(symbols[i : i + size])
            assert len(set(words.values())) == len(words)


def test_runs_against_all_periods():
    rng = random.Random(2)
    for _ in range(1500):
        texts = some_texts(rng, rng.choice([1, 2, 2, 3, 5]))
        symbols = np.array([s for t in texts for s in [*t, -1]], np.int64)
        for least, exponent in ((6, 4), (2, 2), (1, 3)):
            want, at = [], 0
            for t in texts:
                want += [(i + at, n, q) for i, n, q in plain_runs(t, least, exponent)]
                at += len(t) + 1
            assert list(map(tuple, runs.runs(symbols, least, exponent).tolist())) == want


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    top = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    told = sha("".join(f"{s},{size},{q}\n" for s, size, q in found).encode())
    return (doc_id, len(found), *top, None if top[0] is None else 1000 * top[1] // top[2], told, sha(kept))


def rows_of(df):
    return [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in df.collect()]


def test_whole_table(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if len(r.text) < 4000]
    got = {r[0]: r for r in rows_of(queries.op11(spark, sf))}
    want = [plain_row(*d) for d in docs]
    assert len(want) > 100 and all(got[r[0]] == r for r in want)
    assert sum(r[1] for r in want) >= 5
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_odd_rows(spark, folder):
    """Nulls, empty texts, blanks of other kinds, equal rows, a long text of one run, clashing columns, an empty table."""
    planted = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts = {i: " ".join(f"w{k % (i + 3)}" for k in range(5 + 3 * i)) for i in planted}
    rows = [(None, "a a a a a a"), (1, None), (2, ""), (3, " \t\n "), (4, "a b \x0b c\x1cd"), (4, "a b \x0b c\x1cd"), (5, "x y " * 200_000), (planted[0], None), (planted[1], "one"), *texts.items()]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, runs int, _text string")
    df.write.parquet(f"{(path := folder('some'))}/documents.parquet")
    key = lambda r: (r[0] is not None, r[0] or 0, r[7])
    short = [(i, t) for i, t in rows if i != 5]
    got = sorted(rows_of(queries.op11(spark, path)), key=key)
    assert [r for r in got if r[0] != 5] == sorted((plain_row(*r) for r in short), key=key)
    (long,) = [r for r in got if r[0] == 5]
    assert long[1:6] == (1, 0, 400_000, 2, 200_000_000) and long[7] == hashlib.sha256(b"x y").hexdigest()
    df.limit(0).write.parquet(f"{(path := folder('none'))}/documents.parquet")
    assert queries.op11(spark, path).collect() == []


def test_time_grows_with_the_text():
    """Texts that are hard for naive ways: one word, all words different, long periods, Fibonacci words."""
    import time

    fib = ["a", "ab"]
    while len(fib[-1]) < 100_000:
        fib.append(fib[-1] + fib[-2])
    known = {}
    for words in (["a"] * 100_000, list(range(100_000)), list(range(99_999, -1, -1)), [k % 33_000 for k in range(100_000)], list(fib[-1])):
        symbols = np.array([*[known.setdefault(w, len(known)) for w in words], -1], np.int64)
        start = time.process_time()
        runs.runs(symbols)
        assert time.process_time() - start < 10
