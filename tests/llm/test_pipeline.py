import random
import zlib
from collections import Counter

import corpus_pipeline as P
import numpy as np
from loadkit.llm import simhash
from pyspark.sql import functions as F

from test_mixing import plain_targets
from test_tokens import check_pieces

SF = "/root/testdata/sf0.001"


def plain_groups(texts):
    """Least index of each text's group: linked by similar sets of five-word shingles."""
    sets = [simhash.shingles((t or "").encode()) for t in texts]
    group = list(range(len(texts)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = sorted((top(i), top(j)))
                group[b] = a
    return [top(i) for i in range(len(texts))]


def near_copies(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(15):
        base = rng.choices(words, k=rng.choice([30, 120, 600]))
        for _ in range(rng.randint(1, 6)):
            text = list(base)
            for _ in range(rng.choice([0, 1, 2, len(base) // 60])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return rows


def test_similar_documents_against_all_pairs(spark):
    for seed in range(2):
        texts = [*near_copies(seed), "", None, " \n", "one two", "one  TWO", "x"]
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        got = {r.id: r.root for r in simhash.similar_documents(df).collect()}
        want = plain_groups(texts)
        assert len(got) == len(texts)
        assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(texts)) for j in range(i))


def test_stages_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    stages = dict(P.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "simhash", "mixing", "packing"]
    before = {r.doc_id: r for r in docs.collect()}
    kept = stages["toxicity"](spark, docs, SF)
    assert kept.columns == docs.columns
    clean = {r.doc_id: r for r in kept.collect()}
    assert all(before[i] == r for i, r in clean.items())
    assert sum(labels.get(i) == 0 for i in before if i not in clean) <= 1
    once = {r.doc_id: r for r in stages["exact_dedup"](spark, docs, SF).collect()}
    lower = lambda t: (t or "").encode().lower()
    newest = {}
    for i, r in before.items():
        newest[lower(r.text)] = max(i, newest.get(lower(r.text), i))
    assert set(once) == set(newest.values())
    apart = stages["simhash"](spark, docs, SF)
    ids = sorted(before)
    groups = plain_groups([before[i].text for i in ids])
    assert sorted(r.doc_id for r in apart.collect()) == sorted({ids[g] for g in groups})


def test_odd_rows_through_all_stages(spark, folder):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing columns, an empty table."""
    rows = [(1, "a b c", "en", "s", 5), (2, None, None, None, None), (3, "", "en", "s", 0), (4, "a b c", "en", None, 5), (4, "a b c", "en", None, 5), (None, "no id here at all", "en", "t", 1), (5, "w x " * 30_000, "en", "s", 1), (6, "A B C", "de", "s", 5)]
    extra = "doc_id long, text string, lang string, source string, n_chars long, score double, _locator string, row long, digest string, size long, shard string, _metadata string"
    df = spark.createDataFrame([(*r, 1.0, "x", 1, "d", 2, "q", "m") for r in rows], extra)
    for name, some in (("some", df), ("none", df.limit(0))):
        path = folder(name)
        some.write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([(1, 0, 0), (4, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        docs = spark.read.parquet(f"{path}/documents.parquet")
        for stage, fn in P.STAGES[:-1]:
            out = fn(spark, docs, path)
            assert out.columns == docs.columns, stage
            out.collect()
        packed = P.run(spark, path).collect()
        held = {r.doc_id for r in packed}
        assert held <= {3, 5, 6, None} and bool(held) == (name == "some")


def test_run_packs_the_mix(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, fn in P.STAGES[:3]:
        docs = fn(spark, docs, SF)
    from loadkit.session import staged

    docs = staged(docs, "kept")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").encode().split())
    mixed = staged(P.STAGES[3][1](spark, docs, SF), "mixed")
    taken = Counter()
    for r in mixed.collect():
        taken[r.source] += len((r.text or "").encode().split())
    target = plain_targets(dict(sizes))
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    pieces = P.STAGES[4][1](spark, mixed, SF)
    from loadkit.llm import packing

    found = packing.pack(mixed, P.VOCABULARY).collect()
    check_pieces([(r.doc_id, r.text) for r in mixed.collect()], found)
    assert sorted((p.ids_crc32, p.length) for p in pieces.collect()) == sorted((zlib.crc32(bytes(p.ids)), p.length) for p in found)
    assert pieces.agg(F.count(F.lit(1))).first()[0] == len(found)


def changed(rng, base, share):
    """`base` with words replaced until about `share` of its five-word shingles is shared by both."""
    text = list(base)
    left = list(range(2, len(text) - 2))
    rng.shuffle(left)
    mine = simhash.shingles(" ".join(base).encode())
    while left:
        text[left.pop()] = f"x{rng.random()}"
        now = simhash.shingles(" ".join(text).encode())
        if len(now & mine) <= share * len(now | mine):
            return text
    return text


def test_no_link_is_lost_in_a_family_of_false_partners(spark):
    """Many texts just below the threshold of each other hide the ones just over it."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(150):
        member = changed(rng, base, 0.86)
        texts += [" ".join(member), " ".join(changed(rng, member, 0.82))]
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.root for r in simhash.similar_documents(df).collect()}
    want = plain_groups(texts)
    assert len(set(want)) > 50
    assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(texts)) for j in range(i))


def test_repeated_lines_hide_no_copy(spark):
    """Texts that differ only in how often a line stands in them: near-equal sets of shingles."""
    rng = random.Random(9)
    texts = []
    for n in [5, 10, 40] * 4:
        words, line = ([f"w{rng.randrange(10**6)}" for _ in range(k)] for k in (200, 12))
        texts += [" ".join(words) + "\n" + "\n".join([" ".join(line)] * k) for k in (1, n)]
    assert any((simhash.simhash(a.encode()) ^ simhash.simhash(b.encode())).bit_count() > simhash.REACH for a, b in zip(texts[::2], texts[1::2], strict=True))
    prints = [simhash.set_fingerprint(simhash.hashes(simhash.shingles(t.encode()))) for t in texts]
    assert all((a ^ b).bit_count() <= simhash.REACH for a, b in zip(prints[::2], prints[1::2], strict=True))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.root for r in simhash.similar_documents(df).collect()}
    assert all(got[i] == got[i + 1] for i in range(0, len(texts), 2)) and len(set(got.values())) == len(texts) // 2


def test_created_frames_lose_no_row(spark):
    """A frame that is no table of files has one set of places, however often it is asked for; columns of such names stay."""
    rows = [(1, "a b c d e f", "s", "mine", "m"), (2, "a B c d e f", "t", "yours", "n"), (3, "z y x w v u", None, "ours", "o")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _locator string, _metadata string")
    assert sorted(r.doc_id for r in P.drop_copies(spark, docs, SF).collect()) == [2, 3]
    assert sorted(r.doc_id for r in P.drop_near_copies(spark, docs, SF).collect()) == [1, 3]
    mixed = P.mix_sources(spark, docs, SF)
    assert mixed.columns == docs.columns
    held = {(r.doc_id, r._locator, r._metadata) for r in mixed.collect()}
    assert held and held <= {(1, "mine", "m"), (2, "yours", "n"), (3, "ours", "o")} and {i for i, *_ in held} == {1, 2, 3}


def plain_parity_bound(a, b):
    x, y = (simhash.hashes(simhash.shingles(" ".join(t).encode())) for t in (a, b))
    (apart,) = simhash._differing([simhash.parity(x)], [simhash.parity(y)], np.array([0]), np.array([0]))
    return int(apart), len(set(x.tolist()) ^ set(y.tolist()))


def test_parity_sketches_never_exceed_the_difference():
    rng = random.Random(3)
    for n in (1, 3, 40, 600, 1020, 1030, 3000, 5000):
        for share in (0, 0.1, 0.5, 1):
            a = [f"w{rng.randrange(5000)}" for _ in range(n)]
            b = [w if rng.random() > share else f"x{rng.random()}" for w in a][: max(1, int(n * rng.choice([1, 0.9, 0.6])))]
            apart, true = plain_parity_bound(a, b)
            assert apart <= true and (apart > 0 or true < 5) and apart % 2 == true % 2


def watched(monkeypatch, name):
    """Rows of the first argument of each call of simhash.`name`."""
    seen, real = [], getattr(simhash, name)

    def spy(first, *rest):
        seen.append(first.count())
        return real(first, *rest)

    monkeypatch.setattr(simhash, name, spy)
    return seen


def test_chance_meetings_make_no_lists(spark, monkeypatch):
    """Unlike texts that share some shingles by chance don't meet, however many shingles the corpus has."""
    rng = random.Random(11)
    words = [[f"u{i}_{k}" for k in range(400)] for i in range(2500)]
    for k in range(6000):
        for i in rng.sample(range(2500), 2):
            words[i][rng.randrange(400) : 0] = [f"c{k}_{j}" for j in range(9)]
    texts = [" ".join(w) for w in words]
    texts.append(" ".join(words[0][:-1]))
    seen = watched(monkeypatch, "blocks_of")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.root for r in simhash.similar_documents(df).collect()}
    assert got[0] == got[2500] and len(set(got.values())) == 2500
    assert seen[0] <= 4


def test_later_rounds_take_lists_with_a_pair_turned_down_only(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(400)]
    texts = [*[" ".join(changed(rng, base, 0.797)) for _ in range(12)], " ".join(base)]
    for k in range(40):  # unlike texts made of one passage, with nothing to check
        passage = [f"p{k}_{i}" for i in range(40)]
        texts += [" ".join(passage + [f"x{k}_{j}_{i}" for i in range(6 * j)]) for j in (1, 4)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = watched(monkeypatch, "blocks_of")
    got = {r.id: r.root for r in simhash.similar_documents(df).collect()}
    want = plain_groups(texts)
    assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(texts)) for j in range(i))
    assert len(seen) > 1 and seen[1] < seen[0] - 20


def test_counted_in_parts_and_chunks(spark, monkeypatch):
    """Rarest shingles are those of a plain count, however they are dealt; words that bits confuse cost nothing."""
    texts = [*near_copies(4), "", None, "", "one two", "x", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = plain_groups(texts)
    for counted, chunk in ((50, 100), (10**6, 1)):
        monkeypatch.setattr(simhash, "COUNTED", counted)
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        got = {r.id: r.root for r in simhash.similar_documents(df).collect()}
        assert len(got) == len(texts)
        assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(texts)) for j in range(i))
