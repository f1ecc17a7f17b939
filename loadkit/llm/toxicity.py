"""Toxicity by a support vector machine on a string kernel of gapped subsequences."""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_batch, remembered, texts

#: Labelled documents that are learned from at most, of each label, by a hash of their id.
SAMPLE = {1: 1000, 0: 2000}
LANDMARKS = 1000
#: Letters of a subsequence, letters skipped within one at most, and the weight of each skipped.
ORDER, SKIPS, DECAY = 4, 2, 0.6
ROUNDS = 4
#: Negatives of each kind, and the chance that some word seems telling by accident.
NEGATIVES, CHANCE = 2500, 0.01
RIDGE = 1e-2
THRESHOLD = 0.7
#: Words that a Python worker remembers; then it starts anew.
CACHE = 400_000
#: Features are hashed to so many bits.
BITS = 20
_OPEN, _CLOSE, _OTHER, _LETTERS = 27, 28, 29, 64
_STEPS = [s for s in itertools.product(range(1, SKIPS + 2), repeat=ORDER - 1) if sum(s) <= ORDER - 1 + SKIPS]
_SENTENCE = re.compile(r"[.!?\n]")
_table: list = []


def letters() -> np.ndarray:
    """Number of each code point: a-z 1 to 26, word ends 27 and 28, other letters from 29 on by remainder, else 0."""
    if not _table:
        codes = np.arange(0x110000)
        alpha = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        numbers = np.where(alpha, _OTHER + codes % (_LETTERS - _OTHER), 0).astype(np.uint8)
        numbers[97:123] = np.arange(1, 27)
        numbers[1], numbers[2] = _OPEN, _CLOSE
        _table.append(numbers)
    return _table[0]


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, feature, weight) of every subsequence of ORDER letters with SKIPS skipped at most, in lower case.

    Characters that are not letters are passed over. Weights are divided by their norm over all
    places of a word of that length, so that the kernel (the product of two words' features) is
    about 1 between equal words.
    """
    joined = ("\1" + "\2\1".join(w.replace("\1", "").replace("\2", "") for w in words) + "\2").lower()
    numbers = letters()[np.frombuffer(joined.encode("utf-32-le"), "<u4")]
    owner = np.cumsum(numbers == _OPEN) - 1
    kept = numbers > 0
    numbers, owner = numbers[kept].astype(np.int64), owner[kept]
    which, feature, weight = [], [], []
    norm = np.zeros(len(words))
    for steps in _STEPS:
        n = len(numbers) - sum(steps)
        if n <= 0:
            continue
        ok = np.nonzero(owner[:n] == owner[sum(steps) :])[0]
        code, at, worth = numbers[ok], ok, DECAY ** (sum(steps) - ORDER + 1)
        for step in steps:
            at = at + step
            code = code * _LETTERS + numbers[at]
        which.append(owner[ok])
        feature.append(((code * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - BITS))
        weight.append(np.full(len(ok), worth))
        norm += np.bincount(which[-1], minlength=len(words)) * worth**2
    which, feature, weight = np.concatenate(which or [np.zeros(0, np.int64)]), np.concatenate(feature or [np.zeros(0, np.int64)]), np.concatenate(weight or [np.zeros(0)])
    return which, feature, weight / np.sqrt(norm[which])


@dataclass
class Model:
    """A word's value is the sum of its features' weights, plus bias; a text's probability
    follows from the largest value of its words. `constant` is used when nothing was learned."""

    weights: np.ndarray
    bias: float = 0.0
    slope: float = 0.0
    offset: float = 0.0
    constant: float | None = None

    def values(self, words: list[str]) -> np.ndarray:
        out = np.full(len(words), self.bias)
        for low in range(0, len(words), 4_000):
            which, feature, weight = subsequences(words[low : low + 4_000])
            found = np.bincount(which, self.weights[feature] * weight)
            out[low : low + len(found)] += found
        return out

    def probability(self, value) -> np.ndarray:
        if self.constant is not None:
            return np.full(np.shape(value), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * np.asarray(value) + self.offset, -30, 30)))


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss: Newton steps over the violated rows."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w, violated = np.zeros(z.shape[1]), np.ones(len(z), bool)
    penalty = ridge * np.eye(z.shape[1])
    penalty[-1, -1] = 1e-6
    for _ in range(30):
        zs = z[violated] * weight[violated, None]
        w = np.linalg.solve(zs.T @ z[violated] + penalty, zs.T @ y[violated])
        now = y * (z @ w) < 1
        if (now == violated).all():
            break
        violated = now
    return w[:-1], w[-1]


def words_of(text: str) -> list[str]:
    return text.lower().split()


def fit(rows: list[tuple[str, int]], landmarks: int = LANDMARKS) -> Model:
    """Learn from (text, label).

    A text labelled 1 has a sentence, and in it a word, that makes it so; which one is unknown
    (multiple-instance learning). Positives are the words whose texts are labelled 1 more often
    than chance allows among so many words, and, in texts that have none of them, the word that
    the machine of the round before values most, if it does at all. Negatives are the words of
    texts labelled 0 that it takes for the worst, and some others. Landmarks are telling words,
    common words and the hardest negatives; words are mapped by their kernel to the landmarks,
    whitened by the landmarks' own kernel (Nyström).
    """
    size = 1 << BITS
    number: dict[str, int] = {}
    holds = [(np.array([number.setdefault(w, len(number)) for w in b], np.int64), y) for b, y in apart(rows)]
    words = list(number)
    share = np.mean([y for _, y in holds]) if holds else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(size, np.float32), constant=float(share))
    seen = {y: np.bincount(np.concatenate([h for h, k in holds if k == y] or [np.zeros(0, np.int64)]), minlength=len(words)) for y in (0, 1)}
    n1, n0 = (sum(y == k for _, y in holds) for k in (1, 0))
    part = n1 / (n1 + n0)
    both = seen[1] + seen[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        evidence = np.nan_to_num(seen[1] * np.log(seen[1] / both / part)) + np.nan_to_num(seen[0] * np.log(seen[0] / both / (1 - part)))
    evidence[seen[1] <= both * part] = 0
    telling = (evidence > np.log(len(words) / CHANCE)) & (seen[1] > 10 * seen[0] * n1 / n0)
    if not telling.any():
        telling = (evidence > 0) & (evidence == evidence.max())
    clean = np.nonzero((seen[0] > 0) & ~telling)[0]
    chosen = np.union1d(np.nonzero(telling)[0][np.argsort(-evidence[telling], kind="stable")[: landmarks // 2]], clean[np.argsort(-seen[0][clean], kind="stable")[: landmarks // 4]])
    common = clean[np.argsort(-seen[0][clean], kind="stable")[:NEGATIVES]]
    value = evidence
    for turn in range(ROUNDS):
        hard = clean[np.argsort(-value[clean], kind="stable")[:NEGATIVES]]
        witness = []
        if turn:
            chosen = np.union1d(chosen, hard[: landmarks // 4 // (ROUNDS - 1)])
            best = [h[np.argmax(value[h])] for h, y in holds if y and len(h) and not telling[h].any()]
            witness = [w for w in best if value[w] > 0 and not seen[0][w]]
        positive = np.union1d(np.nonzero(telling)[0], np.array(witness, np.int64))
        negative = np.union1d(np.union1d(hard, common), clean[:: max(1, len(clean) // NEGATIVES)])
        rows_ = np.concatenate([positive, negative])
        y = np.where(np.arange(len(rows_)) < len(positive), 1.0, -1.0)
        used, table = _dense([words[i] for i in chosen])
        if not len(used):
            return Model(np.zeros(size, np.float32), constant=float(share))
        near = _kernel([words[i] for i in rows_], used, table)
        values, vectors = np.linalg.eigh(_kernel([words[i] for i in chosen], used, table))
        whiten = vectors[:, values > 1e-6] / np.sqrt(values[values > 1e-6])
        each = np.where(y > 0, np.sqrt(len(negative) / max(1, len(positive))), 1.0)
        u, bias = svm(near @ whiten, y, each)
        model = Model(np.zeros(size, np.float32), float(bias))
        model.weights[used] = table @ (whiten @ u)
        value = model.values(words)
    worst = np.array([value[h].max() if len(h) else bias for h, _ in holds])
    model.slope, model.offset = _logistic(worst, np.array([y for _, y in holds], float))
    return model


def apart(rows: list[tuple[str, int]], hashes: int = 16) -> Iterator[tuple[list[str], int]]:
    """Words of each text, but for texts that share half of their smallest word hashes with an earlier one."""
    held: dict[tuple[int, int], list[int]] = {}
    for i, (text, label) in enumerate(rows):
        words = sorted(set(words_of(text)))
        base = np.array([zlib.crc32(w.encode()) for w in words] or [0], np.uint64)
        lows = [(k, int(((base * np.uint64(2 * k + 0x9E3779B1) + np.uint64(k * 0x85EBCA6B)) % np.uint64(4294967291)).min())) for k in range(hashes)]
        met = Counter(i for low in lows for i in held.get(low, ()))
        if not met or 2 * max(met.values()) < hashes:
            for low in lows:
                held.setdefault(low, []).append(i)
            yield words, label


def _dense(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features that the words have, and their weight by feature and word."""
    which, feature, weight = subsequences(words)
    used, row = np.unique(feature, return_inverse=True)
    table = np.zeros((len(used), len(words)), np.float32)
    np.add.at(table, (row, which), weight)
    return used, table


def _kernel(words: list[str], used: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Kernel of the words with those of `table`."""
    place = np.full(1 << BITS, -1, np.int32)
    place[used] = np.arange(len(used))
    out = np.zeros((len(words), table.shape[1]))
    for low in range(0, len(words), 256):
        which, feature, weight = subsequences(words[low : low + 256])
        at = place[feature] >= 0
        part = np.zeros((min(256, len(words) - low), len(used)), np.float32)
        np.add.at(part, (which[at], place[feature[at]]), weight[at])
        out[low : low + 256] = part @ table
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the label's log odds; targets a little inside 0 and 1, so that both stay finite."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z, w = np.stack([x, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + 1e-4 * np.eye(2), z.T @ (target - p) - 1e-4 * w)
        w += np.clip(step, -5, 5)
        if abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text: str = "text") -> Model:
    """Learn from labelled documents that are not `held_out`: SAMPLE of each label at most, by a hash of the id.

    Labels of an id that has several count as 1 if any is; null labels and ids tell nothing.
    The sample's ids are few by that bound, so they are sent to every task.
    """
    told = labels.select(F.col(id_col).alias("id"), "toxic").where(~held_out & F.col("id").isNotNull() & F.col("toxic").isNotNull())
    told = told.groupBy("id").agg(F.max("toxic").cast("int").alias("toxic"))
    parts = [told.where(F.col("toxic") == y).orderBy(F.xxhash64("id"), "id").limit(n) for y, n in SAMPLE.items()]
    chosen = parts[0].unionByName(parts[1])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id").dropDuplicates(["id"])
    return fit(sorted((r.text or "", r.toxic) for r in rows.select("text", "toxic").collect()))


def score(docs: DataFrame, model: Model, keys: list, text: str = "text") -> DataFrame:
    """`keys`, score, and of texts at or over THRESHOLD the worst sentence's place (span_start,
    span_end: code points). Null and empty texts have the score of a text without any such word."""
    kept = docs.select(*keys, F.col(text).alias("_text"))
    names = kept.columns[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    name = f"{hash(model.weights.tobytes())}:{model.bias}"

    def fn(batch):
        cache, found = remembered(name, dict), texts(batch.column("_text"))
        worst, start, end = [], [], []
        for t in found:
            split = t.lower().split()
            values = list(map(cache.get, split))
            if None in values:
                new = list({w for w, v in zip(split, values, strict=True) if v is None})
                fresh = dict(zip(new, model.values(new).tolist(), strict=True))
                cache.update(fresh)
                values = [fresh[w] if v is None else v for w, v in zip(split, values, strict=True)]
                if len(cache) > CACHE:
                    cache.clear()
            worst.append(max(values, default=-2.0))
            a = b = None
            if model.probability(worst[-1]) >= THRESHOLD and split:
                a, b = sentence(t, split[values.index(worst[-1])])
            start.append(a)
            end.append(b)
        return {n: batch.column(n) for n in names} | {"score": pa.array(model.probability(np.array(worst)), pa.float64()), "span_start": pa.array(start, pa.int64()), "span_end": pa.array(end, pa.int64())}

    return by_batch(kept, kept.columns, f"{schema}, score double, span_start bigint, span_end bigint", fn, keeps=True)


def sentence(text: str, word: str) -> tuple[int | None, int | None]:
    """Where the first sentence that holds `word` (in lower case) begins and ends."""
    low = text.lower()
    at = low.find(word)
    if at < 0 or len(low) != len(text):
        return 0, len(text)
    before = [m.end() for m in _SENTENCE.finditer(text, 0, at)]
    after = _SENTENCE.search(text, at + len(word))
    return (before[-1] if before else 0), (after.end() if after else len(text))
