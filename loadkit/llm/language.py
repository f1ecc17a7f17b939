"""Language identification by hyperdimensional profiles of letter sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_batch, ship, texts

DIMENSIONS, SEED = 1024, 7
UNKNOWN = "und"
#: Code points that are worked on at once, about.
_CHUNK = 1 << 20
#: Sequences whose vectors are held at once.
_SLICE = 1 << 14
_vectors: dict[int, np.ndarray] = {}
_table: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _table:
        _table.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _table[0]


def letter(code: int) -> np.ndarray:
    """The random vector of +1 and -1 of a letter; 0 stands for what lies between words."""
    if code not in _vectors:
        if len(_vectors) > 20_000:
            _vectors.clear()
        _vectors[code] = np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS).astype(np.int8) * 2 - 1
    return _vectors[code]


def bundles(parts: list[str], owners: list[int], n: int) -> np.ndarray:
    """Sum of the vectors of all three-letter sequences, by owner (n of them): exact whole numbers.

    A sequence's vector is the product of its letters' vectors, each permuted by its place
    (rotated by 2, 1 and 0). What is not a letter parts words; runs of it, the start and the end
    count as one. A text without letters has no sequence.
    """
    if sum(map(len, parts)) > 2 * _CHUNK and (len(parts) > 1 or len(_cuts(parts[0])) > 1):
        out = np.zeros((n, DIMENSIONS))
        for part, owner in zip(parts, owners, strict=True):
            for piece in _cuts(part):
                out[owner] += bundles([piece], [0], 1)[0]
        return out
    joined = "\0".join(["", *(p.replace("\0", " ").lower() for p in parts), ""])
    codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    is_letter, ends = _letters()[codes], codes == 0
    keep = is_letter | ends
    keep[1:] |= is_letter[:-1]
    text, codes = np.cumsum(ends)[keep] - 1, np.where(is_letter, codes, 0)[keep]
    out = np.zeros((n, DIMENSIONS))
    middle = np.nonzero(codes)[0]
    if not len(middle):
        return out
    known, index = np.unique(codes, return_inverse=True)
    m = len(known)
    gram = (index[middle - 1] * m + index[middle]) * m + index[middle + 1]
    owner = np.asarray(owners)[text[middle]]
    if m**3 <= 1 << 22:
        used = np.nonzero(np.bincount(gram, minlength=m**3))[0]
        number = np.zeros(m**3, np.int64)
        number[used] = np.arange(len(used))
        gram = number[gram]
    else:
        used, gram = np.unique(gram, return_inverse=True)
    base = np.stack([letter(int(c)) for c in known])
    first, second = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    exact = np.float32 if len(middle) < 1 << 24 else np.float64
    if len(used) > _SLICE:
        order = np.argsort(gram, kind="stable")
        gram, owner = gram[order], owner[order]
    for begin in range(0, len(used), _SLICE):
        some = used[begin : begin + _SLICE]
        vectors = (first[some // (m * m)] * second[some // m % m] * base[some % m]).astype(exact)
        a, b = (0, len(gram)) if len(used) <= _SLICE else np.searchsorted(gram, [begin, begin + _SLICE])
        for low in range(0, n, 512):
            mine = slice(a, b) if n <= 512 else a + np.nonzero((owner[a:b] >= low) & (owner[a:b] < low + 512))[0]
            rows = min(512, n - low)
            counts = np.bincount((owner[mine] - low) * len(some) + gram[mine] - begin, minlength=rows * len(some)).reshape(rows, len(some))
            out[low : low + rows] += counts.astype(exact) @ vectors
    return out


def _cuts(text: str) -> list[str]:
    """A text in pieces of about _CHUNK code points, cut at blanks: what lies between words parts them anyway."""
    out, low = [], 0
    while len(text) - low > _CHUNK:
        cut = text.rfind(" ", low, low + _CHUNK) + 1 or text.find(" ", low + _CHUNK) + 1
        if not cut:
            break
        out.append(text[low:cut])
        low = cut
    return [*out, text[low:]]


def chunks(found: list[str]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about _CHUNK code points, with the number of the first."""
    low, size = 0, 0
    for i, t in enumerate(found):
        size += len(t)
        if size >= _CHUNK or i - low >= 511:
            yield low, found[low : i + 1]
            low, size = i + 1, 0
    if low < len(found):
        yield low, found[low:]


def learn(docs: DataFrame, held_out: Column, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """A prototype for each language: the bundle of all its documents that are not `held_out`.

    Each task bundles its own documents by language; the sums meet by language and dimension.
    What reaches the driver is one vector per language name, a short list. Null languages and
    texts tell nothing.
    """
    known = docs.where(~held_out & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, found = batch.column("lang").to_pylist(), texts(batch.column("text"))
            names = sorted(set(langs))
            number = {s: i for i, s in enumerate(names)}
            for low, part in chunks(found):
                made = bundles(part, [number[s] for s in langs[low : low + len(part)]], len(names))
                for s, v in zip(names, made, strict=True):
                    sums[s] = sums.get(s, 0) + v
        for s, v in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([s] * DIMENSIONS), "place": pa.array(np.arange(DIMENSIONS)), "value": pa.array(np.rint(v).astype(np.int64))})

    ship(docs.sparkSession)
    rows = known.mapInArrow(run, "lang string, place bigint, value bigint").groupBy("lang", "place").agg(F.sum("value").alias("value")).collect()
    out: dict[str, np.ndarray] = {}
    for r in rows:
        out.setdefault(r.lang, np.zeros(DIMENSIONS))[r.place] = r.value
    return {s: v / np.linalg.norm(v) for s, v in sorted(out.items()) if v.any()}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], keys: list, text: str = "text") -> DataFrame:
    """`keys`, lang_pred and score: the language whose prototype has the largest cosine with the
    text's bundle, and that cosine (0 if below). Null texts and those without letters give `und`
    and 0, and so does every text if nothing was learned."""
    kept = docs.select(*keys, F.col(text).alias("_text"))
    columns = kept.columns[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])
    names = list(prototypes)
    profile = np.stack([prototypes[s] for s in names]) if names else np.zeros((0, DIMENSIONS))

    def fn(batch):
        langs, scores = [], []
        for _, part in chunks(texts(batch.column("_text"))):
            made = bundles(part, list(range(len(part))), len(part))
            norms = np.linalg.norm(made, axis=1)
            likeness = made @ profile.T / np.where(norms > 0, norms, 1)[:, None]
            best = likeness.argmax(axis=1) if names else np.zeros(len(part), int)
            for i, k in enumerate(best.tolist()):
                some = bool(names) and norms[i] > 0
                langs.append(names[k] if some else UNKNOWN)
                scores.append(min(1.0, max(0.0, float(likeness[i, k]))) if some else 0.0)
        return {n: batch.column(n) for n in columns} | {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())}

    return by_batch(kept, kept.columns, f"{schema}, lang_pred string, score double", fn)
