"""Packing of documents into sequences by lexical retrieval."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.session import staged

from .common import forget, raw_texts, ship, slices
from .tokens import CACHE, END, encoder, widened

WINDOW = 2048
#: Ids of an index shard, about; the number of shards grows with the corpus.
SHARD_IDS = 1 << 18
#: Ranges of keys that rows are dealt to hold about this many shards, until there are so many ranges.
RANGE_SHARDS, RANGES = 4, 1 << 14
#: Rows that are encoded and sent at a time.
SENT = 512
#: Rows a range whose keys are looked at to place the ranges' bounds.
SAMPLE = 16
K1, B = 1.2, 0.75


class Bm25:
    """Inverted index of one shard's documents over token ids, weighted by the corpus' frequencies."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        n = len(docs)
        owner = np.repeat(np.arange(n), [len(d) for d in docs])
        pairs, tf = np.unique(np.concatenate(docs).astype(np.int64) * n + owner, return_counts=True)
        self.docs, terms = pairs % n, pairs // n
        size = np.array([len(d) for d in docs])[self.docs] / mean
        self.weight = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size))
        heads, starts = np.unique(terms, return_index=True)
        place, counts = np.searchsorted(heads, terms), np.diff(np.append(starts, len(terms)))
        order = np.argsort(self.docs, kind="stable")
        order = order[(counts > 1)[place[order]]]
        self.of_doc, self.lists, self.n = np.searchsorted(self.docs[order], np.arange(n + 1)), place[order], n
        self.starts, self.counts = starts, counts

    def scores(self, doc: int) -> np.ndarray:
        """Of all documents for the query of all of `doc`'s terms that another one has too."""
        lists = self.lists[self.of_doc[doc] : self.of_doc[doc + 1]]
        counts = self.counts[lists]
        at = np.repeat(self.starts[lists] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return np.bincount(self.docs[at], self.weight[at], self.n)


class Keys:
    """Content keys of documents: the three terms that weigh most in a document among those that
    another one has too, then 16 bits of a hash of its row, so that any group of copies can be parted.
    """

    def __init__(self, idf: np.ndarray, held: np.ndarray, mean: float):
        self.weight, self.mean = np.where(held > 1, idf, 0).astype(np.float32), mean

    def __call__(self, docs: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
        terms = np.zeros((len(docs), 3), np.uint64)
        for i, doc in enumerate(docs):
            found, tf = np.unique(doc, return_counts=True)
            weight = self.weight[found] * tf / (tf + np.float32(K1 * (1 - B + B * len(doc) / self.mean)))
            top = np.argsort(-weight, kind="stable")[:3]
            terms[i, : len(top)] = np.where(weight[top] > 0, found[top], 0)
        mixed = (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
        for place in range(3):
            mixed |= (terms[:, place] & np.uint64(0xFFFF)) << np.uint64(48 - 16 * place)
        return (mixed >> np.uint64(1)).astype(np.int64)


def fill(docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of a shard.

    A window's seed is the document at its start. The seed's unused neighbours follow by
    falling score, each whole if it fits, else cut: its rest begins the next window and is that
    window's seed. A copy of the seed is no neighbour. Without one that shares a term, the next
    unused document follows.
    What is left at the end is cut into lengths of falling powers of two, so nothing is padded.
    """
    index = Bm25(docs, idf, mean)
    same = np.array([hash(d.tobytes()) for d in docs])
    unused = np.ones(len(docs), bool)
    pieces, sequence, used, seed, ranked, next_ = [], 0, 0, None, None, 0
    for _ in range(len(docs)):
        doc = None
        if seed is not None:
            if ranked is None:
                scores = index.scores(seed) * (unused & (same != same[seed]))
                ranked = np.argsort(-scores, kind="stable")[: np.count_nonzero(scores)][::-1].tolist()
            while ranked and doc is None:
                doc = ranked.pop()
                doc = doc if unused[doc] else None
        if doc is None:
            while not unused[next_]:
                next_ += 1
            doc = next_
        unused[doc] = False
        start, left = 0, len(docs[doc])
        if used == 0:
            seed, ranked = doc, None
        while left:
            take = min(left, window - used)
            pieces.append((doc, start, take, sequence, used))
            start, left, used = start + take, left - take, used + take
            if used == window:
                sequence, used, seed, ranked = sequence + 1, 0, doc if left else None, None
    full = [p for p in pieces if p[3] < sequence]
    yield from full
    tail, used = pieces[len(full) :], sum(p[2] for p in pieces[len(full) :])
    room, offset = (1 << used.bit_length()) >> 1, 0
    for doc, start, left, _, _ in tail:
        while left:
            take = min(left, room - offset)
            yield doc, start, take, sequence, offset
            start, left, offset = start + take, left - take, offset + take
            if offset == room:
                used -= room
                sequence, offset, room = sequence + 1, 0, (1 << used.bit_length()) >> 1


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, shard_ids: int = SHARD_IDS, whole: bool = False, words: int = CACHE) -> DataFrame:
    """Pieces of documents in sequences of at most `window` ids: id, start, length, doc_tokens,
    sequence_id, offset, ids (little-endian unsigned 32-bit).

    Texts are encoded once and written to the working folder as ids, each with id 1 at its end
    (null texts are empty, so only that). Document frequencies are counted over the whole
    corpus; their table has a row per vocabulary entry and no more. Rows are dealt to ranges of
    `Keys`, whose bounds come from a sample of rows, and go through a range in the order of keys,
    so documents with the same weightiest terms lie in one index shard. A shard ends when it
    holds `shard_ids` ids, whatever the number and length of its documents, and only one is in
    memory. Copies are parted by their rows' hashes. Rows that repeat are packed each, null ids
    stay null, an empty table gives none. A range's shards share one count of sequences.
    A worker remembers the ids of `words` words while it encodes, and drops them afterwards.
    """
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    dtype, size = encoder(vocabulary, whole).dtype, encoder(vocabulary, whole).tokenizer.get_vocab_size()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = encoder(vocabulary, whole, words)
        end, held, ids, n = np.array([END], to_ids.dtype).tobytes(), np.zeros(size, np.int64), 0, 0
        for batch in slices(batches, SENT):
            raws = [raw + end for raw in to_ids(raw_texts(batch.column("text")))]
            for raw in raws:
                found = np.frombuffer(raw, to_ids.dtype)
                held[np.unique(found)] += 1
                ids += len(found)
            n += len(raws)
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "ids": pa.array(raws, pa.binary()), "held": pa.nulls(len(raws), pa.binary())})
        counts = np.concatenate([[n, ids], held]).tobytes()
        yield pa.RecordBatch.from_pydict({"id": pa.nulls(1, pa.int64()), "ids": pa.nulls(1, pa.binary()), "held": pa.array([counts], pa.binary())})

    encoded = plain.mapInArrow(encode, "id bigint, ids binary, held binary").withColumn("row", F.monotonically_increasing_id())
    written = staged(encoded, "ids")
    rows = written.where("held is null").drop("held")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        counts = np.zeros(size + 2, np.int64)
        for batch in batches:
            for raw in batch.column("held").to_pylist():
                counts += np.frombuffer(raw, np.int64)
        some = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_pydict({"token": pa.array(some - 2), "n": pa.array(counts[some])})

    found = written.where("held is not null").select("held").mapInArrow(add, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size + 2, np.int64)
    counts[found.column("token").to_numpy() + 2] = found.column("n").to_numpy()
    total, ids, held = max(1, int(counts[0])), int(counts[1]), counts[2:]
    idf = np.log1p((total - held + 0.5) / (held + 0.5))
    mean = max(1, ids) / total
    keys = Keys(idf, held, mean)

    def keyed(batch: pa.RecordBatch) -> np.ndarray:
        return keys([np.frombuffer(raw, dtype) for raw in batch.column("ids").to_pylist()], batch.column("row").to_numpy())

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"key": pa.array(keyed(batch))})

    ranges = min(RANGES, -(-max(1, ids) // (RANGE_SHARDS * shard_ids)))
    share = 2**20 if ranges * SAMPLE >= total else 2**20 * ranges * SAMPLE // total + 1
    bounds = np.zeros(0, np.int64)
    if ranges > 1:
        seen = np.sort(rows.where(F.pmod(F.xxhash64("row"), F.lit(2**20)) < share).mapInArrow(look, "key bigint").toArrow().column("key").to_numpy())
        bounds = seen[np.arange(1, ranges) * len(seen) // ranges] if len(seen) else bounds

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            key = keyed(batch)
            part = np.searchsorted(bounds, key, side="right")
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "ids": batch.column("ids"), "row": batch.column("row"), "key": pa.array(key), "part": pa.array(part)})

    def shard(part: int, first: int, owners: list, raws: list[bytes]) -> pa.RecordBatch:
        docs = [np.frombuffer(raw, dtype) for raw in raws]
        d, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*fill(docs, idf, mean, window), strict=True))
        cut = [widened(raws[i][s * dtype.itemsize : (s + n) * dtype.itemsize], dtype) for i, s, n in zip(d.tolist(), start.tolist(), length.tolist(), strict=True)]
        sizes = np.array([len(x) for x in docs], np.int64)
        return pa.RecordBatch.from_pydict(
            {
                id_col: pa.array(owners, pa.int64()).take(pa.array(d)), "start": start, "length": length, "doc_tokens": sizes[d],
                "sequence_id": (part << 32) + first + sequence, "offset": offset, "ids": pa.array(cut, pa.binary()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        part, first, owners, raws, used = None, 0, [], [], 0
        for batch in batches:
            for of, owner, raw in zip(batch.column("part").to_pylist(), batch.column("id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if raws and (of != part or used >= shard_ids):
                    out = shard(part, first, owners, raws)
                    yield out
                    first, owners, raws, used = out.column("sequence_id")[-1].as_py() + 1 - (part << 32), [], [], 0
                if of != part:
                    part, first = of, 0
                owners.append(owner)
                raws.append(raw)
                used += len(raw) // dtype.itemsize
        if raws:
            yield shard(part, first, owners, raws)

    dealt = rows.mapInArrow(deal, "id bigint, ids binary, row bigint, key bigint, part bigint")
    ordered = dealt.repartition("part").sortWithinPartitions("part", "key", "row")
    return ordered.mapInArrow(run, f"`{id_col}` bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")
