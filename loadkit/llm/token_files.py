"""Token ids of a corpus as raw files, with a minimal perfect hash index from keys to their ids.

A shard is two files. `<shard>.bin` is the ids and nothing else, so that a trainer can map it.
`<shard>.idx` is little-endian:

    8 bytes  magic "TOKIDX1\\0"
    6 x u64  bytes per id, documents, documents without a key, distinct keys, levels, words of bits
    u64[levels + 1]      where each level's bits begin, in words of 64
    u64[words]           bits of all levels
    u64[words + 1]       how many bits are set before each word
    u64[keys]            fingerprint of the key, by slot
    u64[keys], u64[keys] first document and number of documents of the key, by slot
    i64[documents]       keys in the order of the payload (those without one first)
    u64[documents + 1]   where each document's ids begin, in ids

A key's slot: on each level in turn it is hashed to one bit; the first level where that bit is
set holds it, and the number of set bits before is its slot. Building keeps on each level the
keys that are alone at their bit and sends the others on, so no two keys share a slot and none
is empty. A key that was never added lands on some slot and fails the fingerprint.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadkit.session import staged

from .common import raw_texts, ship
from .tokens import END, encoder, widened

MAGIC = b"TOKIDX1\0"
#: Bits per key that is left, on each level.
GAMMA = 2
_GOLDEN = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """64-bit finaliser (multiply and shift) of keys under a salt."""
    x = np.asarray(x).astype(np.int64).view(np.uint64) + np.uint64(_GOLDEN * (salt + 1) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct 64-bit keys to 0 .. number of keys - 1, one each."""

    def __init__(self, starts: np.ndarray, bits: np.ndarray):
        self.starts, self.bits = starts, bits
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.uint64)]).astype(np.uint64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        starts, levels, left = [0], [], keys
        while len(left):
            words = -(-GAMMA * len(left) // 64)
            at = (mixed(left, len(levels)) % np.uint64(64 * words)).astype(np.int64)
            alone = np.bincount(at, minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            starts.append(starts[-1] + words)
            left = left[~alone[at]]
        return cls(np.array(starts, np.uint64), np.concatenate(levels) if levels else np.zeros(0, "<u8"))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Slots; of keys never added some slot, or -1."""
        slots, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level in range(len(self.starts) - 1):
            low, high = int(self.starts[level]), int(self.starts[level + 1])
            at = mixed(keys[open_], level) % np.uint64(64 * (high - low))
            word, bit = low + (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            held = self.bits[word]
            hit = (held >> bit) & np.uint64(1) == 1
            lower = np.bitwise_count(held & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            slots[open_[hit]] = self.before[word[hit]].astype(np.int64) + lower[hit]
            open_ = open_[~hit]
        return slots


class Index:
    """What an .idx file says."""

    def __init__(self, width, nulls, hash_, prints, first, count, keys, bounds):
        self.width, self.nulls, self.hash, self.prints, self.first, self.count, self.keys, self.bounds = width, nulls, hash_, prints, first, count, keys, bounds

    @classmethod
    def build(cls, keys: np.ndarray, nulls: int, lengths: np.ndarray, width: int) -> Index:
        """keys: of the documents in order, equal ones together; the first `nulls` have none."""
        distinct, first, count = np.unique(keys[nulls:], return_index=True, return_counts=True)
        hash_ = PerfectHash.build(distinct)
        slots = hash_(distinct)
        by_slot = np.empty(len(distinct), np.int64)
        by_slot[slots] = np.arange(len(distinct))
        return cls(width, nulls, hash_, mixed(distinct[by_slot], 1 << 32), first[by_slot] + nulls, count[by_slot], keys, np.concatenate([[0], np.cumsum(lengths)]))

    def pack(self) -> bytes:
        h = self.hash
        head = struct.pack("<6Q", self.width, len(self.keys), self.nulls, len(self.prints), len(h.starts) - 1, len(h.bits))
        parts = [(h.starts, "<u8"), (h.bits, "<u8"), (h.before, "<u8"), (self.prints, "<u8"), (self.first, "<u8"), (self.count, "<u8"), (self.keys, "<i8"), (self.bounds, "<u8")]
        return MAGIC + head + b"".join(np.asarray(a).astype(t).tobytes() for a, t in parts)

    @classmethod
    def unpack(cls, raw: bytes) -> Index:
        if raw[:8] != MAGIC:
            raise ValueError("not an index of token files")
        width, docs, nulls, n, levels, words = struct.unpack_from("<6Q", raw, 8)
        at, arrays = 56, []
        for size, kind in ((levels + 1, "<u8"), (words, "<u8"), (words + 1, "<u8"), (n, "<u8"), (n, "<u8"), (n, "<u8"), (docs, "<i8"), (docs + 1, "<u8")):
            arrays.append(np.frombuffer(raw, kind, size, at))
            at += 8 * size
        starts, bits, _, prints, first, count, keys, bounds = arrays
        return cls(width, nulls, PerfectHash(starts, bits), prints, first.astype(np.int64), count.astype(np.int64), keys, bounds.astype(np.int64))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key; (-1, 0) for a key that isn't there."""
        keys = np.asarray(keys, np.int64)
        slots = self.hash(keys)
        known = slots >= 0
        known[known] = self.prints[slots[known]] == mixed(keys[known], 1 << 32)
        first, count = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        first[known], count[known] = self.first[slots[known]], self.count[slots[known]]
        return first, count


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that driver and executors share."""
    if "://" not in uri and uri.startswith("file:"):
        uri = uri[5:]
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _publish(fs: pafs.FileSystem, path: str, attempt: str) -> None:
    """A task's own copy becomes the file; a repeated task replaces it by the same bytes."""
    fs.move(f"{path}.{attempt}", path)


def write(docs: DataFrame, folder: str, vocabulary: str, id_col: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """Encode all texts and write them below `folder` in ascending order of their ids.

    Returns the manifest: shard, path (without ending), first and last id, docs, tokens, and
    start, the number of ids in all shards before. Null texts are empty, each document ends
    with id 1. Null ids come first; rows of equal ids stand together, ordered by a hash of the
    text. Rows are dealt over shards by ranges of ids, so a shard is one task's sorted share;
    its payload is written as it is made. An empty table gives no shard.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    dealt = rows.repartitionByRange(F.col("id").asc_nulls_first(), "tie").sortWithinPartitions(F.col("id").asc_nulls_first(), "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encode = TaskContext.get(), encoder(vocabulary, whole)
        fs, root = store(folder)
        shard, attempt = task.partitionId(), str(task.taskAttemptId())
        path, end = f"{root}/{shard:07d}", np.array([END], encode.dtype).tobytes()
        keys, lengths, nulls, payload = [], [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if payload is None:
                fs.create_dir(root, recursive=True)
                payload = fs.open_output_stream(f"{path}.bin.{attempt}")
            for raw in encode(raw_texts(batch.column("text"))):
                payload.write(raw + end)
                lengths.append(len(raw) // encode.dtype.itemsize + 1)
            nulls += batch.column("id").null_count
            keys.append(batch.column("id").fill_null(0).to_numpy(zero_copy_only=False))
        if payload is None:
            return
        payload.close()
        keys = np.concatenate(keys)
        with fs.open_output_stream(f"{path}.idx.{attempt}") as out:
            out.write(Index.build(keys, nulls, np.array(lengths), encode.dtype.itemsize).pack())
        _publish(fs, f"{path}.bin", attempt)
        _publish(fs, f"{path}.idx", attempt)
        ends = [None if at < nulls else int(keys[at]) for at in (0, len(keys) - 1)]
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard], pa.int32()), "path": [f"{folder}/{shard:07d}"], "first": pa.array(ends[:1], pa.int64()), "last": pa.array(ends[1:], pa.int64()), "docs": [len(keys)], "tokens": [sum(lengths)]}
        )

    made = staged(dealt.select("id", "text").mapInArrow(run, "shard int, path string, first bigint, last bigint, docs bigint, tokens bigint"), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return made.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Every document of the files, found through the index: id, start (ids before it in all
    files), n_tokens, ids (little-endian unsigned 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _shard(row)

    def _shard(row: dict) -> Iterator[pa.RecordBatch]:
        fs, path = store(row["path"])
        index = Index.unpack(fs.open_input_file(f"{path}.idx").read())
        first, count = index.find(np.unique(index.keys[index.nulls :]))
        order = np.argsort(first)
        spans = [(0, index.nulls)] * bool(index.nulls) + list(zip(first[order].tolist(), count[order].tolist(), strict=True))
        dtype, out, held = np.dtype(f"<u{index.width}"), [], 0
        with fs.open_input_file(f"{path}.bin") as payload:
            for at, n in spans:
                for i in range(at, at + n):
                    low, high = int(index.bounds[i]), int(index.bounds[i + 1])
                    raw = payload.read_at((high - low) * index.width, low * index.width)
                    out.append((None if i < index.nulls else int(index.keys[i]), row["start"] + low, high - low, widened(raw, dtype)))
                    held += len(raw)
                    if held > 1 << 23:
                        yield _batch(out)
                        out, held = [], 0
        if out:
            yield _batch(out)

    def _batch(rows: list) -> pa.RecordBatch:
        a, b, c, d = zip(*rows, strict=True)
        return pa.RecordBatch.from_pydict({id_col: pa.array(a, pa.int64()), "start": pa.array(b, pa.int64()), "n_tokens": pa.array(c, pa.int64()), "ids": pa.array(d, pa.binary())})

    spread = manifest.select("shard", "path", "start").repartitionByRange(max(1, manifest.count()), "shard")
    return spread.mapInArrow(run, f"`{id_col}` bigint, start bigint, n_tokens bigint, ids binary")


def lookup(manifest_row: dict, keys: list[int]) -> dict[int, list[bytes]]:
    """Ids of the documents of some keys of one shard, one read each; keys not in it are left out."""
    fs, path = store(manifest_row["path"])
    index = Index.unpack(fs.open_input_file(f"{path}.idx").read())
    found = {}
    with fs.open_input_file(f"{path}.bin") as payload:
        for key, at, n in zip(keys, *index.find(np.array(keys, np.int64)), strict=True):
            bounds = index.bounds[at : at + n + 1]
            if n:
                found[key] = [payload.read_at(int(hi - lo) * index.width, int(lo) * index.width) for lo, hi in zip(bounds, bounds[1:], strict=False)]
    return found


