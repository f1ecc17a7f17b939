"""Near duplicates by SimHash, with tiled exact comparison of fingerprints."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.session import release, staged

from .common import by_batch, located, raw_texts, ship
from .components import components

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Bits of the segments whose population counts name a tile.
SEGMENTS = (11, 11, 11, 11, 10, 10)
#: Fingerprints of a tile's block at most, about.
BLOCK = 2048
_CHUNK = 1 << 16


def simhash(raw: bytes, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint of a text in UTF-8: the majority of each bit over its shingles' XXH64."""
    words = raw.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n, ones = len(words) - shingle + 1, np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        part = words[at : at + _CHUNK + shingle - 1]
        digests = [xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(part[i:] for i in range(shingle)), strict=False)]
        ones += _bit_counts(np.array(digests, ">u8"))
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def set_fingerprint(values: np.ndarray) -> int:
    """64-bit fingerprint of a set given by its members' hashes: how often a text repeats one doesn't matter."""
    return int.from_bytes(np.packbits(2 * _bit_counts(values.astype(">u8")) > len(values)).tobytes(), "big")


def _bit_counts(values: np.ndarray) -> np.ndarray:
    """How many values have each bit, highest first; sums of up to 255 rows stay in bytes."""
    rows = np.zeros((-(-len(values) // 255) * 255, 8), np.uint8)
    rows[: len(values)] = values.view(np.uint8).reshape(-1, 8)
    return np.unpackbits(rows, axis=1).reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, keys: list, text="text", shingle: int = SHINGLE) -> DataFrame:
    """`keys` and the fingerprint as a signed long, one row per row of `docs`."""
    kept = docs.select(*keys, F.col(text).alias("_text"))
    names = kept.columns[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def fn(batch):
        found = np.array([simhash(b, shingle) for b in raw_texts(batch.column("_text"))], np.uint64).view(np.int64)
        return {n: batch.column(n) for n in names} | {"fp": pa.array(found)}

    return by_batch(kept, kept.columns, f"{schema}, fp bigint", fn)


def linked(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) that connect just those within `radius` bits.

    A tile holds the fingerprints that agree in the population count of six segments. The
    counts of two fingerprints can't differ by more, summed over segments, than their bits do:
    tile pairs beyond the radius are skipped. A tile is dealt over blocks of bounded size;
    each pair of blocks is one row, compared in full by exclusive-or and bit counts. Of the
    close pairs of a block pair those are returned that span its connected parts, so a dense
    group gives as many links as members, not as pairs, and no connection is lost.
    """
    lows = [sum(SEGMENTS[:i]) for i in range(len(SEGMENTS))]
    counts = [
        F.bit_count(F.shiftrightunsigned("fp", low).bitwiseAND((1 << width) - 1)).cast("long")
        for low, width in zip(lows, SEGMENTS, strict=True)
    ]
    tile = sum(c * 16**i for i, c in enumerate(counts))
    placed = fps.select("fp", tile.alias("tile"))
    sizes = placed.groupBy("tile").agg(F.count(F.lit(1)).alias("n"))
    block = F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / BLOCK)).alias("block")
    blocks = staged(
        placed.join(sizes, "tile").select("tile", block, "fp").groupBy("tile", "block").agg(F.collect_list("fp").alias("fps")), "tiles"
    )
    steps = F.array(*[F.lit(s).cast("long") for s in _steps(radius)])
    near = blocks.select(F.explode(F.transform(steps, lambda s: s + F.col("tile"))).alias("tile"), F.col("tile").alias("tile_a"), F.col("block").alias("block_a"), F.col("fps").alias("fps_a"))
    pairs = near.join(blocks, "tile").where("tile <> tile_a OR block_a <= block")

    def fn(batch):
        a, b = [], []
        for x, y in zip(batch.column("fps_a"), batch.column("fps"), strict=True):
            u, v = spanning(np.asarray(x.values, np.int64), np.asarray(y.values, np.int64), radius)
            a.append(u)
            b.append(v)
        return {"a": pa.array(np.concatenate(a)), "b": pa.array(np.concatenate(b))}

    return by_batch(pairs, ["fps_a", "fps"], "a bigint, b bigint", fn)


def _steps(radius: int) -> list[int]:
    """Differences of tile numbers within the radius, one of each opposite two, and zero."""
    found = set()
    for places in itertools.combinations_with_replacement(range(len(SEGMENTS)), radius):
        for signs in itertools.product((-1, 0, 1), repeat=radius):
            step = [0] * len(SEGMENTS)
            for place, sign in zip(places, signs, strict=True):
                step[place] += sign
            found.add(tuple(step))
    return sorted(sum(s * 16**i for i, s in enumerate(step)) for step in found if step[::-1] >= tuple([0] * len(SEGMENTS)))


def spanning(x: np.ndarray, y: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (fingerprint, smallest of its connected part) under closeness of x's to y's members."""
    values, index = np.unique(np.concatenate([x, y]), return_inverse=True)
    ix, iy = index[: len(x)], index[len(x) :]
    left, right = [], []
    ux, uy = x.view(np.uint64), y.view(np.uint64)
    for at in range(0, len(ux), 256):
        i, j = np.nonzero(np.bitwise_count(ux[at : at + 256, None] ^ uy[None, :]) <= radius)
        left.append(ix[i + at])
        right.append(iy[j])
    u, v = np.concatenate(left), np.concatenate(right)
    label = np.arange(len(values))
    while True:
        low = label.copy()
        np.minimum.at(low, u, label[v])
        np.minimum.at(low, v, label[u])
        low = low[low]
        if (low == label).all():
            break
        label = low
    moved = np.nonzero(label != np.arange(len(values)))[0]
    return values[moved], values[label[moved]]


def near_duplicates(docs: DataFrame, id_col="doc_id", text="text", keys: tuple = (), radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """Every row of `docs`: id, `keys`, fp (signed long), component (smallest id reachable over close fingerprints).

    Null and empty texts have fingerprint zero and link like others. Null ids are returned as
    they are and never name a component that has another id. Equal rows are all returned. An
    empty table gives an empty result. Other columns of `docs` are not read.
    """
    chosen = [F.col(id_col).alias("_id"), *[F.col(k) for k in keys]]
    rows = staged(fingerprints(docs, chosen, text, shingle), "simhash")
    fps = rows.groupBy("fp").agg(F.min("_id").alias("low"))
    found = components(linked(fps.select("fp"), radius)).toDF("fp", "root")
    rooted = fps.join(found, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component"))
    named = rooted.join(lows, "root").select("fp", "component")
    return rows.join(named, "fp").select(F.col("_id").alias(id_col), *keys, "fp", "component")


#: Near-duplicate stages: words of a shingle, least similarity (also as a fraction), and bits of fingerprints that make a first candidate.
WORDS, SIMILARITY, REACH = 5, 0.8, 18
_PARTS, _WHOLE = 4, 5
#: Shingles that are counted at a time, about, and shingles of a chunk of texts that is sent to be counted.
COUNTED, CHUNK = 1 << 19, 1 << 20
#: Rows of a list's block at most, about, and rows of a label that get blocks of their own.
BUCKET, OWN = 512, 64
#: Least bits of a parity sketch.
PARITY = 2048


def shingles(raw: bytes, n: int = WORDS) -> set[bytes]:
    """Distinct shingles; fewer words are one shingle, none are the empty one."""
    words = raw.lower().split()
    return {b" ".join(s) for s in zip(*(words[i:] for i in range(n)), strict=False)} or {b" ".join(words)}


def hashes(found: set[bytes]) -> np.ndarray:
    return np.unique(np.array([xxhash.xxh64_intdigest(s, SEED) for s in found], np.uint64))


def _rest(n):
    """Shingles out of `n` that are not among the rarest: one fewer than a similar text shares at least."""
    return (_PARTS * n + _WHOLE - 1) // _WHOLE - 1


def parity(values: np.ndarray) -> bytes:
    """A bit for each of 2 len(values) or more slots of hashes, a power of two: whether an odd number
    of values falls there. A value that only one of two sets has turns one bit, so the bits in which
    two sketches differ are no more than such values. The larger of two sketches is folded."""
    size = max(PARITY, 1 << (2 * len(values) - 1).bit_length())
    slots = ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)
    return np.packbits(np.bincount(slots, minlength=size).astype(np.uint8) & 1).tobytes()


def _folded(bits: np.ndarray) -> np.ndarray:
    """Sketches of half the slots: neighbouring slots of the larger one fall together."""
    pairs = np.unpackbits(bits, axis=1)
    return np.packbits(pairs[:, 0::2] ^ pairs[:, 1::2], axis=1)


def similar_documents(docs: DataFrame, id_col="doc_id", text="text") -> DataFrame:
    """Every row of `docs`: locator, id, root. Rows of one root are linked by pairs of texts
    whose sets of five-word shingles have a similarity (shared by all) of 0.8 or more.

    Similar texts share one of their rarest shingles (see `rarest`), so only rows that meet at
    such a shingle are looked at (see `lists`). First candidates pair each row of a list with
    the list's least row, if the SimHash fingerprints of their sets are at most REACH bits
    apart; they are checked on whole texts. These only spare work: what they leave apart is
    found exactly. Where rows that are not linked yet meet, all their pairs are compared by
    sketches that never call a similar pair unlike (see `open_pairs`), a spanning forest of
    those left is checked on whole texts, and so on in the lists where one was turned down,
    without it, until no pair is left. So no link is lost, and what is written stays in
    proportion to the rows that meet. Texts without words are similar to each other. Equal rows
    are returned each, null ids as they are; an empty table gives an empty result.
    """
    placed = located(docs).select(F.col("_locator").alias("locator"), F.col(id_col).cast("long").alias("id"), F.col(text).alias("_text"))

    def fn(batch):
        raws = raw_texts(batch.column("_text"))
        fps, sizes, parities = [], [], []
        for b in raws:  # one text's shingles at a time
            values = hashes(shingles(b))
            fps.append(set_fingerprint(values))
            sizes.append(len(values) if b.split(None, 1) else 0)
            parities.append(parity(values))
        return {
            "locator": batch.column("locator"), "id": batch.column("id"), "fp": pa.array(np.array(fps, np.uint64).view(np.int64)), "n": pa.array(sizes, pa.int64()),
            "parity": pa.array(parities, pa.binary()),
        }

    made = by_batch(placed, ["locator", "id", "_text"], "locator string, id bigint, fp bigint, n bigint, parity binary", fn)
    rows = staged(made.withColumn("row", F.monotonically_increasing_id()), "simhash")
    total = rows.agg(F.sum(F.greatest("n", F.lit(1)))).first()[0] or 0
    rare = rarest(placed, max(1, -(-total // COUNTED))).join(rows.select("locator", "row"), "locator").select("row", "rarest")
    met = staged(lists(rare), "lists")
    pairs = staged(_first_pairs(met, rows), "pairs")
    told = _checked(pairs, rows, placed)
    found = staged(components(told.where("good").select("a", "b")).toDF("row", "root"), "near")
    open_rows = rows
    while True:
        labelled = open_rows.join(found, "row", "left").select("row", F.greatest("n", F.lit(1)).alias("n"), F.coalesce("root", "row").alias("label"), "parity")
        buckets = blocks_of(met, labelled, told.where("NOT good").select("a", "b"))
        more = staged(open_pairs(buckets), "pairs")
        release(buckets)
        if more.isEmpty():
            release(more)
            break
        now = _checked(more.select("a", "b").distinct(), rows, placed)
        # a list without pairs, or whose pairs are all good, has nothing left that is not linked
        again = more.join(now.where("NOT good"), ["a", "b"]).select("list").distinct()
        left = staged(met.join(again, "list", "left_semi"), "lists")
        few = staged(open_rows.select("row", "n", "parity").join(left.select("row").distinct(), "row", "left_semi"), "open")
        release(met)
        if open_rows is not rows:
            release(open_rows)
        met, open_rows = left, few
        linked_now = now.where("good").select("a", "b").union(found.toDF("a", "b"))
        before, found = found, staged(components(linked_now).toDF("row", "root"), "near")
        all_told = staged(told.union(now), "told")
        for old in (told, now, before, more):
            release(old)
        told = all_told
    out = staged(rows.join(found, "row", "left").select("locator", "id", F.coalesce("root", "row").alias("root")), "groups")
    for old in (met, open_rows, pairs, told, found, rows):
        release(old)
    return out


def rarest(placed: DataFrame, parts: int) -> DataFrame:
    """Texts (locator, _text) -> locator, rarest: those of a text's rarest shingles that another one has
    too. Texts without any are left out.

    Rarest are so many that each similar text has one of its own rarest among them, whatever the
    order, if it is the same for all texts; here it is by the number of texts that have the
    shingle. Shingles are counted in `parts` parts of their hashes, about COUNTED at a time. A
    chunk of texts sends each part 32 bits of the hashes that fall there and gets the counts of
    those back that are not the only ones, so a text's others are known by their number alone.
    Two shingles whose bits are equal are counted as one, in every text.
    """
    ship(placed.sparkSession)

    def send(batches):
        task, number, held, places, size = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            for place, raw in zip(batch.column("locator").to_pylist(), raw_texts(batch.column("_text")), strict=True):
                held.append(hashes(shingles(raw)))
                places.append(place)
                size += len(held[-1])
                if size >= CHUNK or len(held) == 1 << 16:
                    yield _parted((task << 32) + number, places, held, parts)
                    number, held, places, size = number + 1, [], [], 0
        if held:
            yield _parted((task << 32) + number, places, held, parts)

    def count(batches):
        of, records = None, []
        for batch in batches:
            for record in batch.to_pylist():
                if record["part"] != of and records:
                    yield _shared(of, records)
                    records = []
                of = record["part"]
                if record["locators"] is None:
                    records.append(record)
                else:
                    yield pa.RecordBatch.from_pylist([record | {"counts": None}], _COUNTED)
        if records:
            yield _shared(of, records)

    def choose(batches):
        of, records = None, []
        for batch in batches:
            for record in batch.to_pylist():
                if record["chunk"] != of and records:
                    yield _chosen(records)
                    records = []
                of = record["chunk"]
                records.append(record)
        if records:
            yield _chosen(records)

    sent = placed.select("locator", "_text").mapInArrow(send, "part bigint, chunk bigint, bits binary, owners binary, locators array<string>")
    counted = sent.repartition("part").sortWithinPartitions("part").mapInArrow(count, "part bigint, chunk bigint, bits binary, owners binary, locators array<string>, counts binary")
    return counted.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(choose, "locator string, rarest array<bigint>")


_SENT = pa.schema([("part", pa.int64()), ("chunk", pa.int64()), ("bits", pa.binary()), ("owners", pa.binary()), ("locators", pa.list_(pa.string()))])
_COUNTED = _SENT.append(pa.field("counts", pa.binary()))


def _parted(chunk: int, places: list[str], held: list[np.ndarray], parts: int) -> pa.RecordBatch:
    """A chunk's shingles by part, each with the number of its text in the chunk; and, in a part of its own, the texts' places and sizes."""
    sizes = np.array([len(v) for v in held], np.int64)
    values = np.concatenate(held)
    keys = ((values % np.uint64(parts)) << np.uint64(32)) | (values >> np.uint64(32))
    order = np.argsort(keys)
    keys, owners = keys[order], np.repeat(np.arange(len(held), dtype=np.uint16), sizes)[order]
    part = (keys >> np.uint64(32)).astype(np.int64)
    starts = np.nonzero(np.diff(part, prepend=-1))[0]
    ends = np.append(starts[1:], len(part))
    bits = keys.astype(np.uint32)
    out = [{"part": -1 - chunk, "chunk": chunk, "owners": sizes.tobytes(), "locators": places}]
    out += [{"part": int(part[s]), "chunk": chunk, "bits": bits[s:e].tobytes(), "owners": owners[s:e].tobytes()} for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
    return pa.RecordBatch.from_pylist(out, _SENT)


def _shared(part: int, records: list[dict]) -> pa.RecordBatch:
    """Of a part's records those shingles that are there more than once, with their counts."""
    bits = [np.frombuffer(r["bits"], np.uint32) for r in records]
    _, index, n = np.unique(np.concatenate(bits), return_inverse=True, return_counts=True)
    counts = np.split(n[index], np.cumsum([len(b) for b in bits])[:-1])
    out = []
    for r, b, c in zip(records, bits, counts, strict=True):
        some = c > 1
        if some.any():
            owners = np.frombuffer(r["owners"], np.uint16)[some]
            out.append({"part": part, "chunk": r["chunk"], "bits": b[some].tobytes(), "owners": owners.tobytes(), "counts": c[some].astype(np.int64).tobytes()})
    return pa.RecordBatch.from_pylist(out, _COUNTED)


def _chosen(records: list[dict]) -> pa.RecordBatch:
    """The rarest shingles of a chunk's texts, as far as others have them."""
    (head,), rest = ([r for r in records if (r["locators"] is not None) == is_head] for is_head in (True, False))
    sizes = np.frombuffer(head["owners"], np.int64)
    owners, counts = (np.concatenate([np.zeros(0, kind), *[np.frombuffer(r[c], kind) for r in rest]]) for c, kind in (("owners", np.uint16), ("counts", np.int64)))
    tokens = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(r["bits"], np.uint32).astype(np.int64) + (r["part"] << 32) for r in rest]])
    alone = sizes - np.bincount(owners, minlength=len(sizes))
    wanted = sizes - _rest(sizes) - alone
    some = wanted[owners] > 0
    owners, counts, tokens = owners[some], counts[some], tokens[some]
    order = np.lexsort((tokens, counts, owners))
    owners, tokens = owners[order], tokens[order]
    take = np.arange(len(owners)) - np.searchsorted(owners, owners) < wanted[owners]
    owners, tokens = owners[take], tokens[take]
    texts, starts = np.unique(owners, return_index=True)
    found = [np.unique(t) for t in np.split(tokens, starts[1:])] if len(texts) else []
    return pa.RecordBatch.from_pydict({"locator": pa.array([head["locators"][t] for t in texts], pa.string()), "rarest": pa.array(found, pa.list_(pa.int64()))})


def _first_pairs(met: DataFrame, rows: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of rows with near fingerprints and sizes: each row of a list with the list's least one."""
    least = met.groupBy("list").agg(F.min("row").alias("a"))
    pairs = met.join(least, "list").where("row <> a").select("a", F.col("row").alias("b")).distinct()
    a, b = (rows.select(F.col("row").alias(c), F.col("fp").alias(f"f{c}"), F.greatest("n", F.lit(1)).alias(f"n{c}")) for c in "ab")
    near = f"bit_count(fa ^ fb) <= {REACH} AND {_WHOLE} * least(na, nb) >= {_PARTS} * greatest(na, nb)"
    return pairs.join(a, "a").join(b, "b").where(near).select("a", "b")


def _checked(pairs: DataFrame, rows: DataFrame, placed: DataFrame) -> DataFrame:
    """Pairs (a, b) of rows with `good`: whether their whole texts are similar. Written."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct()
    # written, so that its size is known: all texts are shuffled only where many are needed
    needed = staged(ends.join(rows.select("row", "locator"), "row"), "needed")
    held = staged(placed.select("locator", "_text").join(needed, "locator").select("row", "_text"), "texts")
    release(needed)
    texts = pairs.join(held.toDF("a", "ta"), "a").join(held.toDF("b", "tb"), "b")

    def verify(batch):
        good = []
        for x, y in zip(raw_texts(batch.column("ta")), raw_texts(batch.column("tb")), strict=True):
            s, t = shingles(x), shingles(y)
            shared = len(s & t)
            good.append(shared >= SIMILARITY * (len(s) + len(t) - shared))
        return {"a": batch.column("a"), "b": batch.column("b"), "good": pa.array(good, pa.bool_())}

    told = staged(by_batch(texts, ["a", "b", "ta", "tb"], "a bigint, b bigint, good boolean", verify), "told")
    release(held)
    return told


def lists(rows: DataFrame) -> DataFrame:
    """Rows (row, rarest) -> (list, row): the rows that meet at one of their rarest shingles, two or more.

    Of shingles that the very same rows have (a passage's) one stands for all; which those are
    is told by two sums of the rows' hashes, 128 bits, and the number of rows.
    """
    placed = rows.select("row", F.explode("rarest").alias("token"))
    x = F.xxhash64("row")
    told = placed.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.bit_xor(x).alias("x"), F.bit_xor(F.xxhash64(x, F.lit(SEED))).alias("y")).where("m > 1")
    chosen = told.groupBy("m", "x", "y").agg(F.min("token").alias("token")).select("token")
    return placed.join(chosen, "token").select(F.col("token").alias("list"), "row")


def blocks_of(met: DataFrame, rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """Lists (list, row), rows (row, n, label, parity) and pairs turned down (a, b) -> the rows of each
    list, in blocks of bounded size. Written.

    Lists whose rows have one label are left out. A label with many rows has blocks of its own.
    """
    no = rejected.select(F.col("a").alias("row"), "b").groupBy("row").agg(F.collect_list("b").alias("no"))
    each = met.join(rows.select("row", "label"), "row")
    counts = each.groupBy("list", "label").agg(F.count(F.lit(1)).alias("c"))
    few = F.sum(F.when(F.col("c") <= OWN, F.col("c")).otherwise(0)).alias("few")
    mixed = counts.groupBy("list").agg(few, F.count(F.lit(1)).alias("labels")).where("labels > 1").select("list", "few")
    own = counts.join(mixed, "list").select("list", "label", F.when(F.col("c") > OWN, F.col("c")).alias("own"), "few")
    dealt = each.join(own, ["list", "label"]).select(
        "list", "row", F.when(F.col("own").isNull(), -1).otherwise(F.col("label")).alias("kind"),
        F.when(F.col("own").isNull(), F.pmod(F.xxhash64("label"), F.ceil(F.col("few") / BUCKET))).otherwise(F.pmod(F.xxhash64("row"), F.ceil(F.col("own") / BUCKET))).alias("block"),
    )
    full = dealt.join(rows, "row").join(no, "row", "left")
    members = full.groupBy("list", "kind", "block").agg(F.collect_list(F.struct("row", "n", "label", "parity", F.coalesce("no", F.array().cast("array<bigint>")).alias("no"))).alias("m"))
    return staged(members.select("list", "kind", "block", *[F.col(f"m.{c}").alias(c) for c in _MEMBER]), "buckets")


_MEMBER = ["row", "n", "label", "parity", "no"]


def open_pairs(blocks: DataFrame) -> DataFrame:
    """Pairs (list, a, b) to check that span, block by block, all pairs of different labels that can be similar and were not turned down.

    Two blocks of one label's own are never compared. Each other pair of a list's blocks is one
    row, compared in full: similar sets of n and m shingles differ in (n + m) / 9 at most, so
    sketches that differ in more bits tell that a pair is not similar.
    """
    columns = _MEMBER
    other = blocks.select("list", F.col("kind").alias("kind_a"), F.col("block").alias("block_a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    cells = other.join(blocks, "list").where("(kind_a, block_a) <= (kind, block) AND (kind_a <> kind OR kind = -1)")
    names = [*[f"{c}_a" for c in columns], *columns]

    def meet(batch):
        of, a, b = [], [], []
        for key, *parts in zip(batch.column("list").to_pylist(), *(batch.column(c) for c in names), strict=True):
            (ra, na, la), (rb, nb, lb) = ([np.asarray(p.values, np.int64) for p in parts[k : k + 3]] for k in (0, 5))
            i, j = np.nonzero((la[:, None] != lb[None, :]) & (_WHOLE * np.minimum(na[:, None], nb[None, :]) >= _PARTS * np.maximum(na[:, None], nb[None, :])))
            gone = _turned_down(ra, rb, parts[4], parts[9])
            if len(gone):
                keep = ~np.isin(i * len(rb) + j, gone)
                i, j = i[keep], j[keep]
            apart = _differing(parts[3].as_py(), parts[8].as_py(), i, j)
            near = 9 * apart <= na[i] + nb[j]
            u, v = spanning_pairs(ra, rb, i[near], j[near], apart[near] / (na[i[near]] + nb[j[near]]))
            of.append(np.full(len(u), key, np.int64))
            a.append(np.minimum(u, v))
            b.append(np.maximum(u, v))
        return {"list": pa.array(np.concatenate(of)), "a": pa.array(np.concatenate(a)), "b": pa.array(np.concatenate(b))}

    return by_batch(cells, ["list", *names], "list bigint, a bigint, b bigint", meet)


def _turned_down(ra: np.ndarray, rb: np.ndarray, no_a, no_b) -> np.ndarray:
    """Pairs turned down, as i * len(rb) + j; each stands at the smaller of its rows."""
    out = []
    for rows, lists_, others, turned in ((ra, no_a, rb, False), (rb, no_b, ra, True)):
        partner = np.asarray(lists_.values.flatten(), np.int64)
        if not len(partner):
            continue
        owner = np.repeat(np.arange(len(rows)), np.diff(np.asarray(lists_.values.offsets)))
        order = np.argsort(others)
        at = np.searchsorted(others[order], partner)
        hit = (at < len(others)) & (others[order][np.minimum(at, len(others) - 1)] == partner)
        mine, theirs = owner[hit], order[at[hit]]
        out.append(theirs * len(rb) + mine if turned else mine * len(rb) + theirs)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _differing(xs: list[bytes], ys: list[bytes], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits in which sketches i of xs and j of ys differ, at the size of the smaller one."""
    out = np.zeros(len(i), np.int64)
    size_x, size_y = np.array([len(x) for x in xs]), np.array([len(y) for y in ys])
    for width in sorted({*size_x.tolist(), *size_y.tolist()}):
        some = np.nonzero(np.minimum(size_x[i], size_y[j]) == width)[0]
        if not len(some):
            continue
        left, right = (_of_width(v, width) for v in (xs, ys))
        step = max(1, (1 << 22) // width)
        for at in range(0, len(some), step):
            k = some[at : at + step]
            out[k] = np.bitwise_count(left[0][left[1][i[k]]] ^ right[0][right[1][j[k]]]).sum(axis=1)
    return out


def _of_width(sketches: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of `width` bytes and those of twice that, folded, as words; and where each of `sketches` is among them."""
    place, made = np.full(len(sketches), -1), []
    for times in (1, 2):
        some = [k for k, s in enumerate(sketches) if len(s) == times * width]
        place[some] = np.arange(len(some)) + sum(map(len, made))
        bits = np.frombuffer(b"".join(sketches[k] for k in some), np.uint8).reshape(len(some), times * width)
        made.append((_folded(bits) if times == 2 and len(some) else bits[:, :width]).copy().view(np.uint64))
    return np.concatenate(made), place


def spanning_pairs(ra, rb, i, j, d) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs (ra[i], rb[j]), the closest first."""
    rows, index = np.unique(np.concatenate([ra, rb]), return_inverse=True)
    u, v = index[: len(ra)][i], index[len(ra) :][j]
    return _forest(rows, u, v, d)


def _forest(rows: np.ndarray, u: np.ndarray, v: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    chosen = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    rank = np.empty(len(u), np.int64)
    rank[np.argsort(d, kind="stable")] = np.arange(len(u))
    label = np.arange(len(rows))
    while len(u):
        best = np.full(len(rows), np.iinfo(np.int64).max)
        np.minimum.at(best, label[u], rank)
        np.minimum.at(best, label[v], rank)
        take = np.nonzero((rank == best[label[u]]) | (rank == best[label[v]]))[0]
        chosen.append((rows[u[take]], rows[v[take]]))
        x, y = label[u[take]], label[v[take]]
        while True:
            low = np.arange(len(rows))
            np.minimum.at(low, x, y)
            np.minimum.at(low, y, x)
            while (low[low] != low).any():
                low = low[low]
            if (low == np.arange(len(rows))).all():
                break
            label, x, y = low[label], low[x], low[y]
        keep = label[u] != label[v]
        u, v, rank = u[keep], v[keep], rank[keep]
    return np.concatenate([c[0] for c in chosen]), np.concatenate([c[1] for c in chosen])
