"""Merkle manifests of datasets, with nested-interval labels on all nodes.

Rows are leaves of a tree each (of their language, say), in an order; a leaf's rank is its place
there. Every two consecutive nodes of a level become one of the next, the last one alone if their
number is odd, until one is left. A node is labelled with the interval of leaf ranks that it
covers. So a node's ancestors are the nodes whose intervals contain its own, and its sibling
covers what its parent's interval has besides its own. The roots of the trees are the leaves of
one more tree, whose root stands for the whole dataset.

Levels are put in buckets of LEVELS. A block is the part of a tree that lies in one bucket below
one node, its top; it is built by one task, from 2^LEVELS nodes at most. What is above a block is
attached to it as a whole, by a join with the block of the next bucket whose interval contains
it, so a leaf costs no row for each of its ancestors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.session import staged

from .common import by_batch, located, ship

#: Levels of a bucket.
LEVELS = 8
#: The one tree above all others.
TOP = "top"
_NODES = "array<struct<level: int, low: bigint, high: bigint, digest: string>>"
#: The block with a tree's root.
_WHOLE = "low = 0 AND high = n"
_BLOCK = f"tree string, n bigint, bucket int, low bigint, high bigint, nodes {_NODES}"


def digest(values: list[Column]) -> Column:
    """SHA-256 of some values as text, each as its length in bytes and itself, null as a dash: no two rows are written alike."""
    return F.sha2(F.concat(*[F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string"))) for v in values]), 256)


def joined(digests: list[str]) -> str:
    """Digest of a node from those below it."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above n leaves."""
    return max(0, n - 1).bit_length()


def ranked(rows: DataFrame, tree: str, order: list) -> DataFrame:
    """`rows` with `rank`, the place in the tree's order from 0, and `n`, the number of the tree's rows. Both are written.

    Rows are dealt by ranges of (tree, order) and numbered within their range; how many rows of
    a tree the ranges before hold is one number a tree and range. A tree of any size is spread.
    """
    place = F.monotonically_increasing_id()
    dealt = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order).withColumn("_place", place)
    kept = staged(dealt.withColumn("_range", F.shiftrightunsigned("_place", 33)), "ordered")
    sizes = kept.groupBy(tree, "_range").agg(F.count(F.lit(1)).alias("_count"), F.min("_place").alias("_first"))
    before = Window.partitionBy(tree).orderBy("_range")
    offsets = sizes.select(
        tree, "_range", "_first", (F.sum("_count").over(before) - F.col("_count")).alias("_ahead"), F.sum("_count").over(Window.partitionBy(tree)).alias("n")
    )
    found = kept.join(offsets, [tree, "_range"]).withColumn("rank", F.col("_place") - F.col("_first") + F.col("_ahead"))
    return found.drop("_place", "_range", "_first", "_ahead")


def subtree(level: int, low: int, digests: list[str], n: int, levels: int = LEVELS) -> list[tuple[int, int, int, str]]:
    """Nodes (level, low, high, digest) of a block from the digests of its lowest ones, which begin with leaf `low` of n."""
    nodes, top = [], min(level + levels, height(n))
    while True:
        width = 1 << level
        nodes += [(level, low + i * width, min(low + (i + 1) * width, n), d) for i, d in enumerate(digests)]
        if level == top:
            return nodes
        digests = [joined(digests[i : i + 2]) for i in range(0, len(digests), 2)]
        level += 1


def build(leaves: DataFrame, kept: list[str] = (), levels: int = LEVELS) -> list[DataFrame]:
    """Leaves (tree, rank, n, digest and the columns `kept`) -> the blocks of each bucket, lowest first.

    A block: tree, n (leaves of the tree), bucket, low and high (the interval it covers), nodes
    (level, low, high, digest, in the order of levels and places; the last is its top) and, in
    the first bucket, items: digest and the columns kept of each leaf, in order.
    """
    most = leaves.agg(F.max("n")).first()[0]
    if most is None:
        return []
    out, fields = [], leaves.select("digest", *kept).schema
    items = f", items array<{fields.simpleString()}>"
    nodes = leaves.select("tree", "n", "rank", F.struct("digest", *kept).alias("item"))
    for bucket in range(max(1, -(-height(most) // levels))):
        span = levels * (bucket + 1)
        grouped = nodes.groupBy("tree", "n", F.shiftright("rank", span).alias("block")).agg(F.array_sort(F.collect_list(F.struct("rank", "item"))).alias("members"))
        rows = grouped.select("tree", "n", F.lit(bucket).alias("bucket"), F.col("members").getItem(0)["rank"].alias("low"), F.col("members.item").alias("items"))
        made = by_batch(rows, rows.columns, _BLOCK + (items if bucket == 0 else ""), _blocks(bucket, levels))
        out.append(staged(made, f"blocks{bucket}"))
        top = F.element_at("nodes", -1)
        nodes = out[-1].where(f"n > {1 << span}").select("tree", "n", F.col("low").alias("rank"), F.struct(top["digest"].alias("digest")).alias("item"))
    return out


def _blocks(bucket: int, levels: int):
    def fn(batch):
        trees, ns, lows, items = (batch.column(c) for c in ("tree", "n", "low", "items"))
        highs, nodes = [], []
        digests = items.flatten().field("digest").to_pylist()
        bounds = [0, *(items.offsets.to_numpy()[1:] - items.offsets[0].as_py()).tolist()]
        for k, (n, low) in enumerate(zip(ns.to_pylist(), lows.to_pylist(), strict=True)):
            made = subtree(levels * bucket, low, digests[bounds[k] : bounds[k + 1]], n, levels)
            highs.append(made[-1][2])
            nodes.append([dict(zip(("level", "low", "high", "digest"), node, strict=True)) for node in made])
        shape = pa.list_(pa.struct([("level", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("digest", pa.string())]))
        out = {"tree": trees, "n": ns, "bucket": batch.column("bucket"), "low": lows, "high": pa.array(highs, pa.int64()), "nodes": pa.array(nodes, shape)}
        return out | ({"items": items} if bucket == 0 else {})

    return fn


def nodes(blocks: list[DataFrame]) -> DataFrame:
    """All nodes: tree, level, low, high, digest. What is the top of one block and below another's comes once."""
    each = [b.select("tree", "n", F.posexplode("nodes").alias("at", "node"), F.size("nodes").alias("of")) for b in blocks]
    out = each[0]
    for b in each[1:]:
        out = out.union(b)
    again = (F.col("at") == F.col("of") - 1) & (F.col("node.high") - F.col("node.low") < F.col("n"))
    return out.where(~again).select("tree", "node.*")


def siblings(known: dict, level: int, low: int, high: int, n: int, top: int) -> list[tuple[str, str | None]]:
    """Of the node (level, low, high), level by level up to `top`: (side, digest) of the sibling.

    `known`: digests by interval and level. The parent is the node one level up whose interval
    contains the node's; the sibling covers the difference of both intervals, on the left (L) or
    the right (R); where there is no difference the node is alone (-, None).
    """
    out = []
    while level < top:
        width = 1 << (level + 1)
        above = low // width * width
        beyond = min(above + width, n)
        if above < low:
            out.append(("L", known[level, above, low]))
        elif high < beyond:
            out.append(("R", known[level, high, beyond]))
        else:
            out.append(("-", None))
        level, low, high = level + 1, above, beyond
    return out


def proofs(blocks: list[DataFrame], roots: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """Every leaf: tree, rank, digest, the columns kept, sides and siblings (a letter and, but for the
    lone, a digest of 64 digits for each level up to the root of all).

    roots: (tree, above_sides, above_siblings) tells what stands above each tree's root; None: nothing. From the
    highest bucket down, each block is joined with the block of the next bucket whose interval
    contains its own; the siblings of its top there, and what stands above that, become its own.
    `levels` is that of `build`.
    """
    if not blocks:
        raise ValueError("no leaves")
    above = None
    for bucket in reversed(range(len(blocks))):
        b = blocks[bucket]
        ends = b.where(_WHOLE)
        ends = ends.join(roots, "tree") if roots is not None else ends.withColumns({"above_sides": F.lit(""), "above_siblings": F.lit("")})
        if above is not None:
            shift = levels * (bucket + 2)
            a = above.select("tree", F.shiftright("low", shift).alias("at"), F.col("low").alias("outer_low"), F.col("high").alias("outer_high"), F.col("nodes").alias("outer"), "above_sides", "above_siblings")
            own = b.withColumn("at", F.shiftright("low", shift))
            met = own.join(a, ["tree", "at"]).where("outer_low <= low AND high <= outer_high").drop("at", "outer_low", "outer_high")
            names = [f"`{f.name}` {f.dataType.simpleString()}" for f in b.schema.fields]
            lifted = by_batch(met, [*b.columns, "outer", "above_sides", "above_siblings"], ", ".join(names) + ", above_sides string, above_siblings string", _lift(b.columns, levels * (bucket + 1)))
            ends = ends.select(*b.columns, "above_sides", "above_siblings").union(lifted)
        above = ends if bucket == 0 else staged(ends, f"above{bucket}")
    return _leaves(above, blocks[0].schema["items"].dataType.elementType)


def _known(nodes) -> dict:
    return {(x["level"], x["low"], x["high"]): x["digest"] for x in nodes}


def _lift(columns: list[str], level: int):
    def fn(batch):
        sides, found = [], []
        parts = [batch.column(c).to_pylist() for c in ("low", "high", "n", "outer", "above_sides", "above_siblings")]
        for low, high, n, outer, s, f in zip(*parts, strict=True):
            own = siblings(_known(outer), level, low, high, n, outer[-1]["level"])
            sides.append("".join(side for side, _ in own) + s)
            found.append("".join(d for _, d in own if d) + f)
        return {c: batch.column(c) for c in columns} | {"above_sides": pa.array(sides, pa.string()), "above_siblings": pa.array(found, pa.string())}

    return fn


def _leaves(blocks: DataFrame, item) -> DataFrame:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in item.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("tree", "n", "low", "high", "nodes", "above_sides", "above_siblings")}
                known, sides, found = _known(row["nodes"]), [], []
                for rank in range(row["low"], row["high"]):
                    own = siblings(known, 0, rank, rank + 1, row["n"], row["nodes"][-1]["level"])
                    sides.append("".join(side for side, _ in own) + row["above_sides"])
                    found.append("".join(d for _, d in own if d) + row["above_siblings"])
                items = batch.column("items")[k].values
                yield pa.RecordBatch.from_pydict(
                    {"tree": pa.array([row["tree"]] * len(sides), pa.string()), "rank": pa.array(range(row["low"], row["high"]), pa.int64())}
                    | {f.name: items.field(f.name) for f in item.fields} | {"sides": sides, "siblings": found}
                )

    ship(blocks.sparkSession)
    chosen = ["tree", "n", "low", "high", "nodes", "items", "above_sides", "above_siblings"]
    return blocks.select(*chosen).mapInArrow(run, f"tree string, rank bigint, {fields}, sides string, siblings string")


def folded(proved: DataFrame, leaf: str, name: str) -> DataFrame:
    """`proved` (with sides and siblings) with the root that follows from the digests in column `leaf`."""
    schema, columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in proved.schema.fields), proved.columns

    def fn(batch):
        out = []
        for own, sides, found in zip(*(batch.column(c).to_pylist() for c in (leaf, "sides", "siblings")), strict=True):
            at = 0
            for side in sides:
                if side == "-":
                    own = joined([own])
                    continue
                other = found[at : at + 64]
                own, at = joined([other, own] if side == "L" else [own, other]), at + 64
            out.append(own)
        return {c: batch.column(c) for c in columns} | {name: pa.array(out, pa.string())}

    return by_batch(proved, columns, f"{schema}, `{name}` string", fn)


def manifest(docs: DataFrame, tree: str, order: str, columns: list[str], altered: dict[str, Column] | None = None, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """(blocks of the nodes, proofs): every row of `docs` as a leaf of the tree that column `tree` names.

    A leaf is the digest of `columns`. Leaves ascend by column `order` (nulls first), equal ones
    by digest and then by their place in the files; null trees are one tree, before all others.
    Proofs: tree, rank, order column, digest (leaf), altered (digest of the row with columns
    replaced as `altered` says), subroot, root, sides and siblings. Texts of any length count
    whole; repeated rows are leaves each; other columns are not read; an empty table gives no row.
    """
    altered = altered or {}
    key = F.when(F.col(tree).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(tree)))
    leaf, other = digest([F.col(c) for c in columns]), digest([altered.get(c, F.col(c)) for c in columns])
    chosen = located(docs).select(key.alias("tree"), F.col(order).alias("order"), leaf.alias("digest"), other.alias("altered"), F.col("_locator").alias("locator"))
    leaves = ranked(staged(chosen, "leaves"), "tree", [F.col("order").asc_nulls_first(), "digest", "locator"])
    blocks = build(leaves, ["order", "altered"], levels)
    if not blocks:
        empty = "tree string, rank bigint, digest string, `order` bigint, altered string, sides string, siblings string, subroot string, root string"
        return [], docs.sparkSession.createDataFrame([], empty)
    tops = [b.where(_WHOLE).select("tree", F.element_at("nodes", -1)["digest"].alias("digest")) for b in blocks]
    subroots = tops[0]
    for more in tops[1:]:
        subroots = subroots.union(more)
    over = build(ranked(subroots.select(F.lit(TOP).alias("all"), F.col("tree").alias("name"), "digest"), "all", ["name"]).withColumnRenamed("all", "tree"), ["name"], levels)
    root = over[-1].select(F.element_at("nodes", -1)["digest"].alias("root"))
    above = proofs(over, levels=levels)
    ends = staged(above.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), F.col("sides").alias("above_sides"), F.col("siblings").alias("above_siblings")), "subroots")
    found = proofs(blocks, ends.drop("subroot"), levels)
    found = found.join(ends.select("tree", "subroot"), "tree").withColumn("root", F.lit(root.first()["root"]))
    return [*blocks, *over], found
