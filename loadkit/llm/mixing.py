"""Mixing of sources to target weights: exact quotas, a splitting tree over shards, permuted blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadkit.session import staged

from .common import WORD, forget, located, ship, spare

#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix by words of the corpus, and the most that a source is repeated.
SHARE, CAP = 1.5, 2
#: Blocks (passes over a document) of an output shard.
SHARD_BLOCKS = 4096
#: Slices of a source's permutation that are put in order apart from each other.
SLICES = 4096
SEED = 20
_FEW = 10**9 - 1


def targets(sources: DataFrame, share: float = SHARE, cap: float = CAP, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size, ...) -> with target: words that the mix takes of the source.

    Sources by code point, null last, weigh `weights` in turn and share `share` of all sizes by
    weight. None gets more than `cap` times its size; what is over is shared again among the
    others. That ends where each source has the smaller of its cap and its weight times one
    common rate. In ascending order of cap by weight the capped ones come first, so running sums
    give the rate. The sources are a short list, as in any mixture: one row each in one task.
    """
    total = F.sum("source_size").over(Window.partitionBy())
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = sources.withColumns(
        {"weight": F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((place - 1) % len(weights) + 1).cast("int")), "most": F.col("source_size") * float(cap), "all": total * share}
    )
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rate = (F.col("all") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    rated = ranked.withColumn("rate", rate)
    common = F.min(F.when(F.col("rate") * F.col("weight") <= F.col("most") + 1e-9, F.struct(F.col("most") / F.col("weight"), "rate"))).over(Window.partitionBy())["rate"]
    target = F.least(F.col("most"), F.coalesce(common, F.lit(float("inf"))) * F.col("weight"))
    return rated.select(*sources.columns, target.alias("target"))


def sizes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row its locator, id, source, words, and a hash that doesn't depend on where it lies."""
    return located(docs).select(
        F.col("_locator").alias("locator"), F.col(id_col).cast("long").alias("id"), F.col(source).cast("string").alias("source"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("size"), F.xxhash64(F.lit(SEED), id_col, text).alias("draw"),
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(sizes with source_size and target, drawn blocks).

    A block is one pass over one document. A source's quota, its target in whole words, is
    taken in full passes and then from blocks in a random order until it is met; the last block
    gives only the words that are missing. Blocks of a source are ranked through its passes, and
    each output shard takes a run of ranks, so shards are disjoint. How many blocks of each
    source a shard takes comes from the splitting tree. Within a shard blocks stand in random
    order (position).

    Drawn blocks: locator, id, source, size, pass, taken (words), shard, position. Null texts
    have no words, null sources are one source, null ids and repeated rows are drawn like
    others. Empty documents come along with a full pass. An empty table gives no block.
    The order depends on ids and texts only, so reruns agree.
    """
    rows = staged(sizes(docs, id_col, text, source), "sizes")
    sources = staged(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))), "targets")
    matched = F.col("r.source").eqNullSafe(F.col("s.source"))
    known = rows.alias("r").join(sources.alias("s"), matched).select("r.*", "source_size", "target")
    units = known.withColumn("pass", F.explode(F.array(F.lit(1), F.lit(2)))).withColumns(
        {"quota": F.round("target").cast("long"), "draw": F.xxhash64("draw", "pass")}
    )
    units = units.withColumns(
        {"quota": F.when(F.col("pass") == 1, F.least("quota", "source_size")).otherwise(F.greatest(F.col("quota") - F.col("source_size"), F.lit(0))), "slice": F.shiftrightunsigned("draw", 52)}
    ).where("quota > 0 OR (pass = 1 AND source_size = 0)")
    per_slice = units.groupBy("source", "pass", "slice").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("blocks"))
    ahead = Window.partitionBy("source", "pass").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = per_slice.select("source", "pass", "slice", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"{c}_ahead") for c in ("words", "blocks")])
    own = Window.partitionBy("source", "pass", "slice").orderBy("draw", "id", "locator")
    on = F.col("u.source").eqNullSafe(F.col("p.source")) & (F.col("u.pass") == F.col("p.pass")) & (F.col("u.slice") == F.col("p.slice"))
    within = units.withColumns({"so_far": F.sum("size").over(own) - F.col("size"), "nth": F.row_number().over(own) - 1})
    placed = within.alias("u").join(per_slice.alias("p"), on).select("u.*", (F.col("so_far") + F.col("words_ahead")).alias("begins"), (F.col("nth") + F.col("blocks_ahead")).alias("rank"))
    drawn = staged(
        placed.where("begins < quota OR quota = source_size").select(
            "locator", "id", "source", "size", "pass", "draw", "rank", F.least(F.col("size"), F.col("quota") - F.col("begins")).alias("taken")
        ),
        "drawn",
    )
    return known, _sharded(drawn)


def _sharded(drawn: DataFrame) -> DataFrame:
    """Give each drawn block its shard, by its rank among its source's blocks, and its position."""
    counts = drawn.groupBy("source", "pass").agg(F.count(F.lit(1)).alias("n")).collect()
    names = sorted({r.source for r in counts}, key=lambda s: (s is None, s or ""))
    quotas = np.zeros(len(names), np.int64)
    first = {r.source: r.n for r in counts if r["pass"] == 1}
    for r in counts:
        quotas[names.index(r.source)] += r.n
    shards = max(1, -(-int(quotas.sum()) // SHARD_BLOCKS))
    number = {s: i for i, s in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        tree = SplittingTree(quotas, shards)
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [number[s] for s in batch.column("source").to_pylist()]
            later = np.array([0 if p == 1 else first.get(names[s], 0) for s, p in zip(found, batch.column("pass").to_pylist(), strict=True)])
            shard = tree.find(np.array(found), batch.column("rank").to_numpy() + later)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], [*batch.schema.names, "shard"])

    ship(drawn.sparkSession)
    columns = ["locator", "id", "source", "size", "pass", "draw", "rank", "taken"]
    dealt = drawn.select(*columns).mapInArrow(run, "locator string, id bigint, source string, size bigint, pass int, draw bigint, rank bigint, taken bigint, shard bigint")
    position = F.row_number().over(Window.partitionBy("shard").orderBy(F.xxhash64("shard", "draw"), "id", "locator", "pass")) - 1
    return dealt.withColumn("position", position).drop("draw", "rank")


class SplittingTree:
    """Exact block quotas of every shard, by source.

    The root holds all quotas. A node over several shards gives its left half of the shards a
    multivariate hypergeometric draw from its blocks, as many as those shards hold, and the
    right half the rest; each node draws with a seed of its own, so that any task finds the same
    numbers by walking down from the root, and only where its blocks go.
    """

    def __init__(self, quotas: np.ndarray, shards: int, seed: int = SEED):
        self.quotas, self.shards, self.seed, self.held = quotas, shards, seed, {}

    def capacity(self, low: int, high: int) -> int:
        total = int(self.quotas.sum())
        return high * total // self.shards - low * total // self.shards

    def left(self, low: int, high: int, quotas: np.ndarray) -> np.ndarray:
        """Of a node over shards low to high: what its left half takes."""
        if (low, high) not in self.held:
            if len(self.held) > 1 << 16:
                self.held.clear()
            rng = np.random.default_rng([self.seed, low, high])
            self.held[low, high] = draw(rng, quotas, self.capacity(low, (low + high) // 2))
        return self.held[low, high]

    def find(self, source: np.ndarray, rank: np.ndarray) -> np.ndarray:
        shard, rank = np.zeros(len(rank), np.int64), rank.astype(np.int64)
        open_ = [(0, self.shards, self.quotas, np.arange(len(rank)))]
        while open_:
            low, high, quotas, rows = open_.pop()
            if not len(rows):
                continue
            if high - low == 1:
                shard[rows] = low
                continue
            left = self.left(low, high, quotas)
            goes = rank[rows] < left[source[rows]]
            rest = rows[~goes]
            rank[rest] -= left[source[rest]]
            middle = (low + high) // 2
            open_ += [(low, middle, left, rows[goes]), (middle, high, quotas - left, rest)]
        return shard

    def leaves(self) -> np.ndarray:
        """Quotas by shard and source."""
        out = np.zeros((self.shards, len(self.quotas)), np.int64)
        open_ = [(0, self.shards, self.quotas)]
        while open_:
            low, high, quotas = open_.pop()
            if high - low == 1:
                out[low] = quotas
            else:
                left, middle = self.left(low, high, quotas), (low + high) // 2
                open_ += [(low, middle, left), (middle, high, quotas - left)]
        return out


def draw(rng: np.random.Generator, counts: np.ndarray, n: int) -> np.ndarray:
    """Multivariate hypergeometric. Beyond the generator's range the blocks are first parted
    into equal strata, each of which gives its exact share of n."""
    total = int(counts.sum())
    if total <= _FEW:
        return rng.multivariate_hypergeometric(counts, n, method="marginals")
    strata = -(-total // (_FEW // 2))
    edges = [counts * k // strata for k in range(strata + 1)]
    out, given, seen = np.zeros_like(counts), 0, 0
    for a, b in zip(edges, edges[1:], strict=False):
        seen += int((b - a).sum())
        now = n * seen // total
        out += rng.multivariate_hypergeometric(b - a, now - given, method="marginals")
        given = now
    return out


def mixed_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: a row of `docs` for each drawn block, by shard and position.

    A block that is taken in part keeps its text up to the end of its last word taken. Columns of
    any name come along as they are; nulls, ties, repeated rows and empty tables are as in `mix`.
    """
    _, drawn = mix(docs)
    place = spare(docs)
    words = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(words, 1, F.col("_b.taken").cast("int")), "")
    rows = located(docs, place).alias("_d").join(drawn.alias("_b"), F.col(f"_d.{place}") == F.col("_b.locator"))
    whole = F.when(F.col("_b.taken") < F.col("_b.size"), cut).otherwise(F.col(f"_d.{text}")).alias(text)
    shard, position = spare(docs, "_shard"), spare(docs, "_position")
    out = rows.select(*[whole if c == text else F.col(f"_d.`{c}`") for c in docs.columns], F.col("_b.shard").alias(shard), F.col("_b.position").alias(position))
    return out.repartition(shard).sortWithinPartitions(shard, position).drop(shard, position)
