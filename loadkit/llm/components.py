"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.session import release, staged


def components(links: DataFrame) -> DataFrame:
    """Links (a long, b long) -> (node, root): each linked node with the smallest node it reaches.

    Each round hangs every node below its smallest neighbour if that is smaller, follows the
    pointers to the roots by doubling, and lets the roots inherit the remaining links. A root
    that keeps a link loses to, or wins over, another one in the next round, so the rounds are
    logarithmic in practice. Each step is written to the working folder: lineage stays short
    and a lost executor costs its tasks only. A hub's links meet in one join key; the join
    splits them (adaptive skew join) and minima are combined before the shuffle.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = staged(links.where("a <> b").select(a, b).distinct(), "links")
    total = None
    while not edges.isEmpty():
        parent = _roots(staged(edges.groupBy("a").agg(F.min("b").alias("p")), "parents"))
        ra, rb = parent.toDF("a", "ra"), parent.toDF("b", "rb")
        up = (
            edges.join(ra, "a").join(rb, "b", "left").select("ra", F.coalesce("rb", "b").alias("rb")).where("ra <> rb")
        )
        left = staged(up.select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct(), "links")
        release(edges)
        edges, found = left, parent.toDF("node", "root")
        if total is not None:
            later = found.toDF("root", "above")
            moved = total.join(later, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
            found = staged(moved.union(found), "roots")
            release(total)
        total = found
    release(edges)
    return total if total is not None else links.selectExpr("a AS node", "b AS root").where("false")


def _roots(parent: DataFrame) -> DataFrame:
    """(a, p) with every p replaced by the end of its chain."""
    while True:
        above = parent.toDF("p", "pp")
        jumped = staged(
            parent.join(above, "p", "left").select("a", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")), "parents"
        )
        release(parent)
        parent = jumped.select("a", "p")
        parent._work_path = jumped._work_path
        if jumped.where("moved").isEmpty():
            return parent
