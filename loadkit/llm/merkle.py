"""Fingerprints of documents as Merkle trees over their passages and sections. DataFrame functions only.

A passage is a line, or a sentence of it; passages keep their ends, so that they join to the
text again. A section is a run of passages that ends with a line whose own hash says so (one in
four), so an edit moves no border but near itself. A node's hash is 16 digits of the MD5 of what
is below it. A fingerprint is written as

    root : section , section , ... : passage , passage ; passage , ...

with the passages of a section parted by commas and sections by semicolons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import located

PASSAGE = r"(?<=\n)(?!\z)|(?<=[.!?] )(?!\z)"
#: First digits of a line's hash that end a section.
BORDERS = "0123"


def _node(below: Column) -> Column:
    return F.substring(F.md5(below), 1, 16)


def passages(text: Column) -> Column:
    """Hashes of all passages, as the last part of a fingerprint."""

    def leaf(p):
        ends = p.endswith("\n") & F.substring(F.md5(p), 1, 1).isin(*BORDERS)
        return F.concat(_node(p), F.when(ends, F.lit(";")).otherwise(F.lit(",")))

    return F.regexp_replace(F.array_join(F.transform(F.split(F.coalesce(text, F.lit("")), PASSAGE), leaf), ""), "[,;]$", "")


def sections(leaves: Column) -> Column:
    return F.array_join(F.transform(F.split(leaves, ";"), _node), ",")


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """`df` with the fingerprint of `text`, null as empty. Each step is a column of its own, so that it is worked out once."""
    a, b = f"{name}_leaves", f"{name}_sections"
    out = df.withColumn(a, passages(F.col(text))).withColumn(b, sections(F.col(a)))
    return out.withColumn(name, F.concat_ws(":", F.md5(F.col(b)), b, a)).drop(a, b)


def leaves(fingerprint: Column) -> Column:
    return F.split(F.split_part(fingerprint, F.lit(":"), F.lit(3)), "[,;]")


def likeness(a: Column, b: Column) -> Column:
    """Share of distinct passages that two fingerprints have in common: 1 if the roots are equal, 0 if nothing is shared."""
    x, y = F.array_distinct(leaves(a)), F.array_distinct(leaves(b))
    shared = 2.0 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y))
    return F.when(F.substring(a, 1, 32) == F.substring(b, 1, 32), 1.0).otherwise(shared)


def edits(a: Column, b: Column) -> Column:
    """Where `a` differs from `b`: passages of those sections of `a` that `b` doesn't have, without
    those that `b` has elsewhere, as (section, passage) from 0. Equal roots end the comparison."""
    known, other = F.split(F.split_part(b, F.lit(":"), F.lit(2)), ","), leaves(b)
    groups = F.split(F.split_part(a, F.lit(":"), F.lit(3)), ";")
    inside = F.transform(groups, lambda g, i: F.transform(F.split(g, ","), lambda p, k: F.struct(i.alias("section"), k.alias("passage"), p.alias("hash"), _node(g).alias("node"))))
    differs = F.filter(F.flatten(inside), lambda p: ~F.array_contains(known, p["node"]) & ~F.array_contains(other, p["hash"]))
    places = F.transform(differs, lambda p: F.struct(p["section"].alias("section"), p["passage"].alias("passage")))
    return F.when(F.substring(a, 1, 32) == F.substring(b, 1, 32), F.slice(places, 1, 0)).otherwise(places)


def with_next(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """`df` (with `_locator`) and, as `next_<column>`, the row that follows in descending order of
    ids; the first follows the last. Null ids come last, equal ids by their place.

    Ids are cut into slices at approximate quantiles, one slice a window. The first row of each
    slice is needed by the slice before too and is dealt to both; which these are is one row a
    slice. So there is one shuffle of the table, and no task sees more than its slice.
    """
    spark = df.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = df.agg(F.percentile_approx(id_col, [k / slices for k in range(1, slices)] or [0.5], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    some = [cuts[i : i + 64] for i in range(0, len(cuts), 64)]
    above = F.array(*[F.lit(x).cast("long") for x in [c[-1] for c in some]])
    groups = F.array(*[F.array(*[F.lit(x).cast("long") for x in c]) for c in some])
    full = F.size(F.filter(above, lambda x: x < F.col(id_col)))
    part = F.size(F.filter(F.coalesce(F.get(groups, full), F.array().cast("array<bigint>")), lambda x: x < F.col(id_col)))
    below = full * 64 + part
    slice_ = F.when(F.col(id_col).isNull(), F.lit(len(cuts) + 1)).otherwise(len(cuts) - below) if cuts else F.lit(0)
    dealt = df.withColumn("_slice", slice_.cast("int"))
    heads = dealt.groupBy("_slice").agg(F.max(F.struct(id_col, "_locator"))["_locator"].alias("_locator")).collect()
    heads = sorted((r["_slice"], r["_locator"]) for r in heads)
    needed = [(place, heads[k - 1][0]) for k, (_, place) in enumerate(heads)]
    extra = F.broadcast(spark.createDataFrame(needed, "_locator string, _before int"))
    twice = F.filter(F.array(F.struct(F.col("_slice").alias("slice"), F.lit(False).alias("again")), F.struct(F.col("_before").alias("slice"), F.lit(True).alias("again"))), lambda s: s["slice"].isNotNull())
    rows = dealt.join(extra, "_locator", "left").withColumn("_at", F.explode(twice)).withColumns({"_slice": F.col("_at.slice"), "_again": F.col("_at.again")})
    order = Window.partitionBy("_slice").orderBy("_again", F.col(id_col).desc_nulls_last(), F.col("_locator").desc())
    found = rows.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return found.where("NOT _again").drop("_slice", "_again", "_at", "_before")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of `docs` with its fingerprint and the next row's text: id, text, fingerprint, next_text, next_fingerprint.

    Null texts count as empty; equal rows are returned each; other columns are not read.
    """
    core = located(docs).select(F.col(id_col).cast("long").alias(id_col), F.coalesce(F.col(text), F.lit("")).alias("text"), "_locator")
    return with_next(with_fingerprint(core, "text", "fingerprint"), id_col, ["text", "fingerprint"]).drop("_locator")


def edited(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document against an edited one, whose last half is replaced by the start of the next document."""
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    both = fingerprints(docs, id_col, text).withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), F.char_length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))
    )
    both = with_fingerprint(both.drop("text", "next_text"), "edited", "edited_fingerprint")
    return both.withColumns({"near_edited": likeness(F.col("fingerprint"), F.col("edited_fingerprint")), "near_next": likeness(F.col("fingerprint"), F.col("next_fingerprint"))})
