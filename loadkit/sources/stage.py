"""A stage is a directory. Listing, choosing and reading its files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.times import back, ntz
from ..functions.windows import running_before
from .formats import FileFormat, reader

LISTING_SCHEMA = "path string, name string, size bigint, last_modified timestamp_ntz"


def root_key(root: str) -> str:
    """The part of a root that every spelling of its files' paths contains."""
    return re.sub(r"^[A-Za-z0-9+.-]+:/*", "", root).strip("/") + "/"


def relative_name(path: Column, root: str) -> Column:
    """File name below the stage, the identity used for tracking."""
    key = F.lit(root_key(root))
    return F.substring(path, F.instr(path, root_key(root)) + F.length(key), F.length(path))


def decoded(path: Column) -> Column:
    """Plain text of a URI-encoded path. Most paths have nothing to decode, and that test is cheap per row."""
    return F.when(F.instr(path, "%") > 0, F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def file_name(root: str) -> Column:
    """relative_name of the row's file. The hidden path is URI-encoded, listing paths are not."""
    return relative_name(decoded(F.col("_metadata.file_path")), root)


def rows_by_file(df: DataFrame, root: str, file: str = "name", count: str = "row_count") -> DataFrame:
    """Rows of each file of a direct read: counted by raw path (footers only for columnar files), named afterwards."""
    counted = df.groupBy(F.col("_metadata.file_path").alias("_p")).agg(F.count(F.lit(1)).alias(count))
    # never NULL by construction: a join on the name must not push a null test of it back to every row
    name = F.coalesce(relative_name(decoded(F.col("_p")), root), F.lit(""))
    return counted.select(name.alias(file), count)


#: What Spark tells about files of any kind.
FILES = "path string, modificationTime timestamp, length bigint, content binary"


def list_stage(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """(path, name, size, last_modified) of every file below the stage; contents are not read."""
    return listed(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root), root, prefix)


def listed(files: DataFrame, root: str, prefix: str = "") -> DataFrame:
    listing = files.select(
        "path", relative_name(F.col("path"), root).alias("name"), F.col("length").alias("size"),
        F.col("modificationTime").cast("timestamp_ntz").alias("last_modified"),
    )
    return listing.where(F.col("name").startswith(prefix)) if prefix else listing


def select_files(
    listing: DataFrame, *, files: list[str] | None = None, pattern: str | None = None, prefix: str | None = None,
    size_limit: int | None = None,
) -> DataFrame:
    """FILES list, PATTERN regex (whole name), prefix and SIZE_LIMIT, in that order.

    Under a size limit a file is taken while the bytes taken before it are below the
    limit, oldest first, so at least one file is taken.
    """
    out = listing
    if files is not None:
        wanted = out.sparkSession.createDataFrame([(f,) for f in files], "name string")
        out = out.join(wanted, "name", "left_semi")
    if pattern:
        out = out.where(F.col("name").rlike(f"^(?:{pattern})$"))
    if prefix:
        out = out.where(F.col("name").startswith(prefix))
    if size_limit is not None:
        before = running_before(out, "size", "last_modified", ["name"], "_before")
        out = before.where(F.col("_before") < size_limit).drop("_before")
    return out.select("path", "name", "size", "last_modified")


def untracked(listing: DataFrame, tracked: DataFrame, as_of, days: int, load_uncertain=False, stage: str | None = None) -> DataFrame:
    """Files without a load inside the tracking window.

    A file is known by stage, name, size and time of change; one that was rewritten or lies in
    another stage is new. Only loads that put rows into the table count: a file that failed is
    taken again. History without times of change is compared on the rest.

    A file last changed before the window may have been loaded by a load no longer on
    record; it is left out unless `load_uncertain`.
    """
    recent = tracked.where((F.col("last_load_time") > ntz(back(as_of, days=days))) & F.col("status").isin("LOADED", "PARTIALLY_LOADED"))
    if stage is not None:
        recent = recent.where(F.regexp_replace("stage_location", "/+$", "") == stage.rstrip("/"))
    changed = F.col("file_modified") if "file_modified" in tracked.columns else F.lit(None).cast("timestamp_ntz")
    recent = recent.select(F.col("file_name").alias("name"), F.col("file_size").alias("_size"), changed.alias("_changed")).distinct()
    same = (
        (listing["name"] == recent["name"]) & (listing["size"] == recent["_size"])
        & (recent["_changed"].isNull() | (recent["_changed"] == listing["last_modified"].cast("timestamp_ntz")))
    )
    fresh = listing.join(recent, same, "left_anti")
    return fresh if load_uncertain else fresh.where(F.col("last_modified") > ntz(back(as_of, days=days)))


def read_stage(spark: SparkSession, path, fmt: FileFormat, schema=None) -> DataFrame:
    """Typed read of a stage path, list of paths or glob such as `logs/2024-01-*/*.json`."""
    r = reader(spark, fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def with_file_metadata(df: DataFrame, root: str) -> DataFrame:
    """File name, size, modification time, content key and block of each row's file."""
    m = "_metadata."
    return df.select(
        "*", file_name(root).alias("metadata_filename"), F.col(m + "file_size").alias("metadata_file_size"),
        F.col(m + "file_modification_time").cast("timestamp_ntz").alias("metadata_file_last_modified"),
        F.md5(F.concat_ws("|", file_name(root), F.col(m + "file_size").cast("string"), F.col(m + "file_modification_time").cast("string")))
        .alias("metadata_file_content_key"),
    )


def stage_variant(spark: SparkSession, path, root: str) -> DataFrame:
    """One VARIANT column `v` per JSON document, with its file. Unparsable documents are NULL."""
    return (
        spark.read.option("singleVariantColumn", "v").option("recursiveFileLookup", "true").json(path)
        .select("v", file_name(root).alias("file_name"))
    )


def stage_positional(spark: SparkSession, path, root: str, n: int, fmt: FileFormat | None = None) -> DataFrame:
    """Text columns c1..cn of CSV files, with their file."""
    fmt = fmt or FileFormat.csv()
    schema = ", ".join(f"c{i} string" for i in range(1, n + 1))
    return reader(spark, fmt).schema(schema).load(path).select("*", file_name(root).alias("file_name"))


def numbered_lines(spark: SparkSession, path, root: str) -> DataFrame:
    """Raw text lines with file name and 1-based line number.

    The lines are scanned once to count them per split and once to number them: a line's
    number is the lines in earlier splits of its file plus its place in its own split. The
    join is on (file, split), so a huge file spreads over as many tasks as it has splits.
    """
    from ..session import staged

    lines = staged(spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.col("value").alias("line"), file_name(root).alias("file_name"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_mid"),
    ), "lines")
    return with_row_number(lines, "file_name", "line_number").drop("_block", "_mid")


def with_row_number(df: DataFrame, file: str, out: str, rows: DataFrame | None = None) -> DataFrame:
    """Number `rows` (default: all of `df`) by their place in their file.

    `df` is a stored frame with `_block` (split start) and `_mid` (scan order); offsets of
    splits come from all of it, even when only some rows are to be numbered.
    """
    splits = df.groupBy(file, "_block").agg(F.count(F.lit(1)).alias("_count"), F.min("_mid").alias("_first"))
    return number_in_file(df if rows is None else rows, splits, file, out)


def number_in_file(rows: DataFrame, splits: DataFrame, file: str, out: str) -> DataFrame:
    """Number rows from their split's `_count` and `_first`. Joins on (file, split), so that
    a huge file spreads over as many tasks as it has splits.
    """
    # one row per split of a file
    ahead = Window.partitionBy(file).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(file, "_block", "_first", F.coalesce(F.sum("_count").over(ahead), F.lit(0)).alias("_offset"))
    numbered = rows.join(offsets, [file, "_block"])
    return numbered.withColumn(out, F.col("_offset") + F.col("_mid") - F.col("_first") + 1).drop("_offset", "_first")


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def read_manifest(spark: SparkSession, path) -> DataFrame:
    """(file_name, expected_rows, expected_checksum) from a JSON manifest."""
    raw = spark.read.schema("file_name string, row_count bigint, checksum string").json(path)
    return raw.select("file_name", F.col("row_count").alias("expected_rows"), F.col("checksum").alias("expected_checksum"))


def file_checksums(spark: SparkSession, path, root: str) -> DataFrame:
    """Row count and content checksum per staged file.

    Each line is hashed with its number, and the hashes are summed: sensitive to order and
    to every character, yet mergeable, so a huge file is not gathered in one task.
    """
    from ..functions.hashing import checksum

    lines = numbered_lines(spark, path, root)
    hashed = lines.select("file_name", F.md5(F.concat_ws("|", F.col("line_number").cast("string"), "line")).alias("_h"))
    return hashed.groupBy("file_name").agg(F.count(F.lit(1)).alias("row_count"), checksum(F.col("_h")).alias("checksum"))


def file_checksum_check(staged_sums: DataFrame, manifest: DataFrame) -> DataFrame:
    return manifest.join(staged_sums, "file_name").select(
        "file_name", "expected_rows", F.col("row_count").alias("actual_rows"), "expected_checksum",
        F.col("checksum").alias("computed_checksum"),
        F.when(F.col("expected_checksum") == F.col("checksum"), "PASS").otherwise("FAIL - Checksum mismatch").alias("status"),
    )


def duplicate_content(staged_sums: DataFrame) -> DataFrame:
    """Files whose content occurs under more than one name: one row per file, with its group's size."""
    groups = staged_sums.groupBy(F.col("checksum").alias("content_hash")).agg(F.count(F.lit(1)).alias("file_count")).where("file_count > 1")
    return staged_sums.select(F.col("checksum").alias("content_hash"), "file_name", "row_count").join(groups, "content_hash")
