"""Exact duplicates by a stream whose state keeps one row per digest, with a check of all bytes.

DataFrame operations only. The stream's state lies in RocksDB on the executors' disks and its
change files in the checkpoint folder; there is no watermark, so nothing expires.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.session import release, staged, work_path
from loadkit.sources import fs

from .common import located

_ROCKS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else; null as empty. Texts of one byte per character need no table."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def remember(rows: DataFrame, state: str, checkpoint: str) -> DataFrame:
    """Stream a written table (digest, id, locator) into keyed state; the state as a table.

    Per digest: how many rows had it, and id and locator of the row with the largest id (of
    equal ids the largest locator; a null id is less than all). Each micro-batch writes the
    keys that it changed below `state` under its own number, so a batch that is repeated after
    a failure replaces what it wrote before. Both values only grow, so the largest is the last.
    More rows may be added under the same two paths later: the stream goes on from its state.
    """
    spark = rows.sparkSession
    before = {k: spark.conf.get(k, None) for k in _ROCKS}
    for k, v in _ROCKS.items():
        spark.conf.set(k, v)
    try:
        stream = spark.readStream.schema(rows.schema).parquet(rows._work_path)
        keyed = stream.groupBy("digest").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("id", "locator")).alias("keep"))
        run = (
            keyed.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{state}/batch={number}"))
            .start()
        )
        run.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    schema = "digest string, size bigint, keep struct<id: bigint, locator: string>, batch bigint"
    return spark.read.schema(schema).parquet(state).groupBy("digest").agg(F.max("size").alias("size"), F.max("keep").alias("keep"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per row of `docs`: id, locator, digest, keep_id, group_size, kept.

    Texts are equal when they are byte for byte the same after lower-casing A-Z; null counts as
    empty. Of equal texts the row with the largest id is kept (of equal ids the last in the
    files; a null id loses to any). An empty table gives an empty result; other columns are not
    read. A digest only proposes: the bytes of all rows of a digest seen twice are compared
    (least against greatest, combined before the shuffle, so a group of any size is one row a
    task); should a digest stand for several texts, its rows are grouped by the text itself.
    """
    spark = docs.sparkSession
    full = located(docs).select(F.col(id_col).cast("long").alias("id"), F.col("_locator").alias("locator"), lowered(F.col(text)).alias("text"))
    hashed = full.select("id", "locator", digest(F.col("text")).alias("digest"))
    rows = staged(hashed, "digests")
    kept, checkpoint = work_path(spark, "dedup-state"), work_path(spark, "dedup-checkpoint")
    state = staged(remember(rows, kept, checkpoint), "state")
    for folder in (kept, checkpoint):
        fs.delete(spark, folder)
    # two written tables, so that the join's shuffle is its own and a hot digest's rows can be split
    told = staged(rows.join(state, "digest"), "told")
    release(rows)
    release(state)
    seen = told.where("size > 1").select("locator", "digest")
    bytes_of = full.select("locator", "text").join(seen, "locator")
    clash = staged(
        bytes_of.groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b")).where("a <> b").select("digest"), "clashes"
    )
    out = told
    if not clash.isEmpty():
        mixed = full.join(told.join(clash, "digest").select("locator", "digest"), "locator")
        classes = mixed.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("id", "locator")).alias("keep"))
        split = mixed.join(classes, ["digest", "text"]).select("id", "locator", "digest", "size", "keep")
        out = told.join(clash, "digest", "left_anti").select(split.columns).union(split)
    return out.select(
        F.col("id").alias(id_col), "locator", "digest", F.col("keep.id").alias("keep_id"), F.col("size").alias("group_size"), (F.col("locator") == F.col("keep.locator")).alias("kept")
    )

