"""Row streams with channels and offset tokens, message ingestion and change streams."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import merge as M
from ..operators.versioned import SNAPSHOT_SCHEMA, Table
from ..session import release, staged


def _append_once(table: Table, df: DataFrame, as_of, stream: str, batch_id: int) -> None:
    """Append a batch of a stream; a replay of the same batch does nothing."""
    if table.streamed(stream) < batch_id:
        table.append(df, as_of, "stream", f"{stream}-{batch_id:010d}", stream=(stream, batch_id))


def row_stream(
    source: DataFrame, table: Table, channel: str, checkpoint: str, as_of, *, casts: dict[str, str] | None = None,
    dead_letters: Table | None = None, interval: str | None = None,
):
    """Append a stream to a table, exactly once per (channel, batch).

    casts types the columns; rows that do not cast go to `dead_letters` and the stream goes
    on. Flush limits on rows, files or bytes are options of the source stream
    (maxOffsetsPerTrigger, maxFilesPerTrigger, maxBytesPerTrigger), the time limit is
    `interval`; without one all available data is processed and the stream ends.
    """
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:8]

    def load(batch: DataFrame, batch_id: int) -> None:
        stream = f"{channel}-{run}"
        if table.streamed(stream) >= batch_id:
            return
        if not casts:
            return _append_once(table, batch, as_of, stream, batch_id)
        bad = F.lit(False)
        for c, t in casts.items():
            bad = bad | (F.col(c).isNotNull() & F.col(c).try_cast(t).isNull())
        marked = staged(batch.withColumn("_bad", bad), "rows")
        if dead_letters is not None:
            lost = marked.where("_bad").select(F.to_json(F.struct(*batch.columns)).alias("rejected_data"), F.lit(channel).alias("channel"))
            _append_once(dead_letters, lost, as_of, stream, batch_id)
        # published last: a replay after a crash in between repeats only this step
        good = marked.where("not _bad").select(*[F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c) for c in batch.columns])
        _append_once(table, good, as_of, stream, batch_id)
        release(marked)

    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(load)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def offset_token(table: Table, channel: str) -> DataFrame:
    """Last batch of a channel that is in the table, as its current version tells."""
    now = table.current()
    mine = [n for stream, n in ((now["streams"] if now else None) or {}).items() if re.fullmatch(re.escape(channel) + "-[0-9a-f]{8}", stream)]
    return table.spark.createDataFrame([(max(mine, default=None),)], "offset_token bigint")


def latest_offsets(messages: DataFrame) -> DataFrame:
    """Last message time per topic, to compare with what has been loaded."""
    return messages.groupBy("topic").agg(F.max("timestamp").alias("last_message"), F.count(F.lit(1)).alias("messages"))


# ---- messages ----------------------------------------------------------------------------------


def kafka_messages(spark: SparkSession, servers: str, topics: list[str], max_offsets: int | None = None, **options) -> DataFrame:
    """(topic, key, value, timestamp) stream of Kafka topics; needs the spark-sql-kafka package."""
    r = spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), **options})
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", max_offsets)
    try:
        return r.load().selectExpr("topic", "cast(key as string) as key", "cast(value as string) as value", "timestamp")
    except Exception as error:
        if "kafka" in str(error).lower():
            raise RuntimeError("the kafka source needs the spark-sql-kafka package on the class path") from error
        raise


def land(messages: DataFrame, landing: str | T.StructType = "variant") -> DataFrame:
    """Payload as a VARIANT column, or as typed columns of a schema."""
    if landing == "variant":
        return messages.select(F.try_parse_json("value").alias("record_content"), F.col("topic").alias("record_topic"))
    doc = F.from_json("value", landing)
    return messages.select(doc.alias("d"), F.col("topic").alias("record_topic")).select("d.*", "record_topic")


def _is_object():
    return F.coalesce(F.schema_of_variant(F.try_parse_json("value")).startswith("OBJECT"), F.lit(False))


def inferred_schema(sample: DataFrame) -> T.StructType:
    """Schema of a batch of payloads, for landing with columns made from those that are objects.

    Numbers that aren't all whole are doubles, keys whose kinds differ are VARIANT, and a key that
    is always null has no column yet.
    """
    names = sample.select(F.schema_of_variant_agg(F.when(_is_object(), F.try_parse_json("value"))).alias("s")).head()["s"]
    found = _landing_type(T._parse_datatype_string(names.replace("OBJECT<", "struct<")))
    return found if isinstance(found, T.StructType) else T.StructType()


def _landing_type(found: T.DataType) -> T.DataType:
    if isinstance(found, T.StructType):
        return T.StructType([T.StructField(f.name, _landing_type(f.dataType)) for f in found if not isinstance(f.dataType, T.NullType)])
    if isinstance(found, T.ArrayType):
        return T.ArrayType(T.StringType() if isinstance(found.elementType, T.NullType) else _landing_type(found.elementType))
    return T.DoubleType() if isinstance(found, T.DecimalType) else found


def land_inferred(messages: DataFrame, table: Table) -> DataFrame:
    """Columns made from the payloads of a batch, in the types that the table has for them already.

    `record_content` keeps the text of payloads that are no objects, so none is lost. Whole numbers
    go into a column of doubles; any other change of a column's type is an error that stops the load.
    """
    held = {f.name: f.dataType for f in table.schema() or []}
    fields = []
    for f in inferred_schema(messages):
        old = held.get(f.name, f.dataType)
        if old != f.dataType and not (isinstance(old, T.DoubleType) and isinstance(f.dataType, T.LongType)):
            raise ValueError(f"column {f.name} is {old.simpleString()}, its payloads are {f.dataType.simpleString()}")
        fields.append(T.StructField(f.name, old))
    kept = [F.when(~_is_object(), F.col("value")).alias("record_content"), F.col("topic").alias("record_topic")]
    if not fields:
        return messages.select(*kept)
    doc = F.when(_is_object(), F.from_json("value", T.StructType(fields))).alias("d")
    return messages.select(doc, *kept).select("d.*", "record_content", "record_topic")


def ingest_topics(messages: DataFrame, topic_tables: dict[str, Table], checkpoint: str, as_of, landing="variant", interval: str | None = None):
    """Write each topic of a (topic, value) stream to its table, each at most once per batch.

    `landing` is "variant", "inferred" (`land_inferred`; tables get new columns as keys appear) or a schema.

    The batch is stored once with its topic as directory, so that every table reads only its own.
    """
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:8]

    def load(batch: DataFrame, batch_id: int) -> None:
        stored = staged(batch.select("topic", "value"), "messages")
        for topic, table in topic_tables.items():
            own = stored.where(F.col("topic") == topic)
            landed = land_inferred(own, table) if landing == "inferred" else land(own, landing)
            _append_once(table, landed, as_of, f"{topic}-{run}", batch_id)
        release(stored)

    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(load)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def flatten_payload(df: DataFrame, text: str, schema: str, out: str = "item") -> DataFrame:
    """One row per element of an array payload; works on streams and batches."""
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, F.explode(F.from_json(text, schema)).alias(out)).select(*keep, f"{out}.*")


# ---- change streams ------------------------------------------------------------------------------


def new_loads(table: Table, consumer: str) -> dict[str, list[str]]:
    """Published loads of appended data that this consumer has not handled, with the folders that each put into the table."""
    from ..sources import fs

    mine = F.filter("load_ids", lambda i: (i == F.col("load_id")) | i.startswith(F.concat("load_id", F.lit("/"))) | (i == F.concat("load_id", F.lit("-kept"))))
    appended = table.snapshots().where(F.col("operation").isin("append", "copy", "stream", "add files")).withColumn("parts", mine).where(F.size("parts") > 0)
    done = f"{table.path}/consumers/{consumer}"
    if fs.exists(table.spark, done):
        appended = appended.join(table.spark.read.schema("load_id string").json(done), "load_id", "left_anti")
    # ids of loads not handled yet, not rows
    return {r["load_id"]: r["parts"] for r in appended.orderBy("snapshot_id").select("load_id", "parts").collect()}


def consume(table: Table, consumer: str, action: Callable[[DataFrame], None], min_rows: int = 1) -> int:
    """Hand the appended rows not seen by `consumer` to `action`, if there are at least `min_rows`.

    Loads are marked as handled after the action; it may see a load again after a crash.
    """
    ids = new_loads(table, consumer)
    if not ids:
        return 0
    fresh = table._read_loads([part for parts in ids.values() for part in parts], table.schema())
    n = fresh.count()
    if n < min_rows:
        return 0
    action(fresh)
    marks = table.spark.createDataFrame([(i,) for i in ids], "load_id string")
    marks.coalesce(1).write.mode("append").json(f"{table.path}/consumers/{consumer}")
    return n


def on_new_data(table: Table, consumer: str, action, checkpoint: str, min_rows: int = 1, interval: str | None = None):
    """Stream of the table's versions; each new one offers the unseen rows to `action`."""
    versions = table.spark.readStream.schema(SNAPSHOT_SCHEMA).json(f"{table.path}/snapshots")
    writer = versions.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, _: consume(table, consumer, action, min_rows))
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def cdc_merge_stream(documents: DataFrame, table: Table, content: str, key: str, columns: list[str], checkpoint: str, as_of, interval: str | None = None):
    """Merge a stream of CDC envelopes into a table, batch by batch. Replays change nothing: changes
    no newer than the target are equal to what is there already. The table needs a boolean column
    `_deleted` for tombstones, else an old change that comes after a delete brings its key back;
    read it through `merge.cdc_live`.
    """
    if M.GONE not in table.read().columns:
        raise ValueError(f"a table that a CDC stream is merged into needs a column {M.GONE}")

    def apply(batch: DataFrame, _: int) -> None:
        changes = staged(M.cdc_changes(batch, content, key, columns), "changes")
        if not changes.isEmpty():
            M.apply(table, lambda now: M.merge_cdc(now, changes, key), as_of, "cdc merge", changes)
        release(changes)

    writer = documents.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def late_merge_stream(source: DataFrame, table: Table, key: str, event_time: str, checkpoint: str, as_of, interval: str | None = None):
    """Merge rows in any order: the newest event time per key wins, however batches are cut."""
    def apply(batch: DataFrame, _: int) -> None:
        rows = staged(batch, "late")
        if rows.isEmpty():
            return release(rows)
        if table.current() is None:
            table.append(M.clone_schema(rows), as_of, "create")
        M.apply(table, lambda now: M.upsert(now, rows, key, event_time), as_of, "late merge", rows)
        release(rows)

    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
