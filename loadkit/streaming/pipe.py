"""A file pipe: each new file of a stage is loaded once, continuously.

The stream is one of files, not of rows: each micro-batch is a list of files, which are loaded
as by a bulk load, with its checks. The checkpoint remembers the names it has seen. The table's
history remembers what was loaded, by stage, name, size and time of change: so files of other
stages with equal names, and files rewritten or repaired since, are loaded too, and a file that
a bulk load or another pipe has loaded is not. A batch reads the history of the days on which
its files were changed, and the table's current version: neither grows with the table's age. A
version tells the last batch of each stream in it, so a batch replayed after a crash does nothing.
"""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.times import as_datetime
from ..operators import copy as C, ledger
from ..operators.versioned import Table
from ..sources.formats import FileFormat
from ..sources.stage import FILES, list_stage, listed, untracked

RUNNING, PAUSED, STALLED = "RUNNING", "PAUSED", "STALLED"


class Pipe:
    def __init__(
        self, spark: SparkSession, name: str, stage: str, fmt: FileFormat, columns, table: Table, checkpoint: str, *,
        on_error: str = "CONTINUE", select=None, where=None, audit=False, as_of=None, max_files: int | None = None,
        tracking_days: int = ledger.PIPE_TRACKING_DAYS, table_name: str | None = None,
    ):
        self.spark, self.name, self.stage, self.fmt, self.table = spark, name, stage, fmt, table
        self.columns = columns if isinstance(columns, C.Columns) else C.Columns(columns)
        self.checkpoint, self.on_error, self.select, self.where, self.audit = checkpoint, on_error, select, where, audit
        self.as_of, self.max_files, self.tracking_days = as_of, max_files, tracking_days
        self.table_name = table_name or table.path.rsplit("/", 1)[-1]
        self.query = None

    def _now(self):
        """The given `as_of`, or the wall clock of an unattended run."""
        return as_datetime(self.as_of) if self.as_of else datetime.now(timezone.utc).replace(tzinfo=None)

    def files(self, prefix: str = "") -> DataFrame:
        """The stream of the stage's files: path, name, size, last_modified. Their contents are not read."""
        r = self.spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true")
        if self.max_files:
            r = r.option("maxFilesPerTrigger", self.max_files)
        return listed(r.load(self.stage), self.stage, prefix)

    def _fresh(self, files: DataFrame, at) -> DataFrame:
        """Those of some files that no load on record has loaded."""
        days = [r["d"] for r in files.select(F.date_format("last_modified", "yyyy-MM-dd").alias("d")).distinct().collect()]
        return untracked(files, ledger.history(self.table, days=days), at, self.tracking_days, True, self.stage)

    def _load(self, files: DataFrame, at, **kw) -> DataFrame | None:
        # the names of one batch, which its micro-batch plan holds on the driver anyway
        chosen = self._fresh(files, at).collect()
        if not chosen:
            return None
        return C.load_files(
            self.spark, self.table, self.stage, self.fmt, self.columns, at, self.spark.createDataFrame(chosen, files.schema), on_error=self.on_error,
            select=self.select, where=self.where, audit=self.audit, table_name=self.table_name, pipe=self.name, paths=[r["path"] for r in chosen], **kw)

    def _load_batch(self, batch: DataFrame, batch_id: int, run: str) -> None:
        stream = f"{self.name}-{run}"
        if self.table.streamed(stream) >= batch_id:
            return
        files = self.spark.createDataFrame(batch.collect(), batch.schema)
        self._load(files, self._now(), load_id=f"{stream}-{batch_id}", stream=(stream, batch_id))

    def _writer(self, prefix: str = "", checkpoint: str | None = None):
        where = checkpoint or self.checkpoint
        run = hashlib.md5(where.encode()).hexdigest()[:8]
        return (
            self.files(prefix).writeStream.option("checkpointLocation", where).queryName(f"pipe-{self.name}-{run}")
            .foreachBatch(lambda batch, batch_id: self._load_batch(batch, batch_id, run))
        )

    def reload_changed(self, prefix: str = "") -> DataFrame | None:
        """Load files that were rewritten, or repaired after a failure, under a name that is on record.

        A stream of files takes a name once. This lists the stage and compares; `refresh` and
        `start` do it first. Returns the load's report, None if there was no such file.
        """
        at = self._now()
        seen = ledger.history(self.table).where(F.regexp_replace("stage_location", "/+$", "") == self.stage.rstrip("/")).select(F.col("file_name").alias("name")).distinct()
        return self._load(list_stage(self.spark, self.stage, prefix).join(seen, "name", "left_semi").select("path", "name", "size", "last_modified"), at)

    def start(self, seconds: int = 60):
        """Run until paused, one micro-batch per interval."""
        self.reload_changed()
        self.query = self._writer().trigger(processingTime=f"{seconds} seconds").start()
        return self.query

    def refresh(self, prefix: str = "", timeout: int | None = None) -> None:
        """Load all files not loaded yet, then stop. With a prefix, a separate checkpoint
        is used so that the pipe's own one keeps its place; the history prevents double loads.
        """
        self.reload_changed(prefix)
        where = f"{self.checkpoint}-{hashlib.md5(prefix.encode()).hexdigest()[:8]}" if prefix else None
        query = self._writer(prefix, where).trigger(availableNow=True).start()
        query.awaitTermination(timeout) if timeout else query.awaitTermination()

    def insert_files(self, files: list[str]) -> DataFrame:
        return C.copy_into(
            self.spark, self.table, self.stage, self.fmt, self.columns, self._now(), files=files, on_error=self.on_error, select=self.select,
            where=self.where, audit=self.audit, tracking_days=self.tracking_days, table_name=self.table_name, pipe=self.name)

    def pause(self) -> None:
        """Stop; files arriving now wait for the resume."""
        if self.query is not None:
            self.query.stop()

    def resume(self, seconds: int = 60):
        return self.start(seconds)

    def recreate(self, checkpoint: str) -> "Pipe":
        """The same pipe without memory of its own; the history keeps it from loading twice."""
        return Pipe(
            self.spark, self.name, self.stage, self.fmt, self.columns, self.table, checkpoint, on_error=self.on_error, select=self.select,
            where=self.where, audit=self.audit, as_of=self.as_of, max_files=self.max_files, tracking_days=self.tracking_days, table_name=self.table_name)

    def state(self) -> str:
        if self.query is None:
            return PAUSED
        if self.query.exception() is not None:
            return STALLED
        return RUNNING if self.query.isActive else PAUSED

    def pending(self) -> DataFrame:
        """Staged files that no load on record has loaded; failed ones wait too."""
        return untracked(list_stage(self.spark, self.stage), ledger.history(self.table), self._now(), self.tracking_days, True, self.stage)

    def status(self) -> DataFrame:
        """One row: pipe, state, pending files, newest file seen."""
        last = list_stage(self.spark, self.stage).agg(F.max("last_modified").alias("m")).scalar()
        return self.pending().agg(
            F.lit(self.name).alias("pipe_name"), F.lit(self.state()).alias("state"), F.count(F.lit(1)).alias("pending_files"),
        ).withColumn("last_message", last)


def backfill_if_behind(pipe: Pipe, limit: int = 500) -> DataFrame | None:
    """Load the backlog directly when more than `limit` files wait."""
    waiting = pipe.pending().count()
    if waiting <= limit:
        return None
    return C.copy_into(
        pipe.spark, pipe.table, pipe.stage, pipe.fmt, pipe.columns, pipe._now(), on_error=pipe.on_error, select=pipe.select, where=pipe.where,
        audit=pipe.audit, tracking_days=pipe.tracking_days, table_name=pipe.table_name, pipe=pipe.name)


def if_new_files(spark: SparkSession, stage: str, table: Table, action):
    """Run `action` when the stage holds files the table has no load of, ever."""
    always = untracked(list_stage(spark, stage), ledger.history(table), "9999-01-01 00:00:00", 3_000_000, True, stage)
    return None if always.isEmpty() else action()
