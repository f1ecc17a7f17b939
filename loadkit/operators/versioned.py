"""Tables as versioned Parquet directories.

Layout of a table at `path`:

    data/load_id=<id>/...     immutable Parquet written by one ordinary Spark job
    snapshots/<n>.json        one line: which load directories make up version n
    history/file_day=<day>/load_id=<id>/...  per-file load reports (see ledger)

A load of text lists its folder of good rows, `<id>/_class=good`. A table in folders (see folders) lists `<id>/_part=<n>` in place of whole load directories, with
the lower bound and the rows of each.

A version becomes visible by the creation of its snapshot file, so readers see all of a
write or nothing, and data left behind by a failed job is never part of any version.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.times import as_datetime, ntz
from ..sources import fs

SNAPSHOT_SCHEMA = (
    "snapshot_id bigint, parent_id bigint, committed_at timestamp_ntz, operation string, load_id string, "
    "load_ids array<string>, rows bigint, files bigint, schema_json string, partition_by array<string>, "
    "layout_key string, lows array<string>, part_rows array<bigint>, folder_rows bigint, streams map<string,bigint>"
)


class ConcurrentCommit(RuntimeError):
    """Another writer committed first and the write depended on the version it replaced."""


class Table:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- snapshots -------------------------------------------------------------------

    def snapshots(self) -> DataFrame:
        """All versions, one row each."""
        if not fs.children(self.spark, f"{self.path}/snapshots"):
            return self.spark.createDataFrame([], SNAPSHOT_SCHEMA)
        return self.spark.read.schema(SNAPSHOT_SCHEMA).json(f"{self.path}/snapshots")

    def current(self) -> dict | None:
        names = [n for n in fs.children(self.spark, f"{self.path}/snapshots") if n.endswith(".json")]
        return self._snapshot(int(names[-1].split(".")[0])) if names else None

    def streamed(self, stream: str) -> int:
        """Last batch of a stream that is in the table, -1 if none is. Reads the current version only."""
        now = self.current()
        return ((now["streams"] if now else None) or {}).get(stream, -1)

    def _snapshot(self, snapshot_id: int) -> dict:
        path = f"{self.path}/snapshots/{snapshot_id:010d}.json"
        return self.spark.read.schema(SNAPSHOT_SCHEMA).json(path).head().asDict()

    def _lookup(self, snapshot: int | None, timestamp) -> dict | None:
        if snapshot is not None:
            return self._snapshot(snapshot)
        if timestamp is not None:
            row = self.snapshots().where(F.col("committed_at") <= ntz(timestamp)).orderBy(F.desc("snapshot_id")).head()
            if row is None:
                raise ValueError(f"{self.path} has no version at or before {timestamp}")
            return row.asDict()
        return self.current()

    def schema(self) -> T.StructType | None:
        now = self.current()
        return self.schema_of(now) if now else None

    @staticmethod
    def schema_of(version: dict) -> T.StructType:
        return T.StructType.fromJson(json.loads(version["schema_json"]))

    # ---- reading ---------------------------------------------------------------------

    def read(self, snapshot: int | None = None, timestamp=None) -> DataFrame:
        """The current version, a given one, or the newest at a point in time."""
        at = self._lookup(snapshot, timestamp)
        if at is None:
            raise ValueError(f"{self.path} has no version yet")
        schema = T.StructType.fromJson(json.loads(at["schema_json"]))
        if not at["load_ids"]:
            return self.spark.createDataFrame([], schema)
        return self._read_loads(at["load_ids"], schema)

    def _read_loads(self, load_ids, schema) -> DataFrame:
        """Rows of some loads. Loads in folders below theirs are read apart from whole ones: one scan reads one kind."""
        base = f"{self.path}/data"
        full = T.StructType(schema.fields + [T.StructField("load_id", T.StringType())])
        out = None
        for some in _kinds(load_ids):
            df = self.spark.read.schema(full).option("basePath", base).parquet(*[f"{base}/load_id={i}" for i in some]).select(*[f"`{f.name}`" for f in schema.fields])
            out = df if out is None else out.unionByName(df)
        return out

    def read_part(self, part: str, schema: T.StructType, more: list[str]) -> DataFrame:
        """Rows of one folder of a load with further text columns that its files have."""
        full = T.StructType(schema.fields + [T.StructField(c, T.StringType()) for c in more])
        return self.spark.read.schema(full).parquet(f"{self.path}/data/load_id={part}")

    def files(self, snapshot: int | None = None) -> DataFrame:
        """Data files of a version: path and rows, from footers only."""
        at = self._lookup(snapshot, None)
        return self._footers(at["load_ids"], self.schema_of(at))

    def _footers(self, load_ids, schema) -> DataFrame:
        base = f"{self.path}/data"
        out = self.spark.createDataFrame([], "file_path string, file_size bigint, record_count bigint")
        for some in _kinds(load_ids):
            paths = [f"{base}/load_id={i}" for i in some]
            df = self.spark.read.schema(T.StructType(schema.fields + [T.StructField("load_id", T.StringType())])).option("basePath", base).parquet(*paths)
            out = out.unionByName(df.groupBy(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")).agg(F.count(F.lit(1)).alias("record_count")))
        return out

    # ---- writing ---------------------------------------------------------------------

    def write_data(self, df: DataFrame, load_id: str, partition_by=(), max_records=None, version: str | None = None) -> None:
        """Write one load's files. Not visible until committed; a retried job starts over."""
        writer = df.write.mode("overwrite")
        if version:
            writer = writer.option("parquet.writer.version", version)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if max_records:
            writer = writer.option("maxRecordsPerFile", max_records)
        writer.parquet(f"{self.path}/data/load_id={load_id}")

    def commit(self, load_ids, schema: T.StructType, as_of, operation: str, load_id: str, base: dict | None, partition_by=(), layout: dict | None = None, stream: tuple[str, int] | None = None) -> int:
        """Publish a version on top of `base`. Fails if somebody else published first.

        `stream` (name, batch) is remembered as that stream's last batch. `layout` describes folders; their rows are known, and `files` then counts folders.
        """
        number = (base["snapshot_id"] if base else 0) + 1
        # counted from footers of the new directory only, added to the base for appends
        rows, files = self._count_of(load_ids, schema, base) if layout is None else (sum(layout["part_rows"]), len(load_ids))
        line = json.dumps({
            "snapshot_id": number, "parent_id": base["snapshot_id"] if base else None,
            "committed_at": as_datetime(as_of).isoformat(), "operation": operation, "load_id": load_id, "load_ids": list(load_ids),
            "rows": rows, "files": files, "schema_json": json.dumps(_nullable(schema).jsonValue()),
            "partition_by": list(partition_by) or (base["partition_by"] if base else []),
            "streams": {**((base["streams"] if base else None) or {}), **({stream[0]: stream[1]} if stream else {})}, **(layout or {}),
        })
        if not fs.create_once(self.spark, f"{self.path}/snapshots/{number:010d}.json", line):
            raise ConcurrentCommit(f"version {number} of {self.path} exists already")
        return number

    def _count_of(self, load_ids, schema, base):
        kept = set(base["load_ids"]) if base else set()
        appended = kept <= set(load_ids)
        new = [i for i in load_ids if i not in kept] if appended else list(load_ids)
        rows, files = (base["rows"] or 0, base["files"] or 0) if base and appended else (0, 0)
        if new:
            got = self._footers(new, schema).agg(F.count(F.lit(1)).alias("f"), F.coalesce(F.sum("record_count"), F.lit(0)).alias("r")).head()
            rows, files = rows + got["r"], files + got["f"]
        return rows, files

    def append(self, df: DataFrame, as_of, operation="append", load_id=None, partition_by=(), attempts=10, stream=None) -> int:
        """Add rows. Appends by several writers do not conflict: the commit is retried on the newer version."""
        from . import folders

        load_id = load_id or new_load_id()
        base = self.current()
        if folders.is_foldered(base):
            return folders.append(self, df, as_of, operation, load_id, attempts, stream)
        partition_by = tuple(partition_by) or tuple(base["partition_by"] if base else ())
        self.write_data(df, load_id, partition_by)
        return self.publish_append(load_id, df.schema, as_of, operation, partition_by, attempts, stream=stream)

    def publish_append(self, load_id, schema, as_of, operation="append", partition_by=(), attempts=10, has_data=True, stream=None, listed: str | None = None) -> int:
        """Publish written data. `listed` is the load's id where that of its data has more to it."""
        for _ in range(attempts):
            base = self.current()
            if has_data and base and base["layout_key"]:
                raise ValueError(f"{self.path} is in folders: rows are added by append")
            old = self.schema_of(base) if base else None
            merged = merge_schemas(old, schema) if old else schema
            ids = (base["load_ids"] if base else []) + ([load_id] if has_data else [])
            try:
                return self.commit(ids, merged, as_of, operation, listed or load_id, base, partition_by, layout=_layout_of(base), stream=stream)
            except ConcurrentCommit:
                continue
        raise ConcurrentCommit(f"gave up committing to {self.path} after {attempts} attempts")

    def overwrite(self, df: DataFrame, as_of, operation="overwrite", base: dict | None = None, load_id=None, partition_by=(), max_records=None) -> int:
        """Replace all rows by `df`, which may read this table: new files, then the flip.

        `base` is the version `df` was computed from; a newer one makes the commit fail.
        """
        base = base if base is not None else self.current()
        load_id = load_id or new_load_id()
        partition_by = tuple(partition_by) or tuple(base["partition_by"] if base else ())
        self.write_data(df, load_id, partition_by, max_records)
        return self.commit([load_id], df.schema, as_of, operation, load_id, base, partition_by)

    def truncate(self, as_of) -> int:
        base = self.current()
        return self.commit([], self.schema(), as_of, "truncate", new_load_id(), base)

    def add_columns(self, fields: list[T.StructField], as_of) -> int:
        """Schema-only version: old files simply lack the columns and read as NULL."""
        base = self.current()
        schema = T.StructType(self.schema().fields + list(fields))
        return self.commit(base["load_ids"], schema, as_of, "add columns", new_load_id(), base, layout=_layout_of(base))

    def committed_loads(self) -> DataFrame:
        """Ids of all loads ever published, those of expired versions included."""
        live = self.snapshots().select("load_id")
        if not fs.exists(self.spark, f"{self.path}/expired"):
            return live
        return live.unionByName(self.spark.read.schema("load_id string").json(f"{self.path}/expired"))

    # ---- maintenance -----------------------------------------------------------------

    def expire(self, before) -> DataFrame:
        """Drop versions committed before `before`, never the current one, and data no kept version uses."""
        now = self.current()
        every = self.snapshots()
        old = every.where((F.col("committed_at") < ntz(before)) & (F.col("snapshot_id") != now["snapshot_id"]))
        kept = every.join(old.select("snapshot_id"), "snapshot_id", "left_anti")
        used = kept.select(F.explode("load_ids").alias("load_id")).distinct()
        dead = old.select(F.explode("load_ids").alias("load_id")).distinct().join(used, "load_id", "left_anti")
        # versions and load directories are counted in thousands; rows of data never come here
        gone = old.select("snapshot_id", "committed_at", "operation").collect()
        dirs = [r["load_id"] for r in dead.collect()]
        # the history keeps trusting the loads of dropped versions
        if gone:
            old.select("load_id").coalesce(1).write.mode("append").json(f"{self.path}/expired")
        for row in gone:
            fs.delete(self.spark, f"{self.path}/snapshots/{row['snapshot_id']:010d}.json")
        for load_id in dirs:
            # with a load's good rows go its bad ones
            fs.delete(self.spark, f"{self.path}/data/load_id={load_id.removesuffix('/_class=good')}")
        return self.spark.createDataFrame([tuple(r) for r in gone], "snapshot_id bigint, committed_at timestamp_ntz, operation string")

    def compact(self, as_of, target_mb=128, cluster_by=(), where=None) -> int:
        """Rewrite into files of about `target_mb`. With `where`, only load directories holding
        matching rows are rewritten; the others are kept as they are.
        """
        base = self.current()
        schema = self.schema()
        ids = base["load_ids"]
        if where is not None:
            hit = [self._with_load_id(some, schema).where(where).select("load_id").distinct() for some in _kinds(ids)]
            found = {r["load_id"] for df in hit for r in df.collect()}
            chosen = {i for i in ids if i.partition("/")[0] in found}
        else:
            chosen = set(ids)
        rewrite = [i for i in ids if i in chosen]
        if not rewrite:
            return base["snapshot_id"]
        keep = [i for i in ids if i not in chosen]
        df = self._read_loads(rewrite, schema)
        n = max(1, -(-self._bytes(rewrite) // (target_mb * 1024 * 1024)))
        out = cluster(df, cluster_by, n) if cluster_by else df.repartition(n)
        load_id = new_load_id()
        self.write_data(out, load_id, tuple(base["partition_by"]))
        return self.commit(keep + [load_id], schema, as_of, "compact", load_id, base)

    def _with_load_id(self, ids, schema):
        base = f"{self.path}/data"
        full = T.StructType(schema.fields + [T.StructField("load_id", T.StringType())])
        return self.spark.read.schema(full).option("basePath", base).parquet(*[f"{base}/load_id={i}" for i in ids])

    def _bytes(self, ids) -> int:
        df = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f"{self.path}/data/load_id={i}" for i in ids])
        return df.agg(F.sum("length")).head()[0] or 0

    def add_files(self, stage: str, as_of) -> int:
        """Append the rows of a stage's Parquet files by one Spark write, after checking their footers.

        Every file must have the table's columns with the same types. A staged file whose name
        does not end in .parquet is an error. Names that begin with _ or . are no files of a stage.
        """
        from ..sources.stage import list_stage

        left = list_stage(self.spark, stage).where(~F.col("name").endswith(".parquet"))
        some = [r["name"] for r in left.orderBy("name").limit(10).collect()]
        if some:
            raise ValueError(f"files of the stage that are not taken: {some}")
        found = self.spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(stage).schema
        base = self.current()
        want = self.schema() if base else found
        wrong = [f.name for f in want if f.name not in found.names or found[f.name].dataType != f.dataType]
        extra = [n for n in found.names if n not in want.names]
        if wrong or extra:
            raise ValueError(f"files do not match the table: missing or retyped {wrong}, unknown {extra}")
        rows = self.spark.read.option("recursiveFileLookup", "true").schema(want).parquet(stage)
        return self.append(rows, as_of, "add files")


def _kinds(load_ids: list[str]) -> list[list[str]]:
    """Loads by the kind of folder that they are in."""
    out: dict[str, list[str]] = {}
    for i in load_ids:
        out.setdefault(i.partition("/")[2].partition("=")[0], []).append(i)
    return list(out.values())


def _layout_of(version: dict | None) -> dict | None:
    return {k: version[k] for k in ("layout_key", "lows", "part_rows", "folder_rows")} if version and version["layout_key"] else None


def new_load_id() -> str:
    return uuid.uuid4().hex


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])


def merge_schemas(old: T.StructType, new: T.StructType) -> T.StructType:
    """Old columns in their order, then new ones; a changed type is refused."""
    types = {f.name: f.dataType for f in old}
    for f in new:
        if f.name in types and types[f.name] != f.dataType:
            raise ValueError(f"column {f.name} is {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType(old.fields + [f for f in new if f.name not in types])


def cluster(df: DataFrame, keys, n: int | None = None) -> DataFrame:
    """Range-partition and sort, so that file statistics prune on `keys`. The hash of the row
    spreads a hot key over several ranges.
    """
    cols = [F.col(k) for k in keys]
    spread = F.xxhash64(*[F.col(f.name) for f in df.schema if f.dataType.typeName() not in ("map", "variant")])
    ranged = df.repartitionByRange(n, *cols, spread) if n else df.repartitionByRange(*cols, spread)
    return ranged.sortWithinPartitions(*cols)


def write_open(df: DataFrame, name: str, mode: str, provider: str = "iceberg") -> None:
    """Append to, or create or replace, a table of an external open format by its catalog name."""
    writer = df.writeTo(name).using(provider)
    if mode == "append":
        df.writeTo(name).append()
    elif mode == "createOrReplace":
        writer.createOrReplace()
    else:
        raise ValueError("mode is append or createOrReplace")
