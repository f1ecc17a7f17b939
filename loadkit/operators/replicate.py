"""Replication of a source into a table: full refresh, incremental by watermark, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.times import ntz
from ..sources.rows import newer_than_target
from . import merge as M
from .versioned import Table


def replicate(source: DataFrame, table: Table, as_of, mode: str, primary_key: str | None = None, update_key: str | None = None) -> int:
    """Returns the version published (unchanged when there was nothing new)."""
    if mode == "full-refresh":
        return table.overwrite(source, as_of, "full refresh") if table.current() else table.append(source, as_of, "full refresh")
    if mode == "snapshot":
        stamped = source.withColumn("_snapshot_at", ntz(as_of))
        # a folder for each copy, so that reading one prunes the others
        return table.append(stamped, as_of, "snapshot", partition_by=("_snapshot_at",))
    if mode == "incremental":
        if table.current() is None:
            return table.append(M.latest(source, [primary_key], update_key), as_of, "initial")
        base = table.current()
        target = table.read(base["snapshot_id"])
        fresh = newer_than_target(source, target, update_key)
        M.apply(table, lambda t: M.upsert(t, fresh, primary_key, update_key), as_of, "incremental", fresh)
        return table.current()["snapshot_id"]
    raise ValueError("mode is full-refresh, incremental or snapshot")


def snapshot_at(table: Table, taken_at) -> DataFrame:
    """Rows of one snapshot copy."""
    return table.read().where(F.col("_snapshot_at") == ntz(taken_at)).drop("_snapshot_at")
