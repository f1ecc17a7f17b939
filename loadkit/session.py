"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "loadkit", **conf) -> SparkSession:
    """A session with the settings the library is written for.

    On a cluster pass no master: shuffle partitions, memory and the checkpoint folder
    come from the cluster's own defaults.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        cores = master[master.find("[") + 1 : -1] if "[" in master else "8"
        builder = (
            builder.master(master)
            .config("spark.driver.memory", conf.pop("driver_memory", "16g"))
            .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    """One process: driver and executors share their machine's folders (`local-cluster` does not count)."""
    return spark.sparkContext.master.split("[")[0] == "local"


def work_root(spark: SparkSession) -> str:
    """The folder for intermediate tables: `spark.checkpoint.dir` of the session.

    Executors on other machines must see it, so a machine-local folder is made only in
    local mode, where there are no other machines.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="loadkit-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the working folder."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def staged(df, label: str = "staged"):
    """Write `df` to the working folder and read it back.

    Used where a frame feeds several jobs: the written copy survives lost executors and
    pins non-deterministic columns, which a cache would not. `release` drops the copy.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._work_path = path
    return out


def release(df) -> None:
    """Delete the working copy behind a staged frame, once nothing will read it any more."""
    from .sources import fs

    path = getattr(df, "_work_path", None)
    if path:
        fs.delete(df.sparkSession, path)
