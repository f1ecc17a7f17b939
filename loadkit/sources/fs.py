"""The few file-system actions Spark has no DataFrame call for, through Hadoop's FileSystem."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def create_once(spark, path: str, text: str) -> bool:
    """Write a new small file; False when it exists already. The store arbitrates between writers."""
    fs, where = _fs(spark, path)
    if fs.exists(where):
        return False
    try:
        out = fs.create(where, False)
    except Exception as error:
        if "Exist" in str(error):
            return False
        raise
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    return True


def delete(spark, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.delete(where, True)


def children(spark, path: str) -> list[str]:
    """Names directly below a directory, sorted; empty when it is missing."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(where))


def copy_file(spark, source: str, target: str) -> None:
    """Byte copy of one file between (possibly different) file systems."""
    jvm = spark._jvm
    src_fs, src = _fs(spark, source)
    dst_fs, dst = _fs(spark, target)
    jvm.org.apache.hadoop.fs.FileUtil.copy(src_fs, src, dst_fs, dst, False, spark._jsc.hadoopConfiguration())


def make_dirs(spark, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.mkdirs(where)


def rename(spark, source: str, target: str) -> None:
    """Rename within one file system; the folders above the target are made."""
    fs, src = _fs(spark, source)
    dst = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"cannot rename {source} to {target}")
