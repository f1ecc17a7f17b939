"""Relational sources and row dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.times import as_datetime


def jdbc_incremental(spark: SparkSession, url: str, table: str, update_key: str, since, *, split_on: str | None = None,
                     bounds: tuple | None = None, partitions: int = 8, **options) -> DataFrame:
    """Rows of a relational table changed after `since`.

    The condition is part of the pushed query; with `split_on` and its bounds the read is
    spread over several connections.
    """
    at = as_datetime(since).isoformat(sep=" ")
    r = spark.read.format("jdbc").options(url=url, dbtable=f"(SELECT * FROM {table} WHERE {update_key} > TIMESTAMP '{at}') changed", **options)
    if split_on:
        r = r.options(partitionColumn=split_on, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions)
    return r.load()


def jdbc_query(spark: SparkSession, url: str, sql: str, **options) -> DataFrame:
    """The result of a query run by the relational source."""
    return spark.read.format("jdbc").options(url=url, query=sql, **options).load()


def rows_frame(spark: SparkSession, rows: list[dict], schema: T.StructType, batch: int = 100) -> DataFrame:
    """Row dictionaries as a DataFrame; nested values of string columns become JSON text.

    For rows a client holds in memory. `batch` rows go to one partition, so a large client
    buffer spreads over tasks.
    """
    import json

    text = {f.name for f in schema if isinstance(f.dataType, T.StringType)}

    def plain(name, value):
        return json.dumps(value) if name in text and isinstance(value, (dict, list)) else value

    data = [tuple(plain(f.name, r.get(f.name)) for f in schema) for r in rows]
    df = spark.createDataFrame(data, schema)
    return df.repartition(max(1, -(-len(data) // batch))) if len(data) > batch else df


def newer_than_target(source: DataFrame, target: DataFrame, update_key: str) -> DataFrame:
    """Source rows past the target's watermark; all of them when the target is empty."""
    mark = target.agg(F.max(update_key).alias("m")).scalar()
    return source.where(mark.isNull() | (F.col(update_key) > mark))
