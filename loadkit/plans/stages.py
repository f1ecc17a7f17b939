"""Staged files written from the given tables, the input of the load queries.

Every event is written. Each file holds one day and batch, in event order. Two faults are
planted by fixed rules: a value that is no number, and a line cut short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import work_path
from .derive import raw_events, table

_MADE: dict = {}

# SQL for the same rows: b1 = value is no number, b2 = line is cut
STAGED_SQL = """
, staged AS (SELECT *, strftime(event_timestamp, '%Y-%m-%d') AS d, event_id % 4 AS batch,
    event_id % 97 = 0 AS b1, event_id % 211 = 5 AS b2,
    row_number() OVER (PARTITION BY strftime(event_timestamp, '%Y-%m-%d'), event_id % 4 ORDER BY event_id)::BIGINT AS line
  FROM raw_events)
, files AS (SELECT 'd=' || d || '/batch=' || batch::VARCHAR AS file, count(*)::BIGINT AS parsed, count(*) FILTER (b1 OR b2)::BIGINT AS bad,
    min(line) FILTER (b1 OR b2) AS first_line FROM staged GROUP BY 1) """


def once(spark: SparkSession, key, make):
    """Make a stage once per session; a stage is only read afterwards. What makes it is part of its key: makers don't share stages."""
    full = (spark.sparkContext.applicationId, make.__module__, make.__qualname__, *key)
    if full not in _MADE:
        _MADE[full] = make()
    return _MADE[full]


def event_lines(spark, sf_dir, faults=True) -> DataFrame:
    e = raw_events(spark, sf_dir)
    bad_value, cut = F.col("event_id") % 97 == 0, F.col("event_id") % 211 == 5
    value = F.when(bad_value, '"abc"').otherwise(F.col("value").cast("string")) if faults else F.col("value").cast("string")
    whole = F.concat(
        F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"event_type":"'), F.col("event_type"),
        F.lit('","event_timestamp":"'), F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.lit('","user_id":'), F.col("user_id").cast("string"), F.lit(',"value":'), value, F.lit(',"payload":'), F.col("props"), F.lit("}"),
    )
    e = e.withColumn("_line", whole)
    line = F.when(cut, F.expr("left(_line, length(_line) - 3)")).otherwise(F.col("_line")) if faults else F.col("_line")
    return e.select(
        F.date_format("event_timestamp", "yyyy-MM-dd").alias("d"), (F.col("event_id") % 4).cast("string").alias("batch"),
        "event_id", line.alias("value"))


def _by_day(df: DataFrame):
    return df.repartition("d", "batch").sortWithinPartitions("d", "batch", "event_id").drop("event_id").write.partitionBy("d", "batch")


def json_stage(spark, sf_dir, faults=True) -> str:
    def make():
        path = work_path(spark, "stage-json")
        _by_day(event_lines(spark, sf_dir, faults)).text(path)
        return path

    return once(spark, (sf_dir, "json", faults), make)


def csv_stage(spark, sf_dir) -> str:
    """Pipe-delimited order files with a header; the total of every 97th order reads `n/a`."""
    def make():
        path = work_path(spark, "stage-csv")
        o = table(spark, sf_dir, "orders")
        total = F.when(F.col("o_orderkey") % 97 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
        rows = o.select(
            F.year("o_orderdate").cast("string").alias("y"), F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"), F.when(F.col("o_orderkey") % 50 == 0, "NULL").otherwise(F.col("o_orderstatus")).alias("status"),
            total.alias("order_total"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("order_date"))
        rows.repartition("y").sortWithinPartitions("y").write.partitionBy("y").option("sep", "|").option("header", "true").csv(path)
        return path

    return once(spark, (sf_dir, "csv"), make)


def parquet_stage(spark, sf_dir, name="orders", kind="parquet") -> str:
    def make():
        path = work_path(spark, f"stage-{kind}")
        table(spark, sf_dir, name).write.format(kind).save(path)
        return path

    return once(spark, (sf_dir, kind, name), make)


def file_dir(c: str):
    """Directory of a staged file; its base name is chosen by Spark."""
    return F.regexp_replace(c, "/[^/]+$", "")
