"""External tables: views over files, partition columns from paths, stored views and tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.numbers import rows
from ..functions.text import path_part
from ..functions.times import as_datetime, ntz
from ..sources.formats import FileFormat, reader
from ..sources.stage import stage_positional, stage_variant
from .versioned import Table


def external_table(spark: SparkSession, path: str, fmt: FileFormat, columns: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """A view over files. columns: name -> (source, type); None infers them.

    JSON sources are paths into the document (`device.type`), CSV sources are `c1`..`cn`,
    columnar sources are column names, so that unread columns are never read.
    """
    if columns is None:
        return reader(spark, fmt).load(path)
    if fmt.kind == "json":
        raw = stage_variant(spark, path, path)
        return raw.select(*[F.try_variant_get("v", f"$.{source}", kind).alias(n) for n, (source, kind) in columns.items()])
    if fmt.kind == "csv":
        width = max(int(source[1:]) for source, _ in columns.values())
        raw = stage_positional(spark, path, path, width, fmt)
    else:
        raw = reader(spark, fmt).load(path)
    return raw.select(*[F.col(source).try_cast(kind).alias(n) for n, (source, kind) in columns.items()])


def catalog_table(spark: SparkSession, name: str, path: str, kind: str = "parquet", schema: str | None = None, partitioned_by: list[str] = ()) -> DataFrame:
    """Register a directory in the catalog (dropped and made again if there) and return it."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    cols = f"({schema})" if schema else ""
    parts = f"PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    spark.sql(f"CREATE TABLE {name} {cols} USING {kind} {parts} LOCATION '{path}'")
    if partitioned_by:
        refresh(spark, name, partitioned=True)
    return spark.table(name)


def refresh(spark: SparkSession, name: str, partitioned: bool = False, partition: dict | None = None) -> None:
    """Pick up new files: the whole table, its partitions, or one partition."""
    if partition:
        add_partition(spark, name, partition)
    elif partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.sql(f"REFRESH TABLE {name}")


def _spec(values: dict) -> str:
    return ", ".join(f"{k}='{v}'" if isinstance(v, str) else f"{k}={v}" for k, v in values.items())


def add_partition(spark, name: str, *specs: dict) -> None:
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({_spec(s)})" for s in specs))


def drop_partition(spark, name: str, *specs: dict) -> None:
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(f"PARTITION ({_spec(s)})" for s in specs))


def show_partitions(spark, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {name}")


def hive_partitioned(spark: SparkSession, path: str, fmt: FileFormat, schema=None) -> DataFrame:
    """Partition columns from `key=value` directories; filters on them prune directories."""
    r = spark.read.format(fmt.kind)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def path_columns(parts: dict[str, tuple[int, str]]) -> dict[str, Column]:
    """Columns from positions in the file's path (negative from the end): name -> (position, type)."""
    return {n: path_part(F.col("_metadata.file_path"), at).cast(kind) for n, (at, kind) in parts.items()}


def positional_partitioned(df: DataFrame, parts: dict[str, tuple[int, str]]) -> DataFrame:
    return df.select("*", *[c.alias(n) for n, c in path_columns(parts).items()])


def path_date(df: DataFrame, year=-4, month=-3, day=-2, out="event_date") -> DataFrame:
    """A date column made of three path parts."""
    parts = [path_part(F.col("_metadata.file_path"), at) for at in (year, month, day)]
    return df.select("*", F.to_date(F.concat_ws("-", *parts), "yyyy-M-d").alias(out))


def with_partition_filter(df: DataFrame, ts: str, low, high, year="year", month="month", day="day") -> DataFrame:
    """A time range with the partition predicates that let it prune.

    A function over a partition column prunes nothing, so the range is also stated on
    year, month and day as plain comparisons.
    """
    a, b = as_datetime(low), as_datetime(high)

    def at_least(at):
        return (F.col(year) > at.year) | ((F.col(year) == at.year) & ((F.col(month) > at.month) | ((F.col(month) == at.month) & (F.col(day) >= at.day))))

    def at_most(at):
        return (F.col(year) < at.year) | ((F.col(year) == at.year) & ((F.col(month) < at.month) | ((F.col(month) == at.month) & (F.col(day) <= at.day))))

    return df.where(at_least(a) & at_most(b) & F.col(ts).between(ntz(a), ntz(b)))


def date_layout(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.day(ts)})


def repartition_layout(df: DataFrame, ts: str, path: str, mode: str = "overwrite") -> None:
    """Write rows into year / month / day directories.

    Rows of a day come together, and adaptive execution parts a day by its size: a heavy one is
    written by as many tasks as its bytes need, several light ones by one.
    """
    out = date_layout(df, ts).hint("rebalance", "year", "month", "day")
    out.write.mode(mode).partitionBy("year", "month", "day").parquet(path)


def pruning_report(full: DataFrame, filtered: DataFrame) -> DataFrame:
    """Files a filtered read touches, of all files of the table, from the plans alone."""
    total, scanned = len(full.inputFiles()), _planned_files(filtered)
    spark = full.sparkSession
    share = round(scanned * 100.0 / total, 2) if total else None
    return spark.createDataFrame([(scanned, total, share)], "partitions_scanned bigint, partitions_total bigint, pct_scanned double")


def _planned_files(df: DataFrame) -> int:
    """Distinct files that hold matching partitions: the file column is constant per file, so only pruned scans run."""
    return df.select(F.col("_metadata.file_path").alias("p")).distinct().count()


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows of each file; counted from footers for columnar files."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(rows("row_count"))


def external_stream(spark: SparkSession, path: str, fmt: FileFormat, schema) -> DataFrame:
    """Files as they land."""
    return spark.readStream.format(fmt.kind).options(**fmt.options()).schema(schema).load(path)


# ---- stored views ----------------------------------------------------------------------------


class StoredView:
    """A query kept as a table: filled on refresh, read at table speed."""

    def __init__(self, spark: SparkSession, path: str, build):
        self.table, self.build, self.suspended = Table(spark, path), build, False

    def refresh(self, as_of) -> int | None:
        """Evaluate the query and publish it as the next version; nothing while suspended."""
        if self.suspended:
            return None
        return self.table.overwrite(self.build(as_of), as_of, "refresh")

    def suspend(self) -> None:
        self.suspended = True

    def resume(self) -> None:
        self.suspended = False

    def read(self) -> DataFrame:
        return self.table.read()

    def refreshes(self) -> DataFrame:
        return self.table.snapshots().select("snapshot_id", F.col("committed_at").alias("refreshed_at"), "rows", "files")


def daily_summary(events: DataFrame, ts: str, kind: str, user: str) -> DataFrame:
    """Events and distinct users per day and type."""
    return events.groupBy(F.to_date(ts).alias("event_date"), kind).agg(rows("event_count"), F.count_distinct(user).alias("unique_users"))


def daily_totals(summary: DataFrame) -> DataFrame:
    """Roll-up of the summary. Distinct users per type do not add up to distinct users, and the name says so."""
    return summary.groupBy("event_date").agg(F.sum("event_count").alias("total_events"), F.sum("unique_users").alias("sum_of_type_uniques"))


def flatten_view(df: DataFrame, text: str, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """JSON text flattened to typed columns: name -> (path, type)."""
    v = F.try_parse_json(text)
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, *[F.try_variant_get(v, f"$.{p}", t).alias(n) for n, (p, t) in paths.items()])


def tiered_read(low, high, as_of, hot: DataFrame, warm: DataFrame, cold: DataFrame, ts: str, hot_days=7, warm_days=365) -> DataFrame:
    """Rows of a time range, each from the tier that holds its age; tiers outside the range are not read."""
    from ..functions.times import back

    a, b = as_datetime(low), as_datetime(high)
    edge_hot, edge_warm = back(as_of, days=hot_days), back(as_of, days=warm_days)
    slices = [(hot, max(a, edge_hot), b), (warm, max(a, edge_warm), min(b, edge_hot)), (cold, a, min(b, edge_warm))]
    out = None
    for df, start, end in slices:
        if start < end:
            part = df.where((F.col(ts) >= ntz(start)) & (F.col(ts) < ntz(end)))
            out = part if out is None else out.unionByName(part)
    return out if out is not None else hot.where(F.lit(False))


def catalog_read(spark: SparkSession, name: str) -> DataFrame:
    """A table of another catalog by its full name; the catalog is configured on the session."""
    return spark.table(name)
