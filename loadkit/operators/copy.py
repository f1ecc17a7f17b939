"""Bulk load of staged files with per-file error policies, validation and tracking.

A load of text is: choose files, parse them and write every row once, good and bad ones in
folders of their own below the load's, judge files from narrow columns of what was written,
record the history, publish the folder of good rows. Only if a policy skips files, or rows are
numbered, ordered or made distinct, are good rows read again and written anew.
Text formats are parsed to text fields and cast with try_cast, so that a bad value is an
error of its row and column, never a failed job. Everything per row stays inside built-in
expressions; the only shuffles are the per-file counts, combined before they are sent.
"""

from __future__ import annotations

import re
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.times import ntz
from ..session import release, staged
from ..sources import fs
from ..sources.formats import FileFormat, reader
from ..sources.stage import file_name, list_stage, number_in_file, rows_by_file, select_files, untracked, with_row_number
from . import folders, ledger
from .versioned import Table, cluster, new_load_id

# Default policy and the policy by environment.
DEFAULT_POLICY = "ABORT_STATEMENT"
POLICY_BY_ENVIRONMENT = {"dev": "ABORT_STATEMENT", "staging": "SKIP_FILE_10", "prod": "CONTINUE"}


class LoadAborted(RuntimeError):
    """ABORT_STATEMENT met an error; nothing was written."""


def policy_for(environment: str) -> str:
    return POLICY_BY_ENVIRONMENT[environment]


@dataclass(frozen=True)
class Policy:
    """Parsed ON_ERROR text."""

    kind: str
    limit: float = 0.0
    percent: bool = False

    @staticmethod
    def parse(text: str) -> "Policy":
        word = text.upper()
        if word in ("ABORT_STATEMENT", "CONTINUE", "SKIP_FILE"):
            return Policy(word)
        match = re.fullmatch(r"SKIP_FILE_(\d+)(%?)", word)
        if not match:
            raise ValueError(f"unknown ON_ERROR {text}")
        return Policy("SKIP_FILE", float(match[1]), match[2] == "%")

    def fails(self, errors: Column, parsed: Column) -> Column:
        """The file is left out: errors strictly above the limit."""
        if self.kind != "SKIP_FILE":
            return F.lit(False)
        seen = errors * 100.0 / parsed if self.percent else errors
        return (errors > 0) & (seen > self.limit)

    @property
    def error_limit(self) -> Column:
        return F.lit(int(self.limit) + 1 if self.kind == "SKIP_FILE" and not self.percent else 1).cast("bigint")


@dataclass(frozen=True)
class Columns:
    """Target columns, as a StructType or DDL text, and their rules.

    match: NONE (by position), CASE_SENSITIVE or CASE_INSENSITIVE names; lengths: maximum
    length of string columns, an error unless `truncate`; required: columns that must not
    be NULL; raw_column: keep the whole record under this name, as VARIANT where it parses.
    """

    schema: T.StructType | str
    match: str = "CASE_SENSITIVE"
    lengths: dict | None = None
    truncate: bool = False
    required: tuple[str, ...] = ()
    raw_column: str | None = None

    def __post_init__(self):
        if isinstance(self.schema, str):
            object.__setattr__(self, "schema", T.StructType.fromDDL(self.schema))


def _cast(raw: Column, to: T.DataType, fmt: FileFormat) -> Column:
    name = to.typeName()
    if name == "variant":
        return F.try_parse_json(raw)
    if name in ("struct", "array", "map"):
        return F.from_json(raw, to)
    if name == "binary":
        return raw.cast("binary")
    opts = fmt.options()
    if name in ("timestamp", "timestamp_ntz") and "timestampFormat" in opts:
        return F.try_to_timestamp(raw, F.lit(opts["timestampFormat"])).cast(to)
    if name == "date" and "dateFormat" in opts:
        return F.try_to_date(raw, opts["dateFormat"])
    return raw.try_cast(to)


def _place(root: str) -> list[Column]:
    return [file_name(root).alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.col("_metadata.file_size").alias("_size")]


def _text_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_corrupt"]])


def scan(load, root: str, fmt: FileFormat, cols: Columns) -> DataFrame:
    """Raw rows with `_file`, `_block`, `_size` and, for text formats, `_corrupt`.

    `load(kind, options, schema)` reads the files.
    """
    names = [f.name for f in cols.schema]
    whole_lines = fmt.kind == "json" and not (fmt.multi_line or fmt.strip_outer_array) and (cols.raw_column or cols.match == "CASE_INSENSITIVE")
    if whole_lines:
        lines = load("text", {"recursiveFileLookup": "true"}, T.StructType([T.StructField("value", T.StringType())])).where("trim(value) <> ''")
        return lines.select(F.col("value").alias("_line"), *_place(root))
    if fmt.text:
        text = [f"c{i + 1}" for i in range(len(names))] if fmt.kind == "csv" else names
        options = fmt.options() | {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}
        return load(fmt.kind, options, _text_schema(text)).select("*", *_place(root))
    return load(fmt.kind, fmt.options() | {"ignoreCorruptFiles": "true"}, None).select("*", *_place(root))


def _entry(name: str) -> Column:
    """Value of the first key that equals `name` in any case."""
    return F.filter("_entries", lambda e: F.lower(e["key"]) == name.lower())[0]["value"]


def _fields(df: DataFrame, fmt: FileFormat, cols: Columns) -> tuple[DataFrame, dict[str, Column]]:
    """A raw field expression per target column, with `_corrupt` present in the frame."""
    names = [f.name for f in cols.schema]
    if fmt.kind == "csv":
        return df, {n: F.col(f"c{i + 1}") for i, n in enumerate(names)}
    if "_line" in df.columns and cols.match == "CASE_INSENSITIVE":
        df = df.withColumn("_entries", F.map_entries(F.from_json("_line", "map<string,string>")))
        df = df.withColumn("_corrupt", F.when(F.col("_entries").isNull() | ~F.trim("_line").startswith("{"), F.col("_line")))
        return df, {n: _entry(n) for n in names}
    if "_line" in df.columns:
        parsed = F.from_json("_line", _text_schema(names), {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"})
        df = df.withColumn("_f", parsed).withColumn("_corrupt", F.col("_f._corrupt"))
        return df, {n: F.col(f"_f.`{n}`") for n in names}
    if fmt.kind == "json":
        return df, {n: F.col(f"`{n}`") for n in names}
    have = [c for c in df.columns if c not in ("_file", "_block", "_size", "_mid")]
    missing = F.lit(None).cast("string")
    if cols.match == "NONE":
        raw = {n: F.col(f"`{have[i]}`") if i < len(have) else missing for i, n in enumerate(names)}
    else:
        fold = str.lower if cols.match == "CASE_INSENSITIVE" else str
        known = {fold(c): c for c in have}
        raw = {n: F.col(f"`{known[fold(n)]}`") if fold(n) in known else missing for n in names}
    return df.withColumn("_corrupt", F.lit(None).cast("string")), raw


def parse(spark: SparkSession, paths, root: str, fmt: FileFormat, cols: Columns) -> DataFrame:
    """Parsed rows of the given files, see parse_rows."""
    def load(kind, options, schema):
        if kind == "avro":
            reader(spark, fmt)
        r = spark.read.format(kind).options(**options)
        return (r.schema(schema) if schema is not None else r).load(paths)

    return parse_rows(scan(load, root, fmt, cols), fmt, cols)


def same_schema_groups(spark: SparkSession, paths: list[str], fmt: FileFormat) -> list[list[str]]:
    """Columnar files by the schema in their footers: one group when all can be merged.

    Spark reads files of one frame by one schema. Only if that can't hold for all of them is
    each footer looked at by itself.
    """
    try:
        reader(spark, fmt, mergeSchema="true").load(paths).schema  # noqa: B018
        return [paths]
    except Exception as error:  # the classes differ between file formats
        if len(paths) == 1:
            raise
        found: dict[str, list[str]] = {}
        for path in paths:
            try:
                found.setdefault(reader(spark, fmt).load(path).schema.json(), []).append(path)
            except Exception:
                raise error from None
        return list(found.values())


def parse_all(spark: SparkSession, paths: list[str], root: str, fmt: FileFormat, cols: Columns) -> DataFrame:
    """Parsed rows of files whose schemas may differ."""
    if fmt.text:
        return parse(spark, paths, root, fmt, cols)
    parts = [parse(spark, group, root, fmt, cols) for group in same_schema_groups(spark, paths, fmt)]
    out = parts[0]
    for part in parts[1:]:
        # numbers of rows are apart between the groups, and no file is in two of them
        out = out.unionByName(part)
    return out


def incomplete_files(spark: SparkSession, work: DataFrame, paths: list[str], root: str, fmt: FileFormat, chosen: DataFrame) -> DataFrame:
    """Files of which fewer rows were read than their footers promise: damaged inside.

    The reader stops at a damaged page and goes on with the next file; what it gave of such a
    file is not loaded, and the file is reported as failed.
    """
    promised = rows_by_file(reader(spark, fmt).schema("_none int").load(paths), root)
    got = work.groupBy(F.col("_file").alias("name")).agg(F.count(F.lit(1)).alias("_got"))
    short = promised.join(got, "name", "left").where(F.coalesce("_got", F.lit(0)) != F.col("row_count"))
    return chosen.join(short.select("name"), "name", "left_semi")


def parse_rows(df: DataFrame, fmt: FileFormat, cols: Columns) -> DataFrame:
    """Typed target columns plus `_file`, `_block`, `_mid`, and for bad rows `_error`, `_error_column`, `_error_value`, `_record`."""
    df, raw = _fields(df.withColumn("_mid", F.monotonically_increasing_id()), fmt, cols)
    nulls = list(fmt.null_if) + ([""] if fmt.empty_as_null and fmt.kind == "csv" else [])
    lengths = cols.lengths or {}
    values, errors = [], []
    corrupt = F.col("_corrupt").isNotNull()
    if fmt.kind == "csv" and not fmt.error_on_column_count_mismatch:
        corrupt = F.lit(False)

    def error(bad: Column, message: str, column: str | None, value: Column) -> Column:
        return F.when(bad, F.struct(F.lit(message).alias("m"), F.lit(column).cast("string").alias("c"), value.cast("string").alias("v")))

    for f in cols.schema:
        field = raw[f.name]
        if fmt.text and nulls:
            field = F.when(~field.isin(nulls), field)
        same = not fmt.text and f.name in df.columns and df.schema[f.name].dataType == f.dataType
        value = field if same else _cast(field, f.dataType, fmt) if fmt.text else field.try_cast(f.dataType)
        kind = f.dataType.typeName()
        if not same and kind != "string":
            label = {"date": "Date", "timestamp": "Timestamp", "timestamp_ntz": "Timestamp", "boolean": "Boolean", "variant": "Document"}.get(kind, "Numeric value")
            errors.append(error(field.isNotNull() & value.isNull(), f"{label}: not recognized", f.name, field))
        if f.name in cols.required:
            errors.append(error(field.isNull(), "NULL result in a non-nullable column", f.name, F.lit(None)))
        if f.name in lengths:
            if cols.truncate:
                value = F.substring(value, 1, lengths[f.name])
            else:
                errors.append(error(F.length(value) > lengths[f.name], f"String: longer than {lengths[f.name]}", f.name, field))
        values.append(value.alias(f.name))
    broken = error(corrupt, "Record: cannot be parsed", None, F.col("_corrupt"))
    record = _record(df, fmt, raw)
    extra = []
    if cols.raw_column:
        document = _document(record, fmt) if fmt.kind == "json" else record
        extra = [document.alias(cols.raw_column)]
        if fmt.kind == "json":
            errors.append(error(document.isNull(), "Document: not recognized", cols.raw_column, record))
    found = F.coalesce(broken, *errors) if fmt.text or errors else F.lit(None).cast("struct<m:string,c:string,v:string>")
    out = df.select(*values, *extra, "_file", "_block", "_mid", found.alias("_e"), record.alias("_r"))
    return out.select(
        *[f"`{c}`" for c in out.columns if c not in ("_e", "_r")], F.col("_e.m").alias("_error"), F.col("_e.c").alias("_error_column"),
        F.col("_e.v").alias("_error_value"), F.when(F.col("_e").isNotNull(), F.col("_r")).alias("_record"),
    )


def _document(record: Column, fmt: FileFormat) -> Column:
    """The record as VARIANT; STRIP_NULL_VALUES removes its top-level nulls."""
    if not fmt.strip_null_values:
        return F.try_parse_json(record)
    fields = F.from_json(record, "map<string,variant>")
    return F.try_parse_json(F.to_json(F.map_filter(fields, lambda _, v: ~F.is_variant_null(v))))


def _record(df: DataFrame, fmt: FileFormat, raw: dict[str, Column]) -> Column:
    """The record as text, for rejects and raw columns."""
    if "_line" in df.columns:
        return F.col("_line")
    whole = F.to_json(F.struct(*[c.cast("string").alias(n) for n, c in raw.items()]))
    if fmt.kind == "csv":
        line = F.concat_ws(fmt.delimiter, *[F.coalesce(c, F.lit("")) for c in raw.values()])
        return F.coalesce("_corrupt", line)
    return F.coalesce("_corrupt", whole) if fmt.text else whole


@contextmanager
def _duplicate_keys(spark: SparkSession, fmt: FileFormat):
    """ALLOW_DUPLICATE for documents parsed inside: the last of repeated keys is kept, else the record is bad."""
    key = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(key)
    spark.conf.set(key, str(fmt.allow_duplicate).lower())
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _drop_header_rows(df: DataFrame, fmt: FileFormat) -> DataFrame:
    """SKIP_HEADER above one: the reader drops the first line, the rest go by row number."""
    if fmt.kind != "csv" or fmt.skip_header <= 1:
        return df
    return with_row_number(df, "_file", "_n").where(F.col("_n") > fmt.skip_header - 1).drop("_n")


#: The mark that whole files of a kind end with; in ORC one byte more, the length of the part before, comes after it.
_TAIL = {"parquet": "substring(content, -4) = cast('PAR1' as binary)", "orc": "substring(content, -4, 3) = cast('ORC' as binary)"}


def unreadable_files(spark: SparkSession, paths: list[str], root: str, fmt: FileFormat, listing: DataFrame) -> DataFrame:
    """Columnar files whose footer cannot be read.

    A scan of no columns touches footers only; with corrupt files ignored, a broken file is
    one that yields nothing and does not end with the format's mark.
    """
    seen = rows_by_file(reader(spark, fmt, ignoreCorruptFiles="true").schema("_none int").load(paths), root)
    # using the count keeps the aggregate below the join, so names are made per file and not per row
    seen = seen.where("row_count > 0").select("name")
    silent = listing.join(seen, "name", "left_anti")
    suspects = [r["path"] for r in silent.select("path").collect()]
    if not suspects:
        return silent
    if fmt.kind not in _TAIL:
        return silent
    tail = spark.read.format("binaryFile").load(suspects).where(_TAIL[fmt.kind]).select("path")
    return silent.join(tail, "path", "left_anti")


def _file_report(
    work: DataFrame, chosen: DataFrame, policy: Policy, where: Column | None, as_of, table_name: str, root: str, pipe: str | None, broken: DataFrame | None,
) -> DataFrame:
    """One history row per chosen file. Rows that `where` (or a class given to them) leaves out are no errors."""
    bad = F.col("_error").isNotNull()
    kept = F.col("_class") == _GOOD if "_class" in work.columns else ~bad & (F.coalesce(where, F.lit(False)) if where is not None else F.lit(True))
    # one small row per split carries the counts and the offset that numbers its rows
    splits = work.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_count"), F.min("_mid").alias("_first"), F.count_if(bad).alias("_bad"), F.count_if(kept).alias("_kept"))
    place = F.struct("_block", "_mid")
    first = work.where(bad).groupBy("_file").agg(
        F.min_by(F.struct("_error", "_error_column", "_error_value", "_record", "_block", "_mid"), place).alias("_e")).select("_file", "_e.*")
    numbered = number_in_file(first, splits, "_file", "_line").drop("_block", "_mid")
    return _report_rows(splits, numbered, chosen, policy, as_of, table_name, root, pipe, broken)


def _report_rows(splits, first, chosen, policy: Policy, as_of, table_name, root, pipe, broken) -> DataFrame:
    """History rows from per-split counts and the first error of each file."""
    counts = splits.groupBy("_file").agg(
        F.sum("_count").alias("row_parsed"), F.sum("_bad").alias("errors_seen"), F.sum("_kept").alias("_kept"))
    rows = chosen.withColumnRenamed("name", "_file").join(counts, "_file", "left").join(first, "_file", "left")
    dead = F.lit(False)
    if broken is not None:
        rows = rows.join(broken.select(F.col("name").alias("_file"), F.lit(True).alias("_dead")), "_file", "left")
        dead = F.coalesce("_dead", F.lit(False))
    parsed, errors = F.coalesce("row_parsed", F.lit(0)), F.coalesce("errors_seen", F.lit(0)) + F.when(dead, 1).otherwise(0)
    fails = dead | policy.fails(errors, parsed)
    loaded = F.when(fails, 0).otherwise(F.coalesce("_kept", F.lit(0)))
    status = F.when(fails, "LOAD_FAILED").when(errors == 0, "LOADED").when(loaded > 0, "PARTIALLY_LOADED").otherwise("LOAD_FAILED")
    at = F.instr(F.col("_record"), F.col("_error_value"))
    return rows.select(
        F.lit(table_name).alias("table_name"), F.lit(root).alias("stage_location"), F.col("_file").alias("file_name"),
        F.lit(pipe).cast("string").alias("pipe_name"), status.alias("status"), parsed.cast("bigint").alias("row_parsed"),
        loaded.cast("bigint").alias("row_count"), F.col("size").alias("file_size"), policy.error_limit.alias("error_limit"),
        errors.cast("bigint").alias("errors_seen"),
        F.when(dead, "File: cannot be read").otherwise(F.col("_error")).alias("first_error_message"),
        F.col("_line").alias("first_error_line_number"),
        F.when(at > 0, at).cast("bigint").alias("first_error_character"), F.col("_error_column").alias("first_error_column_name"),
        ntz(as_of).alias("last_load_time"), F.col("last_modified").cast("timestamp_ntz").alias("file_modified"),
    )


def choose(
    spark: SparkSession, table: Table, stage: str, as_of, *, files=None, pattern=None, prefix=None, size_limit=None, force=False,
    load_uncertain=False, tracking_days=ledger.BULK_TRACKING_DAYS,
) -> DataFrame:
    """Files this load takes."""
    listing = list_stage(spark, stage)
    chosen = select_files(listing, files=files, pattern=pattern, prefix=prefix)
    if not force:
        chosen = untracked(chosen, ledger.history(table), as_of, tracking_days, load_uncertain, stage)
    return select_files(chosen, size_limit=size_limit) if size_limit is not None else chosen


def copy_into(
    spark: SparkSession, table: Table, stage: str, fmt: FileFormat, columns: Columns | T.StructType | str, as_of, *,
    on_error: str = DEFAULT_POLICY, files=None, pattern=None, prefix=None, size_limit=None, force=False, load_uncertain=False,
    tracking_days=ledger.BULK_TRACKING_DAYS, select: list[Column] | None = None, where: Column | None = None, distinct=False,
    target_columns: list[str] | None = None, audit=False, purge=False, return_failed_only=False, table_name: str | None = None,
    pipe: str | None = None, partition_by=(), cluster_by=(), load_mode: str = "FULL_INGEST", load_id: str | None = None,
) -> DataFrame:
    """Load new files of `stage` into `table`; returns one report row per file.

    select/where see the parsed columns and `_file`, `_row`; rows that `where` drops are
    not errors. target_columns names the columns of `select` in the target.
    """
    cols = columns if isinstance(columns, Columns) else Columns(columns)
    name = table_name or table.path.rsplit("/", 1)[-1]
    chosen_df = choose(
        spark, table, stage, as_of, files=files, pattern=pattern, prefix=prefix, size_limit=size_limit, force=force,
        load_uncertain=load_uncertain, tracking_days=tracking_days)
    # the same list of paths Spark's own file index keeps on the driver for any scan
    chosen_rows = chosen_df.collect()
    if not chosen_rows:
        return ledger.load_report(spark.createDataFrame([], ledger.HISTORY_SCHEMA))
    if load_mode == "ADD_FILES_COPY":
        raise ValueError("use Table.add_files for ADD_FILES_COPY")
    chosen = spark.createDataFrame(chosen_rows, chosen_df.schema)
    return load_files(
        spark, table, stage, fmt, cols, as_of, chosen, on_error=on_error, select=select, where=where, distinct=distinct,
        target_columns=target_columns, audit=audit, purge=purge, return_failed_only=return_failed_only, table_name=name, pipe=pipe,
        partition_by=partition_by, cluster_by=cluster_by, load_id=load_id, paths=[r["path"] for r in chosen_rows])


def load_files(
    spark, table, stage, fmt, cols, as_of, chosen, *, on_error, select=None, where=None, distinct=False, target_columns=None,
    audit=False, purge=False, return_failed_only=False, table_name="table", pipe=None, partition_by=(), cluster_by=(), load_id=None, paths=(),
    stream=None,
) -> DataFrame:
    """The load proper, for files already chosen. `stream` (name, batch) is published with the rows."""
    load_id = load_id or new_load_id()
    policy = Policy.parse(on_error)
    broken = work = None
    if not fmt.text:
        broken = unreadable_files(spark, list(paths), stage, fmt, chosen)
        dead = {r["path"] for r in broken.select("path").collect()}
        paths = [p for p in paths if p not in dead]
        broken = broken if dead else None
        if dead and policy.kind == "ABORT_STATEMENT":
            raise LoadAborted(f"{table_name}: {len(dead)} files cannot be read, first {sorted(dead)[0]}")
    if paths and trusted(spark, list(paths), fmt, cols, select, where, audit):
        try:
            return _load_trusted(
                spark, table, stage, fmt, cols, as_of, chosen, list(paths), policy, broken, distinct=distinct, target_columns=target_columns,
                return_failed_only=return_failed_only, purge=purge, table_name=table_name, pipe=pipe, partition_by=partition_by,
                cluster_by=cluster_by, load_id=load_id, stream=stream)
        except UNREADABLE as error:
            if not _is_read_error(error):
                raise
            # a file is damaged inside: nothing was published; the checked way below finds out which one
            load_id = new_load_id()
    if paths and fmt.text and fmt.skip_header <= 1 and not (audit or distinct or cluster_by or folders.is_foldered(table.current())) and not _numbered(select):
        return _load_once(
            spark, table, stage, fmt, cols, as_of, chosen, list(paths), policy, select=select, where=where, target_columns=target_columns,
            return_failed_only=return_failed_only, purge=purge, table_name=table_name, pipe=pipe, partition_by=partition_by, load_id=load_id, stream=stream)
    copy = None
    if paths:
        with _duplicate_keys(spark, fmt):
            copy = staged(parse_all(spark, list(paths), stage, fmt, cols), "parsed")
        work = _drop_header_rows(copy, fmt)
        if not fmt.text:
            damaged = incomplete_files(spark, copy, list(paths), stage, fmt, chosen)
            names = [r["name"] for r in damaged.select("name").collect()]
            if names and policy.kind == "ABORT_STATEMENT":
                release(copy)
                raise LoadAborted(f"{table_name}: {len(names)} files cannot be read, first {sorted(names)[0]}")
            if names:
                found = spark.createDataFrame([(n,) for n in names], "name string")
                broken = found if broken is None else broken.select("name").union(found)
                work = work.join(found.withColumnRenamed("name", "_file"), "_file", "left_anti").select(*work.columns)
    if work is None:
        work = spark.createDataFrame([], _work_schema(cols))
    try:
        report = ledger.record(table, _file_report(work, chosen, policy, where, as_of, table_name, stage, pipe, broken), load_id)
        _abort_on_error(policy, report, table_name)
        good = work.where(F.col("_error").isNull())
        if policy.kind == "SKIP_FILE":
            skipped = report.where("status = 'LOAD_FAILED'").select(F.col("file_name").alias("_file"))
            good = good.join(skipped, "_file", "left_anti")
        rows = _project(work, good, cols, select, where, distinct, target_columns, audit, as_of)
        _publish(table, rows, load_id, as_of, partition_by, cluster_by, stream)
    finally:
        # the report is read from the history, so the parsed copy has served
        if copy is not None:
            release(copy)
    if purge:
        _purge(spark, report, chosen)
    return ledger.load_report(report, return_failed_only)


#: Classes of the rows of a load: taken, left out by `where`, in error.
_GOOD, _OUT, _BAD = "good", "out", "bad"
_PLACE = ["_file", "_block", "_mid", "_error", "_error_column", "_error_value", "_record"]
_PLACE_SCHEMA = "_file string, _block bigint, _mid bigint, _error string, _error_column string, _error_value string, _record string, _class string"


def _numbered(select) -> bool:
    """Whether expressions use the rows' numbers, which are known only when all rows of a file are counted."""
    return bool(select) and any(re.search(r"\b_row\b", str(c)) for c in select)


def _load_once(
    spark, table, stage, fmt, cols, as_of, chosen, paths, policy, *, select, where, target_columns, return_failed_only, purge, table_name,
    pipe, partition_by, load_id, stream,
) -> DataFrame:
    """Load of text in one write: `_class=good` below the load's folder is what the version lists.

    Rows that are not taken have no values, only their place and error. Numbers of rows are
    stored as differences, so the place adds next to nothing to the good rows.
    """
    with _duplicate_keys(spark, fmt):
        parsed = parse_all(spark, paths, stage, fmt, cols)
        taken = F.coalesce(where, F.lit(False)) if where is not None else F.lit(True)
        marked = parsed.withColumn("_class", F.when(F.col("_error").isNotNull(), _BAD).when(taken, _GOOD).otherwise(_OUT))
        base = [f.name for f in cols.schema] + ([cols.raw_column] if cols.raw_column else [])
        picked = select if select is not None else [F.col(f"`{c}`") for c in base]
        rows = marked.select(*picked)
        names = [*(target_columns or []), *rows.columns[len(target_columns or []):]]
        good = F.col("_class") == _GOOD
        out = marked.select(*[F.when(good, c).alias(n) for c, n in zip(picked, names, strict=True)], *_PLACE, "_class")
        path = f"{table.path}/data/load_id={load_id}"
        table.write_data(out, load_id, ("_class", *partition_by), version="PARQUET_2_0")
    some = any(c.startswith("_class=") for c in fs.children(spark, path))
    work = spark.read.schema(_PLACE_SCHEMA).parquet(path) if some else spark.createDataFrame([], _PLACE_SCHEMA)
    report = ledger.record(table, _file_report(work, chosen, policy, None, as_of, table_name, stage, pipe, None), load_id)
    try:
        _abort_on_error(policy, report, table_name)
    except LoadAborted:
        fs.delete(spark, path)
        raise
    schema = rows.toDF(*names).schema
    part = f"{load_id}/_class={_GOOD}"
    if policy.kind == "SKIP_FILE" and not (skipped := report.where("status = 'LOAD_FAILED' AND row_parsed > errors_seen")).isEmpty():
        kept = table.read_part(part, schema, ["_file"]).join(skipped.select(F.col("file_name").alias("_file")), "_file", "left_anti") if fs.exists(spark, f"{table.path}/data/load_id={part}") else spark.createDataFrame([], schema)
        again = f"{load_id}-kept"
        table.write_data(kept.select(*[f"`{f.name}`" for f in schema]), again, partition_by)
        fs.delete(spark, path)
        table.publish_append(again, schema, as_of, "copy", partition_by, stream=stream, listed=load_id)
    else:
        there = fs.exists(spark, f"{table.path}/data/load_id={part}")
        table.publish_append(part if there else load_id, schema, as_of, "copy", partition_by, has_data=there, stream=stream, listed=load_id)
    if purge:
        _purge(spark, report, chosen)
    return ledger.load_report(report, return_failed_only)


def _abort_on_error(policy: Policy, report: DataFrame, table_name: str) -> None:
    if policy.kind != "ABORT_STATEMENT":
        return
    first = report.where("errors_seen > 0").orderBy("file_name").head()
    if first is not None:
        raise LoadAborted(
            f"{table_name}: {first['first_error_message']} in {first['file_name']} line {first['first_error_line_number']} "
            f"column {first['first_error_column_name']}")


def _publish(table: Table, rows: DataFrame, load_id: str, as_of, partition_by, cluster_by, stream=None) -> None:
    if cluster_by:
        rows = cluster(rows, cluster_by)
    if folders.is_foldered(table.current()):
        table.append(rows, as_of, "copy", load_id, stream=stream)
        return
    table.write_data(rows, load_id, partition_by)
    table.publish_append(load_id, rows.schema, as_of, "copy", partition_by, stream=stream)


def _purge(spark: SparkSession, report: DataFrame, chosen: DataFrame) -> None:
    """Delete the fully loaded files of this load; failed and partial ones stay."""
    done = report.where("status = 'LOADED'").select(F.col("file_name").alias("name"))
    for r in chosen.join(done, "name", "left_semi").select("path").toLocalIterator():
        fs.delete(spark, r["path"])


UNREADABLE = (PySparkException, Py4JJavaError)


def _is_read_error(error: Exception) -> bool:
    return bool(re.search(r"FAILED_READ_FILE|Encountered error while reading file|CANNOT_READ_FILE", str(error)))


def trusted(spark, paths: list[str], fmt: FileFormat, cols: Columns, select, where, audit) -> bool:
    """No row can be in error: a columnar file set whose columns have the target's types, taken as they are."""
    if fmt.text or select or where is not None or audit or cols.lengths or cols.required or cols.raw_column or cols.match == "NONE":
        return False
    fold = str.lower if cols.match == "CASE_INSENSITIVE" else str
    try:
        schema = reader(spark, fmt, mergeSchema="true").load(paths).schema
    except Exception:  # the files don't have one schema; the classes differ between file formats
        return False
    found = {fold(f.name): f.dataType for f in schema}
    return all(found.get(fold(f.name)) == f.dataType for f in cols.schema)


def _load_trusted(
    spark, table, stage, fmt, cols, as_of, chosen, paths, policy, broken, *, distinct, target_columns, return_failed_only, purge, table_name,
    pipe, partition_by, cluster_by, load_id, stream=None,
) -> DataFrame:
    """Columnar load without a working copy: counts come from footers, rows are written straight from the source."""
    source = reader(spark, fmt, mergeSchema="true").load(paths)
    fold = str.lower if cols.match == "CASE_INSENSITIVE" else str
    known = {fold(c): c for c in source.columns}
    rows = source.select(*[F.col(f"`{known[fold(f.name)]}`").alias(f.name) for f in cols.schema])
    none = F.lit(None).cast("string")
    counts = rows_by_file(source, stage, "_file", "_count")
    splits = counts.select(
        "_file", F.lit(0).cast("bigint").alias("_block"), "_count", F.lit(0).cast("bigint").alias("_first"), F.lit(0).cast("bigint").alias("_bad"),
        F.col("_count").alias("_kept"))
    no_errors = counts.where("false").select(
        "_file", none.alias("_error"), none.alias("_error_column"), none.alias("_error_value"), none.alias("_record"), F.lit(0).cast("bigint").alias("_line"))
    report = ledger.record(table, _report_rows(splits, no_errors, chosen, policy, as_of, table_name, stage, pipe, broken), load_id)
    if target_columns:
        rows = rows.toDF(*target_columns)
    _publish(table, rows.dropDuplicates() if distinct else rows, load_id, as_of, partition_by, cluster_by, stream)
    if purge:
        _purge(spark, report, chosen)
    return ledger.load_report(report, return_failed_only)


def _work_schema(cols: Columns) -> T.StructType:
    fields = list(cols.schema.fields)
    if cols.raw_column:
        fields.append(T.StructField(cols.raw_column, T.StringType()))
    text = [T.StructField(n, T.StringType()) for n in ("_error", "_error_column", "_error_value", "_record")]
    place = [T.StructField("_file", T.StringType()), T.StructField("_block", T.LongType()), T.StructField("_mid", T.LongType())]
    return T.StructType(fields + place + text)


def _project(work, good, cols, select, where, distinct, target_columns, audit, as_of) -> DataFrame:
    base = [f.name for f in cols.schema] + ([cols.raw_column] if cols.raw_column else [])
    if audit or _numbered(select):
        # numbers count every record of the file, bad ones included
        good = with_row_number(work, "_file", "_row", good)
    if where is not None:
        good = good.where(where)
    picked = select if select is not None else [F.col(f"`{c}`") for c in base]
    extra = []
    if audit:
        extra = [
            F.col("_file").alias("_source_file"), F.col("_row").alias("_source_row"), ntz(as_of).alias("_loaded_at"),
            F.current_user().alias("_loaded_by"),
        ]
    rows = good.select(*picked, *extra)
    if target_columns:
        rows = rows.toDF(*target_columns, *[n for n in rows.columns[len(target_columns):]])
    return rows.dropDuplicates() if distinct else rows


# ---- validation without loading ----------------------------------------------------------


def validate(spark, stage: str, fmt: FileFormat, columns: Columns | T.StructType | str, mode: str, *, files=None, pattern=None, prefix=None) -> DataFrame:
    """VALIDATION_MODE: RETURN_ALL_ERRORS, RETURN_ERRORS (first of each file) or RETURN_<n>_ROWS."""
    cols = columns if isinstance(columns, Columns) else Columns(columns)
    chosen = select_files(list_stage(spark, stage), files=files, pattern=pattern, prefix=prefix)
    paths = [r["path"] for r in chosen.select("path").collect()]
    parsed = parse(spark, paths, stage, fmt, cols)
    some = re.fullmatch(r"RETURN_(\d+)_ROWS", mode.upper())
    if some:
        return parsed.where("_error is null").select(*[f.name for f in cols.schema]).limit(int(some[1]))
    with _duplicate_keys(spark, fmt):
        work = _drop_header_rows(staged(parsed, "validate"), fmt)
    errors = errors_of(work)
    if mode.upper() == "RETURN_ALL_ERRORS":
        return errors
    if mode.upper() == "RETURN_ERRORS":
        everything = F.struct(*[F.col(c) for c in errors.columns])
        return errors.groupBy("file").agg(F.min_by(everything, "line").alias("_e")).select("_e.*")
    raise ValueError(f"unknown VALIDATION_MODE {mode}")


def errors_of(work: DataFrame) -> DataFrame:
    bad = with_row_number(work, "_file", "_line", work.where("_error is not null"))
    at = F.instr(F.col("_record"), F.col("_error_value"))
    return bad.select(
        F.col("_error").alias("error"), F.col("_file").alias("file"), F.col("_line").alias("line"),
        F.when(at > 0, at).cast("bigint").alias("character"), F.col("_error_column").alias("column_name"),
        F.col("_record").alias("rejected_record"),
    )


def error_summary(errors: DataFrame) -> DataFrame:
    return errors.groupBy("error", "file", "line", "character", "column_name").agg(
        F.count(F.lit(1)).alias("occurrence_count")).orderBy(F.desc("occurrence_count"), "file", "line")


# ---- compositions ------------------------------------------------------------------------


def load_with_capture(spark, table: Table, stage: str, fmt, columns, as_of, table_name: str, **kw):
    """Load with CONTINUE and capture the rows in error: (report, rejects).

    Text is parsed once: rejects are read from where the load wrote its bad rows.
    """
    from .rejects import capture_rejects

    load_id = new_load_id()
    where = f"{table.path}/data/load_id={load_id}"
    if not fmt.text:
        rejects = capture_rejects(validate(spark, stage, fmt, columns, "RETURN_ALL_ERRORS"), table_name, as_of)
        return copy_into(spark, table, stage, fmt, columns, as_of, on_error="CONTINUE", table_name=table_name, **kw), rejects
    report = copy_into(spark, table, stage, fmt, columns, as_of, on_error="CONTINUE", table_name=table_name, load_id=load_id, **kw)
    if any(c.startswith("_class=") for c in fs.children(spark, where)):
        work = spark.read.schema(_PLACE_SCHEMA).parquet(where)
    elif report.isEmpty():
        work = spark.createDataFrame([], _PLACE_SCHEMA)
    else:
        return report, capture_rejects(validate(spark, stage, fmt, columns, "RETURN_ALL_ERRORS", files=[r["file"] for r in report.select("file").collect()]), table_name, as_of)
    return report, capture_rejects(errors_of(work), table_name, as_of)


def copy_chunks(spark, table, stage, fmt, columns, as_of, patterns: list[str], **kw) -> DataFrame:
    """One load per file pattern, each with its own load id; reports stacked."""
    out = None
    for p in patterns:
        report = copy_into(spark, table, stage, fmt, columns, as_of, pattern=p, **kw).withColumn("pattern", F.lit(p))
        out = report if out is None else out.unionByName(report)
    return out


def reload_staging(spark, table: Table, stage, fmt, columns, as_of, **kw) -> DataFrame:
    """Truncate the staging table and load all files again."""
    if table.current():
        table.truncate(as_of)
    return copy_into(spark, table, stage, fmt, columns, as_of, force=True, **kw)


def load_batch(spark, jobs: dict[str, dict], as_of, max_skip_pct: float = 5.0) -> DataFrame:
    """Several tables, each with its own stage, format and policy; then one count row per table."""
    from ..functions.numbers import pct

    out = None
    for name, job in jobs.items():
        report = copy_into(spark, as_of=as_of, table_name=name, **job)
        row = report.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("rows_parsed"), F.lit(0)).alias("rows_parsed"),
            F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_loaded"))
        out = row if out is None else out.unionByName(row)
    share = pct(F.col("rows_parsed") - F.col("rows_loaded"), "rows_parsed")
    return out.select("*", share.alias("skip_pct"), F.when(F.coalesce(share, F.lit(0.0)) > max_skip_pct, "FAIL").otherwise("PASS").alias("status"))
