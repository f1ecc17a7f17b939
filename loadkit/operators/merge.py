"""Deduplication, MERGE, updates and deletes as DataFrames, and their commits to a Table.

A merge returns target and source rows combined by key with an `_action` column
(unchanged, updated, inserted, deleted). It is a left join for the rows of the target and an
anti join for new rows, without hints: Spark picks how each runs from the sizes it sees. Keys
are unique on both sides after deduplication, so no key can be hot, and NULL keys, which never
match, bypass the join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import rows
from ..functions.times import as_datetime, ntz, older
from ..functions.windows import latest_by
from .versioned import Table, new_load_id

_KEEP, _UPDATE, _INSERT, _DELETE = "unchanged", "updated", "inserted", "deleted"


def latest(df: DataFrame, keys: list[str], order_by: str, newest: bool = True) -> DataFrame:
    """Newest (or oldest) row per key; equal times are settled by the row's hash."""
    return latest_by(df, keys, [F.col(order_by)], newest=newest)


@dataclass(frozen=True)
class Rules:
    """WHEN clauses. Conditions see target columns as `t.x` and source columns as `s.x`.

    update: target column -> source expression (None: every shared column). A condition of
    None means always; `insert_when=False` and the like switch a clause off.
    """

    update_when: Column | bool | None = None
    update: dict[str, Column] | None = None
    delete_when: Column | bool = False
    insert_when: Column | bool | None = None
    insert: dict[str, Column] | None = None


def _cond(c) -> Column:
    if c is None:
        return F.lit(True)
    return F.lit(c) if isinstance(c, bool) else F.coalesce(c, F.lit(False))


def merge(target: DataFrame, source: DataFrame, on: list[str] | str, rules: Rules = Rules()) -> DataFrame:
    """All rows after the merge plus those deleted, told apart by `_action`."""
    on = [on] if isinstance(on, str) else list(on)
    names = target.columns
    shared = [c for c in names if c in source.columns]
    update = rules.update or {c: F.col(f"s.{c}") for c in shared if c not in on}
    insert = rules.insert or {c: F.col(f"s.{c}") for c in shared}
    any_null = " or ".join(f"`{k}` is null" for k in on)
    t, t_null = target.where(f"not ({any_null})"), target.where(any_null)
    s, s_null = source.where(f"not ({any_null})").withColumn("_s", F.lit(True)), source.where(any_null)

    matched = F.col("s._s").isNotNull()
    deletes = matched & _cond(rules.delete_when)
    updates = matched & ~deletes & _cond(rules.update_when)
    types = {f.name: f.dataType for f in target.schema}

    def inserted(frame: DataFrame) -> DataFrame:
        values = [insert[c].cast(types[c]).alias(c) if c in insert else F.lit(None).cast(types[c]).alias(c) for c in names]
        return frame.alias("s").where(_cond(rules.insert_when)).select(*values, F.lit(_INSERT).alias("_action"))

    condition = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in on]
    action = F.when(deletes, _DELETE).when(updates, _UPDATE).otherwise(_KEEP)
    values = [F.when(updates, update[c].cast(types[c])).otherwise(F.col(f"t.{c}")).alias(c) if c in update else F.col(f"t.{c}").alias(c) for c in names]
    kept = t.alias("t").join(s.alias("s"), condition, "left").select(*values, action.alias("_action"))
    out = kept.unionByName(inserted(s.join(t.select(*on), on, "left_anti")))
    return out.unionByName(t_null.withColumn("_action", F.lit(_KEEP))).unionByName(inserted(s_null))


def result(merged: DataFrame) -> DataFrame:
    """Rows of the table after the merge."""
    return merged.where(F.col("_action") != _DELETE).drop("_action")


def stats(merged: DataFrame) -> DataFrame:
    """Rows by action."""
    return merged.where(F.col("_action") != _KEEP).groupBy("_action").agg(rows("row_count"))


# ---- named merges ------------------------------------------------------------------------


def upsert(target, source, key, order_by) -> DataFrame:
    """Newest wins, against the target and among repeated source keys."""
    return merge(target, latest(source, [key], order_by), key, Rules(update_when=F.col(f"s.{order_by}") > F.col(f"t.{order_by}")))


def insert_only(target, source, keys: list[str], order_by: str | None = None) -> DataFrame:
    """Add rows whose key is not there yet; repeating it adds nothing."""
    src = latest(source, keys, order_by) if order_by else source.dropDuplicates(keys)
    return target.unionByName(src.join(target.select(*keys), keys, "left_anti").select(*target.columns))


def merge_changes(target, feed, key, operation="operation", changed_at="change_timestamp", updated_at="updated_at") -> DataFrame:
    """Row-operation feed (I / U / D): the last operation per key acts, if it is newer."""
    last = latest(feed, [key], changed_at)
    shared = [c for c in target.columns if c in feed.columns and c not in (key, updated_at)]
    values = {c: F.col(f"s.{c}") for c in shared} | {updated_at: F.col(f"s.{changed_at}")}
    op = F.col(f"s.{operation}")
    return merge(target, last, key, Rules(
        delete_when=op == "D", update_when=op.isin("I", "U") & (F.col(f"s.{changed_at}") > F.col(f"t.{updated_at}")),
        update=values, insert_when=op != "D", insert=values | {key: F.col(f"s.{key}")}))


CDC_SCHEMA = "struct<payload:struct<op:string,before:map<string,string>,after:map<string,string>,source:struct<ts_ms:bigint>>>"


def cdc_changes(raw: DataFrame, content: str, key: str, columns: list[str]) -> DataFrame:
    """Flat changes from envelope documents.

    The key comes from `after`, or from `before` for deletes, which have no after; ts_ms is
    milliseconds since the epoch.
    """
    doc = F.from_json(F.col(content), CDC_SCHEMA)
    p = raw.select(doc["payload"].alias("p")).select("p.*")

    def state(c):
        return F.coalesce(F.col("after")[c], F.col("before")[c])

    at = F.timestamp_millis(F.col("source")["ts_ms"]).cast("timestamp_ntz")
    return p.select(
        state(key).alias(key), F.col("op").alias("operation"),
        *[F.col("after")[c].alias(c) for c in columns], at.alias("updated_at"),
    )


def cdc_state(changes: DataFrame, key: str) -> DataFrame:
    """Current rows: the last change per key, unless it is a delete."""
    return latest(changes, [key], "updated_at").where("operation <> 'd'").drop("operation")


GONE = "_deleted"


def merge_cdc(target, changes, key) -> DataFrame:
    """Apply flat CDC changes: last per key, newer than the target, deletes included.

    If the target has a boolean column `_deleted`, a deleted key stays as a row that says when
    it went (a tombstone). Then the newest change wins in whatever order batches arrive: an
    older change of a deleted key, coming later, finds the tombstone. `cdc_live` leaves them out.
    """
    last = latest(changes, [key], "updated_at")
    newer = F.col("s.updated_at") >= F.col("t.updated_at")
    op = F.col("s.operation")
    if GONE in target.columns:
        gone = last.withColumn(GONE, F.col("operation") == "d")
        return merge(target, gone, key, Rules(update_when=newer))
    return merge(target, last, key, Rules(delete_when=(op == "d") & newer, update_when=(op != "d") & newer, insert_when=op != "d"))


def cdc_live(table: DataFrame) -> DataFrame:
    """Rows of a table with tombstones that are not deleted."""
    return table.where(~F.coalesce(F.col(GONE), F.lit(False))).drop(GONE)


# ---- plain row changes ---------------------------------------------------------------------


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true (NULL keeps the row)."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def delete_duplicates_keep_min(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows at their key's earliest time. Ties at that time all stay."""
    first = df.groupBy(key).agg(F.min(ts).alias(ts))
    return df.join(first, [key, ts], "left_semi")


def update_where(df: DataFrame, values: dict[str, Column], condition: Column) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def split_soft_deletes(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """(active, deleted); an unknown flag counts as active."""
    gone = F.coalesce(F.col(flag), F.lit(False))
    return df.where(~gone), df.where(gone)


def archive_split(df: DataFrame, condition: Column, ts: str, as_of, days: int) -> tuple[DataFrame, DataFrame]:
    """(remaining, archived): archived are older than `days` and satisfy the condition."""
    old = F.coalesce(condition & older(ts, as_of, days=days), F.lit(False))
    return df.where(~old), df.where(old)


def clone_schema(df: DataFrame) -> DataFrame:
    return df.where(F.lit(False))


# ---- commits to a Table --------------------------------------------------------------------


def apply(table: Table, build, as_of, operation="merge", source: DataFrame | None = None) -> DataFrame:
    """Run build(current rows) -> merged rows and publish them as the next version; rows by action.

    A table in folders (see folders) whose key `source` has is changed in the folders that
    the source's keys lie in, and build sees the rows of those. Any other table is written anew.

    The surviving rows are written once, with their action as an extra column that readers
    of the table never select. Counts by action come from that one column; deleted rows are
    those missing from the arithmetic. The version fails to publish if another writer was
    first, so no change is lost.
    """
    from . import folders

    base = table.current()
    if folders.is_foldered(base) and source is not None and base["layout_key"] in source.columns:
        return folders.change(table, build, as_of, operation, source, base=base).counts(table.spark)
    merged = build(table.read(base["snapshot_id"]))
    load_id = new_load_id()
    survivors = merged.where(F.col("_action") != _DELETE)
    table.write_data(survivors, load_id, tuple(base["partition_by"]))
    written = table.spark.read.schema("_action string").option("recursiveFileLookup", "true").parquet(f"{table.path}/data/load_id={load_id}")
    n = {r["_action"]: r["n"] for r in written.groupBy("_action").agg(F.count(F.lit(1)).alias("n")).collect()}
    n[_DELETE] = base["rows"] + n.get(_INSERT, 0) - sum(n.values())
    schema = survivors.drop("_action").schema
    table.commit([load_id], schema, as_of, operation, load_id, base)
    return table.spark.createDataFrame([(a, n[a]) for a in (_INSERT, _UPDATE, _DELETE) if n.get(a)], "_action string, row_count bigint")


def replace_rows(table: Table, build, as_of, operation: str, condition: Column | None = None) -> int:
    """Publish build(current rows) as the next version (DELETE, UPDATE).

    `condition` holds for all rows that build changes or drops: of a table in folders only
    those with such rows are written.
    """
    from . import folders

    base = table.current()
    if folders.is_foldered(base) and condition is not None:
        folders.change(table, build, as_of, operation, condition=condition, base=base)
        return table.current()["snapshot_id"]
    return table.overwrite(build(table.read(base["snapshot_id"])), as_of, operation, base)


def archive(table: Table, archived_to: Table, condition: Column, ts: str, as_of, days=30) -> None:
    """Append old rows to the archive, then drop them; a crash in between leaves them in both, never in none."""
    from . import folders

    base = table.current()
    remaining, old = archive_split(table.read(base["snapshot_id"]), condition, ts, as_of, days)
    archived_to.append(old, as_of, "archive")
    if folders.is_foldered(base):
        gone = condition & older(ts, as_of, days=days)
        folders.change(table, lambda now: archive_split(now, condition, ts, as_of, days)[0], as_of, "archive", condition=gone, base=base)
    else:
        table.overwrite(remaining, as_of, "archive", base)


def load_audit(counts: DataFrame, job: str, table_name: str, as_of) -> DataFrame:
    """One audit row from merge counts."""
    def of(action):
        return F.coalesce(F.sum(F.when(F.col("_action") == action, F.col("row_count"))), F.lit(0))

    return counts.agg(
        F.lit(job).alias("job_id"), F.lit(as_datetime(as_of).date()).alias("execution_date"), F.lit(table_name).alias("table_name"),
        of(_INSERT).alias("rows_inserted"), of(_UPDATE).alias("rows_updated"), of(_DELETE).alias("rows_deleted"), ntz(as_of).alias("completed_at"),
    )


def load_incremental(spark, table: Table, staging: Table, stage, fmt, columns, key, order_by, as_of, **kw) -> DataFrame:
    """Reload staging from the stage, dedupe, merge newest-wins; audit row with the staged count."""
    from .copy import reload_staging

    reload_staging(spark, staging, stage, fmt, columns, as_of, **kw)
    source = staging.read()
    if table.current() is None:
        table.append(clone_schema(source), as_of, "create")
    counts = apply(table, lambda t: upsert(t, source, key, order_by), as_of, source=source)
    n = source.agg(rows("rows_staged"))
    audit = load_audit(counts, "load_incremental", table.path.rsplit("/", 1)[-1], as_of)
    return audit.withColumn("rows_staged", n.scalar())
