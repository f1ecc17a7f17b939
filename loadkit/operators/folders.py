"""Tables in folders by ranges of a key: a merge, delete or update writes only the folders it changes.

Each folder of a version holds the rows whose key lies between its lower bound and the next
folder's. Bounds are kept with the version, so the folders a change can touch follow from the
change's keys (or, for a condition, from one filtered scan). Touched folders are written anew,
the others belong to the next version as they are. The key of the folders must be one of the
columns that rows are matched on, and a row's key doesn't change.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import merge as M
from .versioned import ConcurrentCommit, Table, merge_schemas, new_load_id

#: Rows of a folder, about; one that outgrows twice that is parted when it is written next.
FOLDER_ROWS = 1_000_000
#: Bounds on each level of the tree in which a key's range is looked up.
_FAN = 16
#: Keys looked at for each bound that is chosen.
_SAMPLE = 200


@dataclass(frozen=True)
class Written:
    """What a change did: rows by action, and folders written anew, kept, and the touched ones of before."""

    actions: dict[str, int]
    written: int
    kept: int
    touched: int

    def counts(self, spark) -> DataFrame:
        order = [a for a in (M._INSERT, M._UPDATE, M._DELETE) if self.actions.get(a)]
        return spark.createDataFrame([(a, self.actions[a]) for a in order], "_action string, row_count bigint")


def range_of(key: Column, bounds: list[str], kind: T.DataType) -> Column:
    """How many of the sorted lower bounds are not above the key; 0 for NULL. Looks at about _FAN bounds on each level of a tree."""
    if not bounds:
        return F.lit(0)
    steps = [1]
    while len(bounds) > steps[-1] * _FAN:
        steps.append(steps[-1] * _FAN)

    def below(level: Column) -> Callable[[Column], Column]:
        # the bounds of this level from the last one that is not above the key on the level over it
        some = lambda before: F.slice(level, F.greatest(before - 1, F.lit(0)) * _FAN + 1, _FAN)
        return lambda before: F.when(before == 0, 0).otherwise((before - 1) * _FAN + F.size(F.filter(some(before), lambda x: x <= key)))

    found = F.size(F.filter(_array(bounds[:: steps[-1]], kind), lambda x: x <= key))
    for step in reversed(steps[:-1]):
        # a list of one, so that the number found is worked out once
        found = F.transform(F.array(found), below(_array(bounds[::step], kind)))[0]
    return F.when(key.isNull(), 0).otherwise(found)


def _array(values: list[str], kind: T.DataType) -> Column:
    """A constant array from one text: an expression of a few nodes, whatever the number of values."""
    mark = next(c for c in map(chr, range(1, 0xD800)) if not any(c in v for v in values))
    return F.split(F.lit(mark.join(values)), f"\\Q{mark}\\E").cast(T.ArrayType(kind))


def _chosen(rows: DataFrame, key: str, n: int, folders: int) -> list[str]:
    """Lower bounds of all ranges but the first, from a sample of bounded size: they are layout, no result depends on them."""
    if folders < 2:
        return []
    most = folders * _SAMPLE
    some = rows.where(F.col(key).isNotNull()).select(key).sample(min(1.0, most / n), 7).limit(2 * most)
    keys = [r[0] for r in some.sort(key).select(F.col(key).cast("string")).collect()]
    return list(dict.fromkeys(keys[len(keys) * k // folders] for k in range(1, folders))) if keys else []


def _sorted(bounds, kind: T.DataType) -> list[str]:
    """Bounds, as text, in the order of the keys; equal ones once."""
    if isinstance(kind, T.NumericType):
        return sorted(set(bounds), key=decimal.Decimal)
    return sorted(set(bounds), key=str.encode)


def _write(table: Table, rows: DataFrame, key: str, bounds: list[str], load_id: str) -> list[tuple[int, dict]]:
    """Write rows (with `_action`) to a folder per range. Returns the ranges written, with rows by action.

    Adaptive execution gives a folder as many tasks as its rows need (rebalance), so one much
    larger than the others is written by several.
    """
    from ..sources import fs

    placed = rows.withColumn("_part", range_of(F.col(key), bounds, rows.schema[key].dataType))
    table.write_data(placed.hint("rebalance", "_part"), load_id, ("_part",))
    path = f"{table.path}/data/load_id={load_id}"
    if not any(c.startswith("_part=") for c in fs.children(table.spark, path)):
        return []
    found: dict[int, dict] = {}
    written = table.spark.read.schema("_action string, _part int").parquet(path)
    for r in written.groupBy("_part", "_action").agg(F.count(F.lit(1)).alias("n")).collect():
        found.setdefault(r["_part"], {})[r["_action"]] = r["n"]
    return sorted(found.items())


def _layout(key: str, lows: list, rows: list, folder_rows: int) -> dict:
    return {"layout_key": key, "lows": lows, "part_rows": rows, "folder_rows": folder_rows}


def create(table: Table, rows: DataFrame, key: str, as_of, bounds: list | None = None, folder_rows: int = FOLDER_ROWS) -> int:
    """Publish `rows` as the table's next version, in folders by `key` of about `folder_rows` rows, or with the lower bounds given."""
    base, load_id, kind = table.current(), new_load_id(), rows.schema[key].dataType
    if bounds is None:
        n = rows.count()
        bounds = _chosen(rows, key, n, -(-n // folder_rows))
    bounds = _sorted([str(b) for b in bounds], kind)
    found = _write(table, rows.withColumn("_action", F.lit(M._INSERT)), key, bounds, load_id)
    lows = [None, *bounds]
    layout = _layout(key, [lows[p] for p, _ in found], [sum(n.values()) for _, n in found], folder_rows)
    return table.commit([f"{load_id}/_part={p}" for p, _ in found], rows.schema, as_of, "create folders", load_id, base, layout=layout)


class _Now:
    """The folders of a version. Several may hold one range (one of them from an append)."""

    def __init__(self, table: Table, base: dict):
        self.table, self.base, self.key, self.schema = table, base, base["layout_key"], table.schema_of(base)
        self.kind = self.schema[self.key].dataType
        self.ids, self.lows, self.rows = base["load_ids"], base["lows"], base["part_rows"]
        self.bounds = _sorted([low for low in self.lows if low is not None], self.kind)
        number = {low: p for p, low in enumerate([None, *self.bounds], 0)}
        self.parts = [number[low] for low in self.lows]

    def part(self, key: Column) -> Column:
        return range_of(key.cast(self.kind), self.bounds, self.kind)

    def read(self, at: list[int]) -> DataFrame:
        return self.table._read_loads([self.ids[i] for i in at], self.schema) if at else self.table.spark.createDataFrame([], self.schema)

    def outgrown(self, touched: set[int]) -> list[str]:
        """More bounds, for touched ranges with more than twice the rows of a folder."""
        limit, more = self.base["folder_rows"], []
        for p in sorted(touched):
            at = [i for i, q in enumerate(self.parts) if q == p]
            held = sum(self.rows[i] for i in at)
            if held > 2 * limit:
                more += _chosen(self.read(at), self.key, held, -(-held // limit))
        return more


def change(
    table: Table, build: Callable[[DataFrame], DataFrame], as_of, operation: str, source: DataFrame | None = None,
    condition: Column | None = None, base: dict | None = None,
) -> Written:
    """Publish the next version with build(rows of the touched folders) in their place.

    `source` has the keys that a merge brings: folders in whose range none of them lies are
    kept. With a `condition` instead, folders without a row for which it is true are kept. build
    may return an `_action` column (see merge), by which rows are counted; without one, rows
    left and rows lost are. The version fails to publish if another writer was first.
    """
    base = base if base is not None else table.current()
    now = _Now(table, base)
    every = list(range(len(now.ids)))
    keys = source.select(F.col(now.key)) if source is not None else now.read(every).where(condition).select(now.key)
    # numbers of folders, a list that the version itself holds
    touched = {r["p"] for r in keys.select(now.part(F.col(now.key)).alias("p")).distinct().collect()}
    if not touched:
        return Written({}, 0, len(every), 0)
    hit = [i for i in every if now.parts[i] in touched]
    kept = [i for i in every if now.parts[i] not in touched]
    merged = build(now.read(hit))
    survivors = merged.where(F.col("_action") != M._DELETE) if "_action" in merged.columns else merged.withColumn("_action", F.lit(M._KEEP))
    bounds, load_id = _sorted([*now.bounds, *now.outgrown(touched)], now.kind), new_load_id()
    found = _write(table, survivors, now.key, bounds, load_id)
    actions = {a: sum(n.get(a, 0) for _, n in found) for a in (M._KEEP, M._UPDATE, M._INSERT)}
    actions[M._DELETE] = sum(now.rows[i] for i in hit) + actions[M._INSERT] - sum(actions.values())
    starts = [None, *bounds]
    lows = [now.lows[i] for i in kept] + [starts[p] for p, _ in found]
    counts = [now.rows[i] for i in kept] + [sum(n.values()) for _, n in found]
    ids = [now.ids[i] for i in kept] + [f"{load_id}/_part={p}" for p, _ in found]
    table.commit(ids, survivors.drop("_action").schema, as_of, operation, load_id, base, layout=_layout(now.key, lows, counts, base["folder_rows"]))
    return Written(actions, len(found), len(kept), len(hit))


def append(table: Table, rows: DataFrame, as_of, operation: str, load_id: str, attempts: int = 10, stream=None) -> int:
    """Add rows as folders of their own beside those of the same ranges; the next change of a range joins them."""
    base = table.current()
    now = _Now(table, base)
    found = _write(table, rows.withColumn("_action", F.lit(M._INSERT)), now.key, now.bounds, load_id)
    starts = [None, *now.bounds]
    for _ in range(attempts):
        base = table.current()
        if not is_foldered(base):
            break
        lows = [starts[p] for p, _ in found]
        layout = _layout(now.key, base["lows"] + lows, base["part_rows"] + [sum(n.values()) for _, n in found], base["folder_rows"])
        try:
            return table.commit(base["load_ids"] + [f"{load_id}/_part={p}" for p, _ in found], merge_schemas(table.schema_of(base), rows.schema), as_of, operation, load_id, base, layout=layout, stream=stream)
        except ConcurrentCommit:
            continue
    raise ConcurrentCommit(f"gave up committing to {table.path}")


def is_foldered(base: dict | None) -> bool:
    return bool(base and base.get("layout_key"))
