"""Periodic runs of words in documents: Lyndon arrays from a suffix sorter's first phase, roots extended into runs.

A run is a stretch of words with a smallest period, as long as it can be. Each run holds copies
of a Lyndon word, its root, under one of two orders of the words: the usual one or its reverse.
From where such a copy begins, the root is the longest Lyndon word of the text. So the lengths of
those longest words under both orders, the Lyndon arrays, name every root.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, by_batch, raw_texts

#: Least words of a run, and least number of its periods.
LEAST, EXPONENT = 6, 4
#: Words of the documents that are sorted together, about.
TOGETHER = 1 << 15
_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def lyndon(symbols: np.ndarray, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Length of the longest Lyndon word from each place, and a number of that word (-1: no place).

    `symbols`: texts as numbers from 0, each followed by a -1. This is the grouping phase of
    Baier's suffix sorting. Places whose suffixes begin with the same context are a group, and
    groups stand in the order of their contexts. Groups are taken from the greatest down. What
    is taken has its final context, a Lyndon word; the part right before it in the text, if it
    belongs to a lesser group, takes it (and equal ones that follow it) into its own context, and
    so moves to a new group right above its old one: the higher, the more copies it takes. No
    order within groups is worked out, as the second phase would. Each place is taken once.
    """
    n = len(symbols)
    distinct = int(symbols.max(initial=-1)) + 1
    order = np.argsort(symbols, kind="stable")
    ends = np.searchsorted(symbols[order], np.arange(distinct + 1)).tolist()
    places = order.tolist()
    members = [places[a:b] for a, b in zip(ends, ends[1:], strict=False)]
    # the place of a group that has just one (such a group is never left: it grows as a whole), else -1
    one = [m[0] if len(m) == 1 else -1 for m in members]
    above, below = [*range(1, distinct), -1], list(range(-1, distinct - 1))
    if reverse:
        above, below = below, above
    held, size, group = list(map(len, members)), [1] * distinct, symbols.tolist()
    # where the part begins that ends right before a place; -1: a text begins, or that part is taken
    before = [-1, *range(n)]
    for k in np.nonzero(symbols < 0)[0].tolist():
        before[k + 1] = -1
    now = (0 if reverse else distinct - 1) if distinct else -1
    while now >= 0:
        i, width = one[now], size[now]
        if i >= 0:
            j = before[i + width] = before[i]
            if j < 0:
                now = below[now]
                continue
            old = group[j]
            if one[old] >= 0:
                size[old] += width
                now = below[now]
                continue
            moves = ((1, old, (j,)),)
        else:
            grown: dict[int, list[int]] = {}
            last, more = -1, {}
            for i in members[now]:
                if group[i] == now:
                    j = before[i + width] = before[i]
                    if j >= 0:
                        if j == last:
                            more[j] = more.get(j, 1) + 1
                        else:
                            last = j
                            old = group[j]
                            if old in grown:
                                grown[old].append(j)
                            else:
                                grown[old] = [j]
            moves = _by_copies(grown, more) if more else [(1, old, js) for old, js in grown.items()]
        for copies, old, moved in moves:
            count = len(moved)
            if held[old] == count:
                size[old] += copies * width
                continue
            held[old] -= count
            new = len(size)
            for j in moved:
                group[j] = new
            size.append(size[old] + copies * width)
            held.append(count)
            members.append(moved)
            one.append(moved[0] if count == 1 else -1)
            top = above[old]
            above.append(top)
            below.append(old)
            above[old] = new
            if top >= 0:
                below[top] = new
        now = below[now]
    number = np.array(group, np.int64)
    return np.where(number >= 0, np.array([*size, 0])[number], 0), number


def _by_copies(grown: dict, more: dict) -> list:
    """What moves, (copies taken, old group, places): of each old group those with most copies first."""
    out = []
    for old, places in grown.items():
        parts: dict[int, list[int]] = {}
        for j in places:
            parts.setdefault(more.get(j, 1), []).append(j)
        out += [(c, old, parts[c]) for c in sorted(parts, reverse=True)]
    return out


def same_ahead(symbols: np.ndarray, i: int, j: int, step: int = 1) -> int:
    """How many symbols from place i on equal those from place j > i on (step -1: backwards), within one text."""
    count, block = 0, 16
    while True:
        a, b = (symbols[i + count : i + count + block], symbols[j + count : j + count + block]) if step > 0 else (
            symbols[max(0, i - count - block + 1) : max(0, i - count + 1)][::-1], symbols[max(0, j - count - block + 1) : max(0, j - count + 1)][::-1])
        m = min(len(a), len(b))
        apart = np.nonzero((a[:m] != b[:m]) | (a[:m] < 0))[0]
        if len(apart) or m < block:
            return count + (int(apart[0]) if len(apart) else m)
        count, block = count + block, 2 * block


def runs(symbols: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """All runs (start, length, period) of texts given as in `lyndon`, by start and then period.

    A run of e whole periods holds at least e - 1 neighbouring copies of its root, whole part of
    e, and the first of them is where the extension starts: backwards less than a period, forwards
    as far as words one period apart are the same. Both orders may find a run; it counts once.
    """
    found, n = [], len(symbols)
    for reverse in (False, True):
        length, number = lyndon(symbols, reverse)
        place = np.nonzero((number >= 0) & (np.arange(n) + length < n))[0]
        p, g = length[place], number[place]
        first = np.where(place >= p, number[np.maximum(place - p, 0)], -1) != g
        for k in range(1, exponent - 1):
            ahead = place + k * p
            first &= np.where(ahead < n, number[np.minimum(ahead, n - 1)], -1) == g
        for i, q in zip(place[first].tolist(), p[first].tolist(), strict=True):
            start = i - same_ahead(symbols, i - 1, i + q - 1, -1)
            size = i + q + same_ahead(symbols, i, i + q) - start
            if size >= max(least, exponent * q):
                found.append((start, size, q))
    return np.array(sorted(set(found)), np.int64).reshape(-1, 3)[:, :3]


def extra(n: int, found: np.ndarray) -> np.ndarray:
    """Which of n words lie in a run (start, length, period) behind its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, found[:, 0] + found[:, 2], 1)
    np.add.at(steps, found[:, 0] + found[:, 1], -1)
    return np.cumsum(steps[:-1]) > 0


def find(docs: DataFrame, keys: list, text: Column | str = "text", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """`keys` (columns of docs), n_words, runs (start, length and period in words, by start, then
    period) and collapsed: the text's words without those that repeat a run's first period, parted
    by one blank each. One row per row of `docs`.

    Words are parted by ASCII white space; a run has at least `least` words and `exponent` (2 or
    more) whole periods. Null and empty texts have no words and no run, equal rows are returned
    each, null keys as they are; an empty table gives an empty result. Only the keys and the text
    are read, so other columns may have any name. Texts are taken whole, whatever their length: a
    text's memory and time grow in proportion to it.
    """
    kept = docs.select(*keys, (F.col(text) if isinstance(text, str) else text).alias("_text"))
    names = kept.columns[:-1]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1])

    def fn(batch):
        counts, bounds, rows, collapsed = [], [0], [], []
        for part in _batches([raw.split() for raw in raw_texts(batch.column("_text"))]):
            known: dict[bytes, int] = {}
            symbols = np.fromiter(chain.from_iterable([*[known.setdefault(w, len(known)) for w in words], -1] for words in part), np.int64)
            all_runs, at = runs(symbols, least, exponent), 0
            starts = all_runs[:, 0]
            for words in part:
                low, high = np.searchsorted(starts, [at, at + len(words)])
                mine = all_runs[low:high] - [at, 0, 0]
                if len(mine):
                    rows.append(mine)
                    gone = extra(len(words), mine)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                    counts.append(len(gone))
                else:
                    counts.append(len(words))
                bounds.append(bounds[-1] + len(mine))
                collapsed.append(b" ".join(words))
                at += counts[-1] + 1
        told = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
        items = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(told[:, k])) for k in range(3)], ["start", "length", "period"])
        return {n: batch.column(n) for n in names} | {
            "n_words": pa.array(counts, pa.int64()), "runs": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), items), "collapsed": pa.array(collapsed, pa.binary()).cast(pa.string()),
        }

    return by_batch(kept, kept.columns, f"{schema}, n_words bigint, runs {_RUNS}, collapsed string", fn)


def _batches(texts: list) -> list[list]:
    """Short texts together, so that they share the cost of a call."""
    out, held = [], 0
    for words in texts:
        if not out or held + len(words) > TOGETHER:
            out.append([])
            held = 0
        out[-1].append(words)
        held += len(words)
    return out


def planted(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> Column:
    """The text, but in one of ten documents, by the id's CRC, the words from some word on repeat a few of them over and over."""
    h = F.crc32(F.col(id_col).cast("string"))
    g, words = F.floor(h / 10).cast("long"), F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))

    def tail(ws):
        n = F.size(ws).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        return F.array_join(F.transform(ws, lambda w, i: F.when(i < a, w).otherwise(F.get(ws, (a + (i - a) % p).cast("int")))), " ")

    chosen = F.coalesce(h % 10 == 0, F.lit(False)) & F.col(text).rlike(WORD)
    return F.when(chosen, F.element_at(F.transform(F.array(words), tail), 1)).otherwise(F.col(text))
