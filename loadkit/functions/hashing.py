"""Row hashes and checksums that merge: no group is ever brought together to be hashed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .times import col


def row_hash(columns) -> Column:
    """MD5 of the columns joined by `|`. NULL counts as empty text, so positions never shift."""
    parts = [F.coalesce(col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def _word(md5: Column, start: int) -> Column:
    # 15 hex digits = 60 bits, safe in BIGINT
    return F.conv(F.substring(md5, start, 15), 16, 10).cast("bigint")


def _wide_sum(word: Column) -> Column:
    """Sum of 60-bit words without overflow: three 20-bit limbs summed as BIGINT (good for
    8e12 rows) and put together as DECIMAL once per group, not once per row.
    """
    mask, limb = (1 << 20) - 1, "decimal(38,0)"
    high = F.sum(F.shiftright(word, 40)).cast(limb) * F.lit(1 << 40).cast("decimal(13,0)")
    middle = F.sum(F.shiftright(word, 20).bitwiseAND(F.lit(mask))).cast(limb) * F.lit(1 << 20).cast("decimal(7,0)")
    low = F.sum(word.bitwiseAND(F.lit(mask))).cast(limb)
    return F.coalesce((high + middle + low).cast(limb), F.lit(0).cast(limb))


def checksum(md5: Column) -> Column:
    """Aggregate: order-free checksum over row hashes.

    Count and two 60-bit sums, hashed once more. Duplicated, lost or edited rows change it,
    and partial sums combine on the map side.
    """
    return F.md5(F.concat_ws(
        ":", F.count(md5).cast("string"), _wide_sum(_word(md5, 1)).cast("string"), _wide_sum(_word(md5, 17)).cast("string")))


def hash_sum(*columns) -> Column:
    """Aggregate: SUM of the native 64-bit hash; fastest, engine-specific."""
    return F.sum(F.xxhash64(*[col(c) for c in columns]).cast("decimal(28,0)"))


def word_sum(column) -> Column:
    """Aggregate: sum of the first 60 bits of each value's MD5, the same in any engine."""
    return _wide_sum(_word(F.md5(col(column).cast("string")), 1))
