"""Guarded ratios and rounding. Operands become DOUBLE first so that results have one type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .times import col


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is zero."""
    return col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))


def pct(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    return F.round(col(num).cast("double") * 100.0 / F.nullif(col(den).cast("double"), F.lit(0.0)), digits)


def total(c: str | Column) -> Column:
    return F.sum(col(c)).cast("bigint")


def rounded_sum(c: str | Column, digits: int = 6) -> Column:
    return F.round(F.sum(col(c).cast("double")), digits)


def rows(name: str = "rows") -> Column:
    return F.count(F.lit(1)).alias(name)


def exact_ratio(num: Column, den: int, digits: int) -> Column:
    """A whole number (0 or more) by a whole number, rounded half up without leaving whole numbers, so that no tie depends on binary fractions."""
    doubled = num.cast("decimal(30,0)") * F.lit(2 * 10**digits).cast("decimal(8,0)") + F.lit(den).cast("decimal(20,0)")
    return F.call_function("div", doubled, F.lit(2 * den).cast("decimal(20,0)")).cast("double") / F.lit(float(10**digits))
