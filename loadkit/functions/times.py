"""Time helpers: literals relative to an explicit `as_of`, boundary-counting differences."""

from __future__ import annotations

import calendar
from datetime import datetime, timedelta

from pyspark.sql import Column, functions as F

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_datetime(value: str | datetime) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(value)


def ntz(value: str | datetime) -> Column:
    """A TIMESTAMP_NTZ literal; being a constant it reaches the scan as a pushed filter."""
    return F.expr(f"timestamp_ntz '{as_datetime(value).isoformat(sep=' ')}'")


def back(as_of: str | datetime, *, minutes=0, hours=0, days=0, weeks=0, months=0) -> datetime:
    """`as_of` minus an interval, computed before planning."""
    at = as_datetime(as_of)
    if months:
        index = at.year * 12 + at.month - 1 - months
        year, month = divmod(index, 12)
        day = min(at.day, calendar.monthrange(year, month + 1)[1])
        at = at.replace(year=year, month=month + 1, day=day)
    return at - timedelta(minutes=minutes, hours=hours, days=days, weeks=weeks)


def within(c: str | Column, as_of: str | datetime, **interval) -> Column:
    """`c` lies after `as_of` minus the interval."""
    return col(c) > ntz(back(as_of, **interval))


def older(c: str | Column, as_of: str | datetime, **interval) -> Column:
    return col(c) < ntz(back(as_of, **interval))


def trunc(unit: str, c: str | Column) -> Column:
    """date_trunc that keeps TIMESTAMP_NTZ; weeks start on Monday."""
    return F.date_trunc(unit, col(c)).cast("timestamp_ntz")


def diff(unit: str, start: str | Column, end: str | Column) -> Column:
    """Number of unit boundaries crossed from `start` to `end`."""
    size = _SECONDS[unit]

    def ticks(c):
        return F.floor(F.unix_seconds(col(c).cast("timestamp")) / F.lit(size))

    return (ticks(end) - ticks(start)).cast("bigint")


# Date-format tokens of the SQL dialect and their Spark equivalents.
FORMAT_TOKENS = (
    ("YYYY", "yyyy"),
    ("YY", "yy"),
    ("MMMM", "MMMM"),
    ("MON", "MMM"),
    ("MM", "MM"),
    ("DD", "dd"),
    ("HH24", "HH"),
    ("HH12", "hh"),
    ("MI", "mm"),
    ("SS", "ss"),
    ("FF3", "SSS"),
    ("FF6", "SSSSSS"),
    ("AM", "a"),
    ("PM", "a"),
    ("DY", "EEE"),
)


def spark_format(fmt: str) -> str:
    """Translate a SQL date format (`YYYY-MM-DD HH24:MI:SS`) to a Spark pattern."""
    out, rest = "", fmt
    while rest:
        for token, pattern in FORMAT_TOKENS:
            if rest.upper().startswith(token):
                out, rest = out + pattern, rest[len(token):]
                break
        else:
            char, rest = rest[0], rest[1:]
            out += f"'{char}'" if char.isalpha() else char
    return out


def parse_timestamp(c: str | Column, *formats: str) -> Column:
    """First format that parses wins; NULL when none does. Month names match in any case."""
    value = col(c)
    tries = []
    for fmt in formats:
        pattern = spark_format(fmt)
        text = value
        if "MMM" in pattern:
            month = F.initcap(F.regexp_extract(value, "([A-Za-z]+)", 1))
            text = F.replace(F.regexp_replace(value, "[A-Za-z]+", "#"), F.lit("#"), month)
        tries.append(F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz"))
    return F.coalesce(*tries)
