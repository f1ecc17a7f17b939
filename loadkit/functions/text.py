"""Text predicates and path helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .times import col

# Accepted formats.
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE_DIGITS = r"^[0-9]{10,11}$"
UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def is_email(c) -> Column:
    return col(c).rlike(EMAIL)


def is_phone(c) -> Column:
    return F.regexp_replace(col(c), "[^0-9]", "").rlike(PHONE_DIGITS)


def is_uuid(c) -> Column:
    return col(c).rlike(UUID)


def base_name(c) -> Column:
    return F.regexp_extract(col(c), "[^/]+$", 0)


def path_part(c, index: int) -> Column:
    """Part `index` of a path, 1-based, negative from the end; a `key=` head is stripped."""
    return F.regexp_replace(F.split_part(col(c), F.lit("/"), F.lit(index)), "^[^=/]+=", "")


def error_type(c) -> Column:
    """Message text before the first colon."""
    return F.regexp_extract(col(c), "^[^:]+", 0)


def copy_target(definition) -> Column:
    """Table named after INTO in a copy statement, any case."""
    return F.regexp_extract(col(definition), r"(?i)INTO\s+([\w.]+)", 1)
