"""Compare registered queries with their SQL on DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    return value


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def spark_side(df):
    return sorted(df.columns), bag(df.columns, [tuple(r) for r in df.collect()]), dict(df.dtypes)


def duck_side(con, sql):
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    types = {c[0]: str(c[1]) for c in rel.description}
    return sorted(names), bag(names, rel.fetchall()), types


def difference(df, con, sql):
    """None when both sides agree, else a short description."""
    s_names, s_rows, s_types = spark_side(df)
    d_names, d_rows, d_types = duck_side(con, sql)
    if s_names != d_names:
        return f"columns differ: {s_names} / {d_names}"
    if s_rows != d_rows:
        extra = [r for r in s_rows if r not in d_rows][:2]
        missing = [r for r in d_rows if r not in s_rows][:2]
        return f"rows differ: {len(s_rows)} / {len(d_rows)}; only spark {extra}; only sql {missing}"
    loose = {n: (s_types[n], d_types[n]) for n in s_names if not _same_kind(s_types[n], d_types[n])}
    return f"types differ: {loose}" if loose else None


def _same_kind(spark: str, duck: str) -> bool:
    kinds = {
        "bigint": ("BIGINT",), "int": ("INTEGER",), "double": ("DOUBLE",), "string": ("VARCHAR", "STRING"),
        "timestamp_ntz": ("TIMESTAMP", "DATETIME"), "timestamp": ("TIMESTAMP WITH TIME ZONE", "TIMESTAMP", "DATETIME"),
        "date": ("DATE",), "boolean": ("BOOLEAN", "BOOL"),
    }
    return duck.upper() in kinds.get(spark, (duck.upper(),)) or spark not in kinds
