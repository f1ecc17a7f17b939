"""Registry of named queries and their SQL counterparts."""

from __future__ import annotations

from importlib import import_module

_QUERIES: dict = {}
_ORACLE: dict = {}

MODULES = (
    "history", "costs", "quality", "reconcile", "freshness", "filesize", "schema", "alerts",
    "scalars", "joins", "copying", "rejects", "merging", "folders", "versions", "external", "replicate", "streams", "landing",
)


def query(name: str, oracle: str | None = None):
    """Register fn(spark, sf_dir) under `name`."""

    def add(fn):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLE[name] = oracle.strip()
        return fn

    return add


def load_all() -> None:
    for name in MODULES:
        import_module(f"loadkit.plans.{name}")


def all_queries() -> dict:
    load_all()
    return dict(_QUERIES)


def all_oracles() -> dict:
    load_all()
    return dict(_ORACLE)
