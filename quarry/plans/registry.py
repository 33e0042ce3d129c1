from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}

_MODULES = (
    "sources_q", "relational_q", "joins_q", "aggregates_q", "windows_q",
    "scalars_q", "nested_q", "changes_q", "keys_q", "quality_q", "layout_q",
    "history_q", "domain_q", "text_q", "sqlfuncs_q", "streams_q",
)


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key}")
        _QUERIES[key] = fn
        if sql is not None:
            _SQL[key] = sql
        return fn

    return deco


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"{__package__}.{m}")


def all_queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
