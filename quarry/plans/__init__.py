"""Registered queries: one Spark plan and (where SQL can say it) one DuckDB
oracle string per key of SURVEY section 2."""

from .registry import all_queries, all_sql, query

__all__ = ["all_queries", "all_sql", "query"]
