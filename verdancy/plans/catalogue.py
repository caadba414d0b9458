"""The registered queries of the decision-record engine and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame callable under name, with its oracle where SQL has one."""

    def add(function):
        _QUERIES[name] = function
        if sql is not None:
            _ORACLES[name] = sql
        return function

    return add


def _load() -> None:
    from . import queries_cases, queries_dist, queries_generate, queries_more, queries_rules, queries_stages, queries_text  # noqa: F401  they register themselves


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
