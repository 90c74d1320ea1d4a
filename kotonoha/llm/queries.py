"""Queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries_corpus, queries_groups, queries_text

_PARTS = [queries_text, queries_groups, queries_corpus]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for part in _PARTS for k, v in part.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for part in _PARTS for k, v in part.oracle_sql().items()}
