"""Named queries over the standard tables, each next to the SQL that gives the
same result (where SQL can express it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from facetforge.plans.queries import documents, evaluation, features, runs, search, tables, wide

Query = Callable[[SparkSession, str], DataFrame]

_AREAS = (tables, features, evaluation, documents, runs, search, wide)


def all_queries() -> dict[str, Query]:
    return {name: query for area in _AREAS for name, query in area.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for area in _AREAS for name, sql in area.SQL.items()}
