"""The registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import grid_queries, sequence_queries, source_queries, track_queries, whole_queries

FLAGSHIP = "gap_clusters"
_ALL = sequence_queries.QUERIES | grid_queries.QUERIES | track_queries.QUERIES | source_queries.QUERIES | whole_queries.QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in _ALL.items()}


#: SQL of queries whose own modules give none.
_MORE = {"monotonic_align": source_queries.ALIGN_SQL, "greedy_assign": source_queries.ASSIGN_SQL}


def oracle_sql() -> dict[str, str]:
    return {name: sql.strip() for name, (_, sql) in _ALL.items() if sql} | {name: sql.strip() for name, sql in _MORE.items()}
