"""Every query of the engine by name, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagewright.plans import block_queries, compare_queries, enrich_queries, part_queries, text_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
for _m in (text_queries, block_queries, enrich_queries, compare_queries, part_queries):
    QUERIES |= _m.QUERIES
    SQL |= _m.SQL
