"""Queries of the trajectory engine by name, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomline.plans import queries as q
from loomline.plans import record_queries, review_queries, table_queries  # noqa: F401  these register their queries with those of q


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.report_grouping_sets(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(q.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(q.SQL)
