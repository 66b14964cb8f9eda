"""All queries outside the ``llm`` subpackage, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palisade.plans import pipelines, pipelines_sql, preparation, preparation_sql

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return pipelines.QUERIES | preparation.QUERIES


def oracle_sql() -> dict[str, str]:
    return pipelines_sql.SQL | preparation_sql.SQL
