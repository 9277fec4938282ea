"""The catalogue of named queries over the driver's tables, with their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import content, evaluation, pipelines, relational, rubrics, storage, streams, web

Query = Callable[[SparkSession, str], DataFrame]

FLAGSHIP = "agg7_funnel"
PARTS = (content, relational, pipelines, rubrics, web, evaluation, storage, streams)


def queries() -> dict[str, Query]:
    return {k: v for part in PARTS for k, v in part.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for part in PARTS for k, v in part.oracle_sql().items()}
