"""Queries over the test tables of the operators in this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    import corpus_pipeline
    from tideglass.llm import catalog

    return {**catalog.QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    from tideglass.llm import catalog

    return dict(catalog.SQL)
