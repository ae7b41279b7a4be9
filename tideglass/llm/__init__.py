"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

from tideglass.llm.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
