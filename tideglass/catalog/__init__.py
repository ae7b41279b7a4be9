"""Queries over the test tables, each with its SQL twin where SQL can say the same."""

from tideglass.catalog import health, ml, profiles, published, streams, texts  # noqa: F401
from tideglass.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
