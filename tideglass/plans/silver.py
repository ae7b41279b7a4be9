"""Bronze to Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tideglass.operators.cleaning import (
    cast_to_schema,
    clean_text,
    drop_null_keys,
    keep_chars,
    normalize_columns,
    require_non_empty,
)
from tideglass.operators.dedup import HASH_COLUMN, dedup, with_record_hash
from tideglass.schemas import (
    ABSTRACT_IDENTITY,
    ABSTRACT_SCHEMA,
    HEALTH_IDENTITY,
    HEALTH_REQUIRED,
    HEALTH_SCHEMA,
)


def hashed_health(bronze: DataFrame) -> DataFrame:
    """Typed, cleaned and fingerprinted health rows; one narrow stage, for batches and streams."""
    typed = cast_to_schema(normalize_columns(bronze), HEALTH_SCHEMA)
    valid = drop_null_keys(keep_chars(typed, "Age_Group"), HEALTH_REQUIRED)
    return _hash_after_schema(with_record_hash(valid, HEALTH_IDENTITY), HEALTH_SCHEMA.names)


def hashed_abstracts(bronze: DataFrame) -> DataFrame:
    """Cleaned and fingerprinted documents; one narrow stage, for batches and streams."""
    typed = cast_to_schema(bronze, ABSTRACT_SCHEMA)
    valid = require_non_empty(clean_text(typed), ["text", "label"])
    return _hash_after_schema(with_record_hash(valid, ABSTRACT_IDENTITY), ABSTRACT_SCHEMA.names)


def _hash_after_schema(df: DataFrame, names: list[str]) -> DataFrame:
    extra = [name for name in df.columns if name not in names and name != HASH_COLUMN]
    return df.select(*names, HASH_COLUMN, *extra)


def to_silver_health(bronze: DataFrame) -> DataFrame:
    """Silver health table. Of rows with one fingerprint the first in schema column order stays."""
    return dedup(hashed_health(bronze), order_by=HEALTH_SCHEMA.names)


def to_silver_abstracts(bronze: DataFrame) -> DataFrame:
    """Silver abstracts table."""
    return dedup(hashed_abstracts(bronze), order_by=ABSTRACT_SCHEMA.names)
