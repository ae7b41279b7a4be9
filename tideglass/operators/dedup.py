"""Fingerprints, duplicates, distinct values and hash samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.functions.fingerprint import record_hash

HASH_COLUMN = "record_hash"


def with_record_hash(
    df: DataFrame, columns: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Add the row fingerprint."""
    return df.withColumn(HASH_COLUMN, record_hash(columns, null_safe))


def dedup(
    df: DataFrame, order_by: Sequence[str] | None = None, key: str = HASH_COLUMN
) -> DataFrame:
    """D3: one row per fingerprint, the first in ``order_by`` (nulls first), else an arbitrary one.

    Both forms are aggregates, so copies collapse inside each map task before the shuffle, and no
    task receives more than one row per map task for a fingerprint, however many copies it has.
    Columns not in ``order_by`` follow it as tie-breakers, so the survivor is always determined.
    Fingerprints as text are grouped by their bytes, half as long in the shuffle.
    """
    if order_by is None:
        return df.dropDuplicates([key])
    rest = [name for name in df.columns if name != key and name not in order_by]
    survivor = F.min(F.struct(*order_by, *rest)).alias("_row")
    if df.schema[key].dataType.simpleString() == "string":
        packed = F.when(F.lower(F.hex(F.unhex(key))) == F.col(key), F.unhex(key))
        other = F.when(packed.isNull(), F.col(key))  # whatever its bytes would not give back
        picked = df.groupBy(packed.alias("_packed"), other.alias("_other")).agg(survivor)
        value = F.coalesce(F.lower(F.hex("_packed")), "_other").alias(key)
    else:
        picked, value = df.groupBy(key).agg(survivor), F.col(key)
    return picked.select(
        [value if name == key else F.col("_row")[name].alias(name) for name in df.columns]
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values."""
    return df.select(column).distinct().orderBy(column)


def hash_bucket(columns: Sequence[str], buckets: int = 100) -> Column:
    """Bucket of a row that depends on its values alone, not on partitions or row order."""
    digest = F.substring(record_hash(columns, null_safe=len(columns) > 1), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(buckets))


def split_rows(
    df: DataFrame, key: Sequence[str], pct: int = 80
) -> tuple[DataFrame, DataFrame]:
    """M6: about ``pct`` percent of the rows and the rest; equal keys land on the same side.

    No shuffle, and re-running on another partition layout gives the same two sides.
    """
    first = hash_bucket(key) < pct
    return df.filter(first), df.filter(~first)


def sample_rows(df: DataFrame, key: Sequence[str], pct: int = 10) -> DataFrame:
    """Repeatable row sample."""
    return split_rows(df, key, pct)[0]
