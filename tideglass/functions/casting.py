"""Casts that turn unreadable values into null while ANSI mode stays on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StringType

# Plain decimal notation only: exponents, suffixes and words such as NaN are not whole numbers.
PLAIN_NUMBER = r"^\s*[+-]?[0-9]*\.?[0-9]*\s*$"


def lenient_cast(column: Column, source: DataType, target: DataType) -> Column:
    """Cast, or null. Whole-number text may carry decimals, which are cut off (``12.7`` -> 12)."""
    if isinstance(source, StringType) and isinstance(target, (IntegerType, LongType)):
        wide = "decimal(38,10)" if isinstance(target, LongType) else "double"
        # Most values are bare digits; the pattern is tested for the others only.
        cut = F.when(column.rlike(PLAIN_NUMBER), column.try_cast(wide).try_cast(target))
        return F.coalesce(column.try_cast(target), cut)
    return column.try_cast(target)
