"""Cleaning: names, types, characters and required values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from tideglass.functions.casting import lenient_cast

# Replacements that make a column name safe for Parquet, applied in this order.
NAME_RULES = [(" (%)", "_Percent"), (" ", "_"), ("(", ""), (")", ""), ("/", "_"), ("-", "_")]

# Fixed value: runs of characters other than digits, hyphen, plus and white space.
NOT_AGE_CHARACTERS = r"[^0-9\-+\s]+"


def normalize_name(name: str) -> str:
    for old, new in NAME_RULES:
        name = name.replace(old, new)
    return name


def normalize_columns(df: DataFrame) -> DataFrame:
    """Parquet-safe column names; two names that become the same are an error."""
    names = [normalize_name(name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"columns share a name after normalisation: {clashes}")
    return df.toDF(*names)


def cast_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Schema columns first, typed, unreadable values null and absent columns null; then the
    columns the schema does not list, as they are. One projection.

    Names are matched by the session's rule on letter case. Columns that compete for one name are an
    error.
    """
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    key = str if exact else str.lower
    present = {}
    for field in df.schema:
        if key(field.name) in present:
            raise ValueError(f"columns compete for one name: {present[key(field.name)].name}, {field.name}")
        present[key(field.name)] = field
    typed = []
    for field in schema:
        found = present.pop(key(field.name), None)
        value = F.lit(None).cast(field.dataType)
        if found is not None:
            value = lenient_cast(F.col(f"`{found.name}`"), found.dataType, field.dataType)
        typed.append(value.alias(field.name))
    extra = [F.col(f"`{field.name}`") for field in present.values()]
    return df.select(*typed, *extra)


def keep_chars(
    df: DataFrame, column: str, drop_pattern: str = NOT_AGE_CHARACTERS, trim: bool = False
) -> DataFrame:
    """Remove all characters that match ``drop_pattern``; blanks at the ends stay by default."""
    kept = F.regexp_replace(column, drop_pattern, "")
    return df.withColumn(column, F.trim(kept) if trim else kept)


def clean_text(
    df: DataFrame, trim: Sequence[str] = ("text",), lower: Sequence[str] = ("label",)
) -> DataFrame:
    """Trim some columns, trim and lower-case others."""
    changes = {name: F.trim(F.col(name)) for name in trim}
    changes |= {name: F.trim(F.lower(F.col(name))) for name in lower}
    return df.withColumns(changes)


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """P5: drop rows with a null in any key column."""
    return df.na.drop(subset=list(keys))


def require_non_empty(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where every column has some text."""
    for name in columns:
        df = df.filter(F.col(name).isNotNull() & (F.col(name) != ""))
    return df


def probe_contains(df: DataFrame, column: str, needle: str, n: int = 5) -> DataFrame:
    """Up to ``n`` values that contain ``needle``."""
    return df.select(column).filter(F.col(column).contains(needle)).limit(n)


def probe_counts(df: DataFrame, needle: str, **versions: Column) -> DataFrame:
    """P7 as a check: how many rows contain ``needle`` in each version of a value, in one pass."""
    return df.agg(
        *[F.count_if(value.contains(needle)).alias(name) for name, value in versions.items()]
    )


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Leave out columns, for example a name that must not become a feature."""
    return df.drop(*columns)


def model_rows(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Features and target only, without rows that have a null or NaN among them."""
    return df.select(*features, target).na.drop()


def nan_to_null(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Columns with NaN read as missing, under their own names."""
    types = {field.name: field.dataType for field in df.schema}
    return [
        (
            F.nanvl(F.col(name), F.lit(None).cast(types[name]))
            if isinstance(types[name], (FloatType, DoubleType))
            else F.col(name)
        ).alias(name)
        for name in columns
    ]
