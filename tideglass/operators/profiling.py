"""Column profiles, histograms and densities."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NumericType,
    ShortType,
)

from tideglass.operators import order_stats
from tideglass.operators.cleaning import nan_to_null

QUARTILES = [0.25, 0.5, 0.75]
# Bytes of a bitmap block, and about as many that a value with its column's name takes in a shuffle.
BITMAP_BYTES, VALUE_BYTES = 4_096, 24
# Moments kept of a cell one bandwidth wide, and how many bandwidths from its centre the kernel counts:
# term k of the expansion is below 0.5 ** k / sqrt(k!), and exp(-t * t / 2) is below 1e-31 there.
MOMENTS, EXPANSION_REACH = 22, 12.0


def numeric_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, NumericType)]


def describe_numeric(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    accuracy: int = order_stats.ACCURACY,
    gather_limit: int = order_stats.GATHER_LIMIT,
) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum of each column.

    Runs on call: one scan for the moments, then the scans of ``exact_quantiles``; what reaches the
    driver is one row per scan.
    """
    columns = list(columns or numeric_columns(df))
    values = df.select(nan_to_null(df, columns))
    moments = values.agg(
        *[
            F.struct(
                F.count(name).alias("count"),
                F.avg(name).alias("mean"),
                F.stddev_samp(name).alias("std"),
                F.min(name).cast("double").alias("min"),
                F.max(name).cast("double").alias("max"),
            ).alias(name)
            for name in columns
        ]
    ).first()
    counts = {name: moments[name]["count"] for name in columns}
    quartiles = order_stats.exact_quantiles(values, counts, QUARTILES, accuracy, gather_limit)
    rows = [
        (name, m["count"], m["mean"], m["std"], m["min"], *quartiles[name], m["max"])
        for name, m in ((name, moments[name]) for name in columns)
    ]
    schema = (
        "column string, count bigint, mean double, std double, min double, "
        "q25 double, q50 double, q75 double, max double"
    )
    return df.sparkSession.createDataFrame(rows, schema)


def column_info(df: DataFrame) -> DataFrame:
    """Position, name, type and non-null count of each column, in one scan."""
    counts = df.agg(
        *[F.count(F.col(f"`{field.name}`")).alias(field.name) for field in df.schema]
    )
    entries = [
        F.struct(
            F.lit(position).alias("position"),
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col(f"`{field.name}`").alias("non_null"),
        )
        for position, field in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*entries)))


def distinct_profile(
    df: DataFrame, columns: Sequence[str] | None = None, limit: int = 30
) -> DataFrame:
    """Distinct values per column (null counts as one), listed as text if below ``limit``.

    Whole numbers that lie densely are counted in bitmaps, a bit per value in blocks of 32,768, which
    map tasks merge: no value of such a column is shuffled. Whether a column is dense is seen from its
    range and a sketch of its distinct count, in one scan. All other columns go through one grouping
    on (column, value): copies collapse in the map tasks and the rest spreads by value, so no column is
    gathered. The counts, a row per column, come back on call; then only columns with short lists are
    read again.
    """
    columns = list(columns or df.columns)
    dense, nulls = _dense_columns(df, columns)
    rest = [name for name in columns if name not in dense]
    counted = []
    if dense:
        values = df.select([F.col(f"`{name}`").cast("bigint").alias(name) for name in dense])
        values = values.unpivot([], dense, "column", "value").where(F.col("value").isNotNull())
        blocks = values.groupBy("column", F.bitmap_bucket_number("value").alias("block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bits")
        )
        counted.append(blocks.groupBy("column").agg(F.sum(F.bitmap_count("bits")).alias("count")))
    if rest:
        counted.append(_distinct_pairs(df, rest).groupBy("column").count())
    totals = {row["column"]: row["count"] for frame in counted for row in frame.collect()}
    for name in dense:
        totals[name] = totals.get(name, 0) + nulls[name]
    profile = df.sparkSession.createDataFrame(
        [(name, totals.get(name, 0)) for name in columns], "column string, num_unique bigint"
    )
    short = [name for name in columns if 0 < totals.get(name, 0) < limit]
    if not short:
        return profile.withColumn("values", F.lit(None).cast("string"))
    ordered = F.array_sort(F.collect_list(F.coalesce("value", F.lit("<null>"))))
    lists = _distinct_pairs(df, short).groupBy("column").agg(
        F.array_join(ordered, ", ").alias("values")
    )
    # Both sides have a row per column at most.
    return profile.join(F.broadcast(lists), "column", "left")


def _dense_columns(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], dict[str, int]]:
    """Whole-number columns whose bitmaps are no larger than their distinct values, and for each
    whether it has nulls (0 or 1)."""
    whole = (ByteType, ShortType, IntegerType, LongType)
    named = [f.name for f in df.schema if f.name in columns and isinstance(f.dataType, whole)]
    if not named:
        return [], {}
    facts = df.agg(
        *[
            F.struct(
                F.min(f"`{name}`").cast("bigint").alias("low"),
                F.max(f"`{name}`").cast("bigint").alias("high"),
                F.approx_count_distinct(f"`{name}`").alias("distinct"),
                F.count_if(F.col(f"`{name}`").isNull()).alias("nulls"),
            ).alias(f"c{i}")
            for i, name in enumerate(named)
        ]
    ).first()
    dense, nulls = [], {}
    for i, name in enumerate(named):
        fact = facts[f"c{i}"]
        nulls[name] = int(fact["nulls"] > 0)
        if fact["low"] is not None:
            blocks = (fact["high"] - fact["low"]) // 32_768 + 2
            if blocks * BITMAP_BYTES <= max(fact["distinct"], BITMAP_BYTES) * VALUE_BYTES:
                dense.append(name)
    return dense, nulls


def _distinct_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    types = {field.name: field.dataType for field in df.schema}
    text = df.select([_as_text(name, types[name]) for name in columns])
    return text.unpivot([], columns, "column", "value").distinct()


def _as_text(name: str, data_type) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(data_type, (FloatType, DoubleType)):
        value = value + F.lit(0.0).cast(data_type)  # minus zero is zero
    return value.cast("string").alias(name)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), column)
    )


def _values(df: DataFrame, column: str) -> DataFrame:
    values = df.select(nan_to_null(df, [column])).select(F.col(column).cast("double").alias("v"))
    return values.filter(F.col("v").isNotNull())


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins included.

    The range is a scalar subquery, so this is one plan: a scan for the range, a scan that counts
    into at most ``bins`` rows per task. A value is in the bin whose printed borders hold it, also
    where division would round to a neighbour. A constant column is one bin.
    """
    values = _values(df, column)
    bounds = values.agg(
        F.struct(F.min("v").alias("low"), F.max("v").alias("high")).alias("bounds")
    ).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    width = (high - low) / F.lit(float(bins))
    value, last = F.col("v"), F.lit(bins - 1)
    guess = F.when(high > low, F.least(F.floor((value - low) / width), last))
    placed = values.select("v", F.coalesce(guess, F.lit(0)).cast("int").alias("guess"))
    guess = F.col("guess")
    place = (
        F.when(value < low + guess * width, guess - 1)
        .when((guess < last) & (value >= low + (guess + 1) * width) & (high > low), guess + 1)
        .otherwise(guess)
    )
    counted = (
        placed.select(place.alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("count"))
    )
    every_bin = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    # At most ``bins`` rows.
    return (
        every_bin.join(F.broadcast(counted), "bin", "left")
        .filter((high > low) | (F.col("bin") == 0))
        .select(
            "bin",
            (low + F.col("bin") * width).alias("bin_start"),
            (low + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        )
    )


def density(df: DataFrame, column: str, points: int = 200, bins: int = 30) -> DataFrame:
    """Gaussian density on ``points`` grid positions from minimum to maximum.

    Bandwidth by Scott's rule, ``std * n ** (-1/5)``. ``curve`` is the density on the scale of the
    counts of a ``bins`` histogram. A constant column has no bandwidth, and no rows.

    A fast Gauss transform: values fall into cells of one bandwidth, and of a cell only the ``MOMENTS``
    first sums of powers of distances from its centre are kept, which map tasks add up. So a task
    shuffles a row per cell that it has values in (there are range / bandwidth of them at most), not one
    per value. The kernel around a centre expands in Hermite polynomials of those moments, with an
    error below 1e-15 of the kernel's height per value.
    """
    values = _values(df, column)
    stats = values.agg(
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        (F.stddev_samp("v") * F.pow(F.count("v"), F.lit(-0.2))).alias("h"),
        F.count("v").alias("n"),
    ).filter(F.col("h") > 0)
    stats = stats.withColumn("step", (F.col("high") - F.col("low")) / F.lit(float(points - 1)))

    # A scalar subquery puts the statistics next to each value.
    one = stats.select(F.struct("low", "h", "step").alias("s")).scalar()
    placed = values.select(((F.col("v") - one.getField("low")) / one.getField("h")).alias("u"))
    placed = placed.filter(F.col("u").isNotNull()).select(
        F.floor("u").alias("cell"), (F.col("u") - F.floor("u") - 0.5).alias("d")
    )
    powers = [F.lit(1.0)]
    for _ in range(MOMENTS - 1):
        powers.append(powers[-1] * F.col("d"))
    cells = placed.groupBy("cell").agg(*[F.sum(p).alias(f"m{k}") for k, p in enumerate(powers)])

    # From here on a row per cell, and then one per cell and grid point that it reaches.
    shares = F.array(*[F.col(f"m{k}") / float(math.factorial(k)) for k in range(MOMENTS)])
    grain = one.getField("step") / one.getField("h")
    known = cells.select((F.col("cell") + 0.5).alias("centre"), shares.alias("m"), grain.alias("grain"))
    first = F.greatest(F.lit(0), F.ceil((F.col("centre") - EXPANSION_REACH) / F.col("grain")).cast("int"))
    last = F.least(F.lit(points - 1), F.floor((F.col("centre") + EXPANSION_REACH) / F.col("grain")).cast("int"))
    near = known.select("*", first.alias("first"), last.alias("last")).filter("first <= last")
    hits = near.select("centre", "m", "grain", F.explode(F.sequence("first", "last")).alias("point"))
    hits = hits.select("point", "m", (F.col("point") * F.col("grain") - F.col("centre")).alias("t"))
    sums = hits.groupBy("point").agg(
        F.sum(_hermite_sum("m", F.col("t")) * F.exp(F.col("t") * F.col("t") * -0.5)).alias("total")
    )

    grid = stats.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    scale = F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi())
    # What the expansion leaves of 0 may be a trace below it.
    value = F.greatest(F.coalesce("total", F.lit(0.0)), F.lit(0.0)) / scale
    bin_width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    # At most ``points`` rows.
    return grid.join(F.broadcast(sums), "point", "left").select(
        "point",
        (F.col("low") + F.col("point") * F.col("step")).alias("x"),
        value.alias("density"),
        (value * F.col("n") * bin_width).alias("curve"),
    )


def _hermite_sum(shares: str, t: Column) -> Column:
    """The sum of ``shares[k] * He_k(t)``, by the recursion of the polynomials."""
    start = F.struct(
        F.lit(0.0).alias("before"), F.lit(1.0).alias("he"), F.lit(0.0).alias("k"), F.lit(0.0).alias("sum")
    )
    return F.aggregate(
        shares,
        start,
        lambda s, m: F.struct(
            s["he"].alias("before"),
            (t * s["he"] - s["k"] * s["before"]).alias("he"),
            (s["k"] + 1.0).alias("k"),
            (s["sum"] + m * s["he"]).alias("sum"),
        ),
        lambda s: s["sum"],
    )
