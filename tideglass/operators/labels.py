"""Label indexes for columns whose values grow with the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.operators.salted import salted_join
from tideglass.session import materialize


def label_index(df: DataFrame, column: str) -> DataFrame:
    """M1 for many values: a table of ``column`` and ``index``, 0 for the most frequent value, equal
    counts in the order of the values; nulls have no index.

    Counts are sorted over range partitions, each numbers its own rows, and adds how many come before it:
    one number per partition is all that passes through the driver.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc(column)]
    ordered = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id of a row is its partition in the upper bits and its place there in the lower 33.
    numbered = ordered.select(column, F.monotonically_increasing_id().alias("id"))
    numbered = materialize(df.sparkSession, numbered, "labels")
    part, place = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before, starts = 0, []
    for row in sizes:
        starts.append((row["part"], before))
        before += row["n"]
    offsets = df.sparkSession.createDataFrame(starts, "part bigint, start bigint")
    placed = numbered.select(column, part.cast("bigint").alias("part"), place.alias("place"))
    # As many rows as there are partitions.
    return placed.join(F.broadcast(offsets), "part").select(
        column, (F.col("start") + F.col("place")).cast("double").alias("index")
    )


def with_label_index(df: DataFrame, labels: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """``df`` with the index of ``column`` by ``labels`` (of ``label_index``, perhaps of other rows). As
    ``string_indexer`` does, unseen values and nulls get one index more than the last."""
    name = name or f"{column}_index"
    unseen = labels.agg((F.coalesce(F.max("index"), F.lit(-1.0)) + 1).alias("n")).scalar()
    renamed = labels.withColumnRenamed("index", name)
    joined = salted_join(df, renamed, column, "left")
    return joined.withColumn(name, F.coalesce(name, unseen)).select(*df.columns, name)
