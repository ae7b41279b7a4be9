"""Connected components by alternating stars, with every round written to the shared folder.

In a large-star step each node links its larger neighbours to its smallest one; in a small-star step
it links itself and its smaller neighbours to the smallest of them. Both are a grouped minimum,
which collapses inside map tasks, and a join back. Minima are written before the join, so that both
sides of it are plain exchanges and adaptive execution can split the partition of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.llm.common import materialize


def _signature(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)
    ).first()


def _least(edges: DataFrame, name: str) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return materialize(edges.sparkSession, least.withColumn("m", F.least("m", "a")), name)


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node it reaches) of every node in ``links`` (columns
    ``a`` and ``b`` of one orderable type; null ends and loops are left out)."""
    spark = links.sparkSession
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = materialize(spark, edges.distinct(), "edges")
    before = _signature(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (
            both.join(_least(both, "large-star"), "a")
            .where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        large = materialize(spark, large, "edges")
        joined = large.join(_least(large, "small-star"), "a")
        small = joined.select("b", "m").toDF("a", "b").unionByName(
            joined.select("a", "m").toDF("a", "b")
        )
        edges = materialize(spark, small.where("a <> b").distinct(), "edges")
        after = _signature(edges)
        if after == before:
            break
        before = after
    tops = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        tops.select("node", F.col("node").alias("component"))
    )
