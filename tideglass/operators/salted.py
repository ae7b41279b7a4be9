"""Joins whose hot keys are spread over many tasks, whatever the other side looks like."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if more than this share of the rows has it, so at most its inverse are; and over how many
#: tasks the rows of a hot key are spread.
SHARE, SALTS = 1 / 64, 32


def hot_keys(rows: DataFrame, key: str, share: float = SHARE) -> DataFrame:
    """Keys that more than ``share`` of the rows have: fewer than ``1 / share`` of them.

    Each task sums its rows by key before anything moves, so a hot key is one row per task in the shuffle.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("n")).scalar()
    return counts.where(F.col("n") > total * share).select(key)


def salted_join(
    rows: DataFrame, other: DataFrame, key: str, how: str = "inner", share: float = SHARE, salts: int = SALTS
) -> DataFrame:
    """``rows`` joined with ``other`` on ``key`` (``inner`` or ``left``), as ``rows.join(other, key, how)``.

    The rows of hot keys are dealt to ``salts`` tasks each, and the few rows that ``other`` has for these
    keys are copied for each of them. So no task gets a key's rows alone, also where Spark cannot split a
    partition because ``other`` is partitioned by the key already. ``other`` should have few rows for a
    key. The hot keys are found when the plan runs; where there are none, all rows have the one salt 0.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"rows of {how} joins cannot be dealt out")
    salt, hot = _unused("salt", rows, other), _unused("hot", rows, other)
    listed = hot_keys(rows, key, share).agg(F.collect_list(key).alias("keys")).scalar()
    is_hot = F.coalesce(F.array_contains(listed, F.col(key)), F.lit(False))
    dealt = rows.withColumn(
        salt, F.when(is_hot, F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")).otherwise(0)
    )
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    copied = other.withColumn(hot, is_hot).withColumn(
        salt, F.explode(F.when(F.col(hot), every).otherwise(F.array(F.lit(0))))
    )
    return dealt.join(copied.drop(hot), [key, salt], how).drop(salt)


def _unused(name: str, *frames: DataFrame) -> str:
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name in taken:
        name += "_"
    return name
