"""Silver kept up to date from a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tideglass.operators.dedup import HASH_COLUMN, dedup
from tideglass.sources.tables import read_table_or_none


def silver_by_state(
    bronze: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """One row per fingerprint, seen fingerprints kept in the state store. Which row of a
    fingerprint stays is that of the earliest batch; within a batch it may be any.

    There is no event time to expire them by, so the state grows with the data: use this for
    bounded replays and ``silver_by_batch`` for streams without end.
    """
    unique = prepare(bronze).dropDuplicates([HASH_COLUMN])
    return (
        unique.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_new_rows(batch: DataFrame, path: str) -> None:
    """Append the rows of a batch whose fingerprints the table does not have yet.

    First the table's fingerprints are cut down to those in the batch: one column is read, and
    since the size of the cached batch is known, Spark broadcasts it if small and leaves the table
    unshuffled. Only what matched meets the batch. Running a batch again adds nothing, and a batch
    without rows writes nothing.
    """
    rows = dedup(batch, order_by=[name for name in batch.columns if name != HASH_COLUMN])
    table = read_table_or_none(batch.sparkSession, path)
    rows.persist()
    try:
        if rows.count() == 0:
            return
        new_rows = rows
        if table is not None:
            known = table.select(HASH_COLUMN).join(
                rows.select(HASH_COLUMN), HASH_COLUMN, "left_semi"
            )
            new_rows = rows.join(known, HASH_COLUMN, "left_anti").select(rows.columns)
        new_rows.write.mode("append").parquet(path)
    finally:
        rows.unpersist()


def silver_by_batch(
    bronze: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """T6 without state: each micro-batch is compared with the table it extends.

    Of rows with one fingerprint that of the earliest batch stays, and within a batch the first in
    column order; a full refresh takes the first in column order over all rows. So the fields outside
    the fingerprint may differ between the two. Each batch reads the fingerprints of the table once:
    choose batches large, or refresh in full, where the table is very large.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        prepare(bronze)
        .writeStream.foreachBatch(lambda batch, _: append_new_rows(batch, path))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
