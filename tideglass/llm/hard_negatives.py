"""Hard negatives by a vertical scan with branch and bound (BOND) over integer inner products.

Components are scaled and floored to whole numbers. Rows are dealt to blocks by label; within a block
the components of one dimension lie together. For each anchor the dimensions of a block are read in the
order of the anchor's descending magnitudes. What the dimensions not read yet can add lies between two
sums of the block's least and greatest component per dimension; by these bounds rows leave the
candidate bitmap as soon as they cannot be among the best any more, and the rows left at the last
dimension have exact scores.

First the scan finds each anchor's positives, in the blocks that hold its label only; then, with the
positives' scores known, the windows of its negatives are resolved, in all blocks. An anchor is a row of
the shuffle for each block it goes to, and a block sends back its best few rows per anchor and window, so
no task ever holds more than one block and one Arrow batch of anchors.

Vectors that are null, empty, of another length than most, or hold a null or non-finite component take no
part, nor do rows with a null id or label. Scores must fit 64 bits, so components of 2**24 and more after
scaling take their row out as well (of values below 65,536, none does at a scale of 256). Rows that share
an id are rows of their own: each can be an anchor, a positive and a negative, but not a positive of an
anchor of its own id. Ties go to the smaller id; among rows that share id and score any order is the same
result. Anchors without positives, and positives without rows in their window, have no rows. Other
columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.llm.common import materialize

#: Rows of a block at most, about; below LEAST_ROWS blocks are not made smaller for more tasks.
BLOCK_ROWS, LEAST_ROWS = 65_536, 2_048
#: Dimensions read between two looks at the bounds.
STRIDE = 8
_LARGEST = 1 << 24
_END = np.iinfo(np.int64).max


def _numbers(vectors: DataFrame, vec_id: str, label: str, embedding: str, scale: int) -> DataFrame:
    """``rid`` (a number for each row), ``vec_id``, ``label`` and ``v`` of the rows that take part."""
    value = F.col(f"`{embedding}`").cast("array<double>")
    scaled = F.transform(value, lambda x: F.floor(x * scale))
    plain = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
        F.col(f"`{label}`").alias("label"),
        value.alias("e"),
        scaled.alias("v"),
    ).where(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & (F.size("e") > 0)
        & ~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x * scale) >= float(_LARGEST)))
    )
    return plain.select(
        F.monotonically_increasing_id().alias("rid"), "vec_id", "label", F.col("v").cast("array<int>")
    )


class Block:
    """Rows in columns: ``columns[d]`` holds dimension ``d`` of all of them."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels = ids, labels
        self.columns = np.ascontiguousarray(rows.T)
        self.least = self.columns.min(axis=1).astype(np.int64)
        self.most = self.columns.max(axis=1).astype(np.int64)
        self.read = self.kept = 0

    def scan(
        self, anchor: np.ndarray, candidates: np.ndarray, low: np.ndarray, high: np.ndarray, k: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window ``low[i] <= score <= high[i]`` the places and scores of the ``k`` best of
        the ``candidates`` (a bitmap), best first."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        a, b = anchor * self.least, anchor * self.most
        least, most = np.minimum(a, b)[order], np.maximum(a, b)[order]
        # What the dimensions from each place of the order on add at least and at most.
        least = np.append(np.cumsum(least[::-1])[::-1], 0)
        most = np.append(np.cumsum(most[::-1])[::-1], 0)
        rows = np.flatnonzero(candidates)
        partial = np.zeros(len(rows), dtype=np.int64)
        for start in range(0, len(order), STRIDE):
            if not len(rows):
                break
            every = len(rows) == len(self.ids)
            for d in order[start : start + STRIDE]:
                column = self.columns[d] if every else self.columns[d][rows]
                partial += column * anchor[d]
            self.read += len(rows) * len(order[start : start + STRIDE])
            at = min(start + STRIDE, len(order))
            alive = self._alive(partial, least[at], most[at], low, high, k)
            if not alive.all():
                rows, partial = rows[alive], partial[alive]
        self.kept += len(rows)
        out = []
        for floor, ceiling in zip(low, high):
            inside = np.flatnonzero((partial >= floor) & (partial <= ceiling))
            if len(inside) > k:
                score = partial[inside]
                inside = inside[score >= np.partition(score, len(score) - k)[len(score) - k]]
            best = inside[np.lexsort((self.ids[rows[inside]], -partial[inside]))[:k]]
            out.append((rows[best], partial[best]))
        return out

    @staticmethod
    def _alive(partial, least, most, low, high, k) -> np.ndarray:
        """Candidates that can still be among the ``k`` best of a window: those the window may hold,
        but for those that ``k`` rows surely in the window surely beat."""
        alive = np.zeros(len(partial), dtype=bool)
        for floor, ceiling in zip(low, high):
            lower, upper = partial + least, partial + most
            here = (upper >= floor) & (lower <= ceiling)
            sure = lower[(lower >= floor) & (upper <= ceiling)]
            if len(sure) >= k:
                here &= upper >= np.partition(sure, len(sure) - k)[len(sure) - k]
            alive |= here
        return alive


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _scanner(same_label: bool, k: int):
    """Streams blocks, each its rows and then the anchors that visit it."""

    def search(block: Block, batch: pa.RecordBatch):
        owner, window, ids, scores = [], [], [], []
        anchors = _matrix(batch, "v").astype(np.int64)
        rids, own = batch.column("rid").to_numpy(), batch.column("vec_id").to_numpy()
        labels = batch.column("code").to_numpy()
        lows, highs = batch.column("low").to_pylist(), batch.column("high").to_pylist()
        for i, anchor in enumerate(anchors):
            alike = block.labels == labels[i]
            wanted = alike & (block.ids != own[i]) if same_label else ~alike
            low, high = np.array(lows[i], np.int64), np.array(highs[i], np.int64)
            for w, (rows, score) in enumerate(block.scan(anchor, wanted, low, high, k)):
                owner.append(np.full(len(rows), rids[i]))
                window.append(np.full(len(rows), w, dtype=np.int32))
                ids.append(block.ids[rows])
                scores.append(score)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x)) for x in (owner, window, ids, scores)],
            names=["anchor", "w", "found_id", "score"],
        )

    def run(batches):
        block, number, parts = None, None, []
        for whole in batches:
            blocks = whole.column("block").to_numpy()
            kinds = whole.column("visitor").to_numpy(zero_copy_only=False).astype(np.int8)
            edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), whole.num_rows]):
                if a == b:
                    continue
                if blocks[a] != number:
                    block, number, parts = None, blocks[a], []
                batch = whole.slice(a, b - a)
                if not kinds[a]:
                    parts.append(
                        (
                            batch.column("vec_id").to_numpy(),
                            batch.column("code").to_numpy(),
                            _matrix(batch, "v"),
                        )
                    )
                    continue
                if block is None and parts:
                    block = Block(*[np.concatenate(x) for x in zip(*parts)])
                    parts = []
                if block is not None:
                    yield search(block, batch)

    return run


_FOUND = "anchor long, w int, found_id long, score long"
_SENT = ("block", "visitor", "rid", "vec_id", "code", "v", "low", "high")


def _scan(blocks: DataFrame, visits: DataFrame, number: int, same_label: bool, k: int) -> DataFrame:
    """The ``k`` best of each anchor and window, over all blocks that the anchor visits."""
    nothing = F.array().cast("array<long>")
    rows = blocks.withColumns({"visitor": F.lit(False), "low": nothing, "high": nothing})
    sent = rows.select(*_SENT).unionByName(visits.withColumn("visitor", F.lit(True)).select(*_SENT))
    dealt = sent.repartition(number, "block").sortWithinPartitions("block", "visitor")
    found = dealt.mapInArrow(_scanner(same_label, k), _FOUND)
    best = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    scale: int = 256,
    vec_id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Hard negatives of the rows that ``anchors``, a condition on ``vec_id``, holds for.

    Of each anchor the first ``positives`` other rows of its label are taken, and for each of them the
    first ``negatives`` rows of other labels whose score is from ``low_percent`` to ``high_percent`` of
    the positive's: ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score``, ``negative_score``.
    """
    spark = vectors.sparkSession
    rows = materialize(spark, _numbers(vectors, vec_id, label, embedding, scale), "numbers")
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "d").first()
    if most is None:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
            "negative_score long"
        )
    rows = rows.where(F.size("v") == most["d"]).withColumn("code", F.xxhash64("label"))
    cores = spark.sparkContext.defaultParallelism
    number = max(-(-most["n"] // block_rows), min(cores, -(-most["n"] // LEAST_ROWS)))
    share = -(-most["n"] // number)

    # The rows of a label go to as many neighbouring blocks as they fill.
    labels = rows.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / share).alias("wide"))
    placed = rows.join(labels, "code")
    first = F.pmod(F.xxhash64("code", F.lit("block")), F.lit(number))
    own = F.pmod(F.xxhash64("rid"), F.col("wide"))
    blocks = placed.withColumn("block", F.pmod(first + own, F.lit(number)))
    blocks = materialize(spark, blocks.select("rid", "vec_id", "code", "v", "block"), "blocks")

    asked = materialize(spark, placed.where(anchors), "anchors")
    numbers = F.transform(
        F.sequence(F.lit(0), F.least(F.col("wide"), F.lit(number)) - 1),
        lambda j: F.pmod(first + j, F.lit(number)),
    )
    bound = F.array(F.lit(_END))
    visits = asked.withColumns({"low": F.array(F.lit(-_END)), "high": bound}).withColumn(
        "block", F.explode(numbers)
    )
    found = _scan(blocks, visits, number, True, positives)
    found = materialize(spark, found, "positives")

    listed = F.array_sort(F.collect_list(F.struct("rank", "found_id", "score")))
    ranked = found.groupBy("anchor").agg(listed.alias("positive"))
    known = asked.join(ranked, asked["rid"] == ranked["anchor"]).drop("anchor")
    def percent(number: int):
        return lambda p: p["score"].cast("decimal(20,0)") * number / 100

    low = F.transform("positive", lambda p: F.ceil(percent(low_percent)(p)).cast("long"))
    high = F.transform("positive", lambda p: F.floor(percent(high_percent)(p)).cast("long"))
    known = materialize(spark, known.withColumns({"low": low, "high": high}), "windows")
    every = F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long"))
    visits = known.withColumn("block", F.explode(every))
    ranked = _scan(blocks, visits, number, False, negatives)

    names = known.select("rid", F.col("vec_id").alias("anchor_id"), F.posexplode("positive").alias("w", "p"))
    joined = ranked.join(names, (ranked["anchor"] == names["rid"]) & (ranked["w"] == names["w"]))
    return joined.select(
        "anchor_id",
        F.col("p.found_id").alias("positive_id"),
        ranked["rank"].cast("int").alias("rank"),
        F.col("found_id").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        ranked["score"].alias("negative_score"),
    )
