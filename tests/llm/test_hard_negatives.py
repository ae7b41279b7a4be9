"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tideglass.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, block string, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", 1.0) for i, v, k in rows], SCHEMA).repartition(3)


def brute(rows, asked, positives, negatives, low=30, high=90):
    """All results, by scores of every pair."""
    whole = [(i, [math.floor(256 * x) for x in v], k) for i, v, k in rows]
    out = []
    for i, v, k in whole:
        if not asked(i):
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, m) for j, w, m in whole]
        best = sorted((s, j) for s, j, m in scored if m == k and j != i)[:positives]
        for p, positive in best:
            fit = sorted((s, j) for s, j, m in scored if m != k and low * -p <= 100 * -s <= high * -p)
            out += [
                (i, positive, rank, j, -p, -s) for rank, (s, j) in enumerate(fit[:negatives], 1)
            ]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def found(*args, **options):
    return sorted(tuple(r) for r in hard_negatives.mine(*args, **options).select(*COLUMNS).collect())


@pytest.mark.parametrize("block_rows", [7, 40, 65_536])
def test_equal_to_brute_force(spark, block_rows):
    draw = random.Random(4)
    rows = [
        (i, [draw.choice([-1, 0, 0.25, 0.5, 1]) * draw.random() for _ in range(11)], draw.choice([1, 1, 2, 3]))
        for i in range(150)
    ]
    rows += [(200 + i, [0.5] * 11, 1) for i in range(30)] + [(300 + i, [0.25] * 11, 2) for i in range(30)]
    want = brute(rows, lambda i: i % 10 == 0, 5, 10)
    assert len(want) > 300
    got = found(frame(spark, rows), F.col("vec_id") % 10 == 0, block_rows=block_rows)
    assert got == want


def test_rows_that_take_no_part_repeats_and_ties(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.0], 1), (1, [0.5, 0.0], 1), (2, [0.4, 0.0], 2), (3, [0.4, 0.0], 2)]
    odd = [
        (None, [1.0, 0.0], 2), (4, None, 2), (5, [None, 1.0], 2), (6, [float("nan"), 1.0], 2), (7, [], 2),
        (8, [float("inf"), 0.0], 2), (9, [0.4, 0.0], None), (10, [0.4], 2),
    ]
    got = found(frame(spark, rows + odd), F.col("vec_id") == 0, positives=2)
    p, n = 256 * 128, 256 * 102
    assert got == sorted([(0, 1, 1, 2, p, n), (0, 1, 2, 3, p, n)] * 2)
    assert found(frame(spark, odd[1:3]), F.col("vec_id") >= 0) == []
    assert found(frame(spark, rows), F.col("vec_id") == 99) == []
    assert hard_negatives.mine(frame(spark, []), F.col("vec_id") == 0).columns == COLUMNS
    alone = [(0, [1.0, 0.0], 1), (2, [0.4, 0.0], 2)]
    assert found(frame(spark, alone), F.col("vec_id") == 0) == []


def test_labels_of_text_and_wide_tables(spark):
    draw = random.Random(8)
    rows = [(i, [draw.random() for _ in range(3)], i % 2) for i in range(40)]
    table = frame(spark, rows).withColumn("label", F.concat(F.lit("class "), F.col("label")))
    assert found(table, F.col("vec_id") % 5 == 0) == brute(rows, lambda i: i % 5 == 0, 5, 10)


def test_bounds_drop_rows_early():
    draw = np.random.default_rng(1)
    strength = 400 * 0.8 ** np.arange(64)
    vectors = (draw.standard_normal((4000, 64)) * strength).astype(np.int32)
    block = hard_negatives.Block(np.arange(4000), np.zeros(4000, np.int64), vectors)
    anchor = draw.permutation(vectors)[0].astype(np.int64)
    exact = vectors.astype(np.int64) @ anchor
    low, high = np.array([-(2**62), 0]), np.array([2**62, int(exact.max() // 2)])
    found = block.scan(anchor, np.ones(4000, dtype=bool), low, high, 5)
    for (rows, scores), a, b in zip(found, low, high):
        inside = np.flatnonzero((exact >= a) & (exact <= b))
        best = inside[np.lexsort((inside, -exact[inside]))[:5]]
        assert rows.tolist() == best.tolist() and scores.tolist() == exact[best].tolist()
    assert block.read < 0.8 * 4000 * 64
