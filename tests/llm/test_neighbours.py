"""Multi-index hashing against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tideglass.llm import hamming_index
from tideglass.llm.common import read_table

SCHEMA = "vec_id long, embedding array<float>, score string, block int"


def frame(spark, rows):
    real = lambda v: None if v is None else [None if x is None else float(x) for x in v]
    return spark.createDataFrame([(i, real(v), "x", 1) for i, v in rows], SCHEMA).repartition(3)


def brute(ids, vectors, query, k):
    score = (vectors * vectors[query]).sum(axis=1)
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[query]]
    return [int(ids[i]) for i in order[:k]]


def by_query(found):
    out = {}
    for row in found.orderBy("query_id", "rank").collect():
        out.setdefault(row["query_id"], []).append(row)
    return out


def test_recall(spark, sf_dir):
    table = read_table(spark, sf_dir, "embeddings")
    rows = sorted((r["vec_id"], r["embedding"]) for r in table.collect())
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], dtype=np.float64)
    found = by_query(hamming_index.nearest(table, F.col("vec_id") % 20 == 0, k=20, block_rows=100))
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        best = found[ids[q]]
        assert [r["rank"] for r in best] == list(range(1, 21))
        hits += len({r["vec_id"] for r in best} & set(brute(ids, vectors, q, 20)))
        total += 20
        for r in best:
            at = np.searchsorted(ids, r["vec_id"])
            assert r["score"] == pytest.approx(vectors[at] @ vectors[q], abs=1e-12)
    assert hits / total >= 0.9


def test_every_code_within_the_radius_is_found():
    draw = np.random.default_rng(5)
    codes = draw.integers(0, 256, (500, 4)).astype(np.uint8)
    block = hamming_index.Block(np.arange(500), np.zeros((500, 2)), codes)
    for radius in (0, 3, 9, 14, 32):
        code = codes[7]
        apart = np.array([sum(bin(x).count("1") for x in c ^ code) for c in codes])
        assert block.within(code, radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def test_ties_norms_and_vectors_that_take_no_part(spark):
    draw = np.random.default_rng(2)
    rows = [(i, (draw.standard_normal(6) * (1 + i % 5)).tolist()) for i in range(60)]
    rows += [(100 + i, [9.0, 0, 0, 0, 0, 0]) for i in range(40)]  # one very common vector
    odd = [
        (200, None), (201, [0.0] * 6), (202, [1.0, None, 0, 0, 0, 0]), (203, [float("nan")] * 6),
        (204, [float("inf")] + [0.0] * 5), (205, [1.0]), (206, []), (None, [1.0] * 6),
    ]
    found = by_query(
        hamming_index.nearest(frame(spark, rows + odd), F.col("vec_id") % 20 == 0, k=5)
    )
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    assert set(found) == {i for i in ids.tolist() if i % 20 == 0}
    assert [r["vec_id"] for r in found[100]] == [101, 102, 103, 104, 105]
    hits = sum(
        len({r["vec_id"] for r in rows} & set(brute(ids, vectors, int(np.searchsorted(ids, q)), 5)))
        for q, rows in found.items()
    )
    assert all(len(rows) == 5 for rows in found.values())
    assert hits >= 0.9 * 5 * len(found)


def test_fewer_rows_than_asked_for_and_none(spark):
    rows = [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.2])]
    found = hamming_index.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, k=20)
    assert [(r["rank"], r["vec_id"]) for r in by_query(found)[20]] == [(1, 1), (2, 2)]
    empty = hamming_index.nearest(frame(spark, [(1, None)]), F.col("vec_id") % 20 == 0)
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.collect() == []
    unasked = hamming_index.nearest(frame(spark, rows[2:]), F.col("vec_id") % 20 == 0)
    assert unasked.collect() == []


def test_queries_meet_blocks_without_the_driver(spark, monkeypatch):
    plans, write = {}, hamming_index.materialize

    def noted(session, df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(session, df, name)

    monkeypatch.setattr(hamming_index, "materialize", noted)
    draw = np.random.default_rng(3)
    rows = frame(spark, [(i, draw.standard_normal(4).tolist()) for i in range(200)])
    found = hamming_index.nearest(rows, F.col("vec_id") % 2 == 0, k=3, block_rows=20, chunk_queries=10)
    assert found.count() == 300
    # Small as they are, neither the blocks nor copies of the queries are broadcast.
    assert "Broadcast" not in plans["nearest"]
