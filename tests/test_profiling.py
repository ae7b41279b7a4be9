import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tideglass.operators import order_stats, profiling


def doubles(spark, items, name="x"):
    return spark.createDataFrame([(v,) for v in items], f"{name} double")


def test_describe_matches_pandas(spark):
    rng = random.Random(1)
    items = [rng.gauss(0, 5) for _ in range(501)] + [None, float("nan")]
    row = profiling.describe_numeric(doubles(spark, items)).first()
    expected = pd.Series(items, dtype="float64").describe()
    ours = [row[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")]
    assert ours == pytest.approx(list(expected), rel=1e-12)


def narrowed(spark, items, accuracy=50, gather_limit=20):
    """Quartiles with limits so low that several narrowing rounds are needed."""
    frame = doubles(spark, items).repartition(5)
    found = order_stats.exact_quantiles(
        frame, {"x": len(items)}, [0.0, 0.25, 0.5, 0.75, 1.0], accuracy, gather_limit
    )
    return found["x"]


@pytest.mark.parametrize("shape", ["uniform", "hot", "two values", "heavy tail", "constant"])
def test_exact_quantiles_by_narrowing(spark, shape):
    rng = random.Random(shape)
    items = {
        "uniform": [rng.random() for _ in range(5000)],
        "hot": [7.0] * 1700 + [rng.random() * 20 for _ in range(3300)],
        "two values": [1.0] * 2500 + [2.0] * 2500,
        "heavy tail": [math.exp(rng.gauss(0, 12)) * rng.choice([-1, 1]) for _ in range(4001)],
        "constant": [3.5] * 1000,
    }[shape]
    expected = np.quantile(np.array(items), [0.0, 0.25, 0.5, 0.75, 1.0])
    assert narrowed(spark, items) == pytest.approx(list(expected), rel=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6, width=32), min_size=1, max_size=60))
def test_exact_quantiles_property(spark, items):
    expected = np.quantile(np.array(items), [0.0, 0.25, 0.5, 0.75, 1.0])
    assert narrowed(spark, items, accuracy=10, gather_limit=3) == pytest.approx(
        list(expected), rel=1e-9, abs=1e-9
    )


def test_describe_without_values(spark):
    row = profiling.describe_numeric(doubles(spark, [None, None])).first()
    assert row["count"] == 0 and row["q50"] is None and row["mean"] is None


def test_column_info(spark):
    frame = spark.createDataFrame([(1, None), (2, "x")], "`a b` int, c string")
    assert [tuple(r) for r in profiling.column_info(frame).orderBy("position").collect()] == [
        (0, "a b", "int", 2),
        (1, "c", "string", 1),
    ]


def test_distinct_profile_counts_null_and_lists_short_columns(spark):
    rows = [(i, i % 3, None if i % 2 else "x", 0.0 if i % 2 else -0.0) for i in range(40)]
    frame = spark.createDataFrame(rows, "id int, three int, half string, zero double")
    found = {r["column"]: (r["num_unique"], r["values"]) for r in profiling.distinct_profile(frame).collect()}
    assert found == {
        "id": (40, None),
        "three": (3, "0, 1, 2"),
        "half": (2, "<null>, x"),
        "zero": (1, "0.0"),
    }


@pytest.mark.parametrize("spread", [1, 7, 10**9])
def test_distinct_whole_numbers(spark, spread):
    items = [None, *[i * spread - 50_000 for i in range(70_000)]] * 2
    frame = spark.createDataFrame([(v,) for v in items], "v bigint").repartition(4)
    dense, nulls = profiling._dense_columns(frame, ["v"])
    assert (dense, nulls) == (["v"] if spread < 100 else [], {"v": 1})
    row = profiling.distinct_profile(frame).first()
    assert (row["num_unique"], row["values"]) == (70_001, None)


def test_distinct_whole_numbers_at_the_ends(spark):
    ends = [-(2**63), 2**63 - 1, 0, -1, 1, 32_768, 32_769, -32_768, -32_769]
    frame = spark.createDataFrame([(v, v % 100 - 50) for v in ends], "v bigint, small int")
    found = {r["column"]: r["num_unique"] for r in profiling.distinct_profile(frame).collect()}
    assert found == {"v": 9, "small": len({v % 100 for v in ends})}


def test_distinct_profile_of_an_empty_frame(spark):
    frame = spark.createDataFrame([], "a int, b string")
    assert [tuple(r) for r in profiling.distinct_profile(frame).collect()] == [
        ("a", 0, None),
        ("b", 0, None),
    ]


def test_value_counts_order(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("a",), ("c",), (None,)], "k string")
    assert [tuple(r) for r in profiling.value_counts(frame, "k").collect()] == [
        ("a", 2), ("b", 1), ("c", 1),
    ]


def test_histogram_matches_numpy(spark):
    rng = random.Random(2)
    items = [rng.random() ** 3 for _ in range(2000)]
    rows = profiling.histogram(doubles(spark, items + [None, float("nan")]), "x").orderBy("bin").collect()
    counts, edges = np.histogram(items, bins=30)
    assert [r["count"] for r in rows] == list(counts)
    assert [r["bin_start"] for r in rows] == pytest.approx(list(edges[:-1]))
    assert sum(r["count"] for r in rows) == len(items)


@pytest.mark.parametrize("bins", [7, 10, 30, 33])
def test_histogram_of_values_on_borders(spark, bins):
    items = [i * 0.1 for i in range(100)] + [i / 3 for i in range(31)]
    rows = profiling.histogram(doubles(spark, items), "x", bins).orderBy("bin").collect()
    assert [r["count"] for r in rows] == list(np.histogram(items, bins=bins)[0])


def test_histogram_edges(spark):
    constant = profiling.histogram(doubles(spark, [5.0, 5.0]), "x").collect()
    assert [(r["bin"], r["count"]) for r in constant] == [(0, 2)]
    top = profiling.histogram(doubles(spark, [0.0, 1.0, 10.0]), "x", bins=10).orderBy("bin").collect()
    assert [r["count"] for r in top] == [1, 1, 0, 0, 0, 0, 0, 0, 0, 1]


def test_density_matches_direct_sum(spark):
    rng = random.Random(4)
    items = np.array([rng.gauss(0, 1) for _ in range(300)] + [40.0])
    rows = profiling.density(doubles(spark, items.tolist()), "x", points=50).orderBy("point").collect()
    h = items.std(ddof=1) * len(items) ** -0.2
    grid = np.linspace(items.min(), items.max(), 50)
    kernel = np.exp(-0.5 * ((grid[:, None] - items[None, :]) / h) ** 2)
    expected = kernel.sum(axis=1) / (len(items) * h * math.sqrt(2 * math.pi))
    assert [r["x"] for r in rows] == pytest.approx(list(grid))
    assert [r["density"] for r in rows] == pytest.approx(list(expected), rel=1e-9, abs=1e-12)
    assert profiling.density(doubles(spark, [1.0, 1.0]), "x").isEmpty()


def test_density_shuffles_cells_and_not_values(spark):
    rng = random.Random(5)
    items = [rng.gauss(0, 1) for _ in range(20_000)] + [1e4, -1e4]
    frame = doubles(spark, items).repartition(4)
    rows = profiling.density(frame, "x", points=64).orderBy("point").collect()
    values = np.array(items)
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 64)
    kernel = np.exp(-0.5 * ((grid[:, None] - values[None, :]) / h) ** 2).sum(axis=1)
    expected = kernel / (len(values) * h * math.sqrt(2 * math.pi))
    assert [r["density"] for r in rows] == pytest.approx(list(expected), abs=1e-13)
    plan = profiling.density(frame, "x")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [cell#" in plan and "Aggregate [v#" not in plan
