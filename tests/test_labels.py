"""Labels of wide columns and salted joins."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tideglass.operators import features, labels, salted


def rows(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id long, v string").repartition(5)


def test_label_index_equals_the_string_indexer(spark):
    draw = random.Random(1)
    values = [f"w{min(int(draw.expovariate(0.02)), 400):03d}" for _ in range(3000)] + [None] * 5
    frame = rows(spark, values)
    table = labels.label_index(frame, "v")
    counts = Counter(v for v in values if v is not None)
    order = sorted(counts, key=lambda v: (-counts[v], v))
    assert {r["v"]: r["index"] for r in table.collect()} == {v: float(i) for i, v in enumerate(order)}
    spark_ml = features.string_indexer(["v"]).fit(frame)
    asked = rows(spark, [*values, "unseen"])
    ours = labels.with_label_index(asked, table, "v", "ours")
    both = spark_ml.transform(ours)
    assert both.where("ours <> v_index OR ours IS NULL").count() == 0
    assert both.count() == len(values) + 1


def test_no_values_and_no_rows(spark):
    empty = rows(spark, [None, None])
    table = labels.label_index(empty, "v")
    assert table.collect() == []
    assert {r["v_index"] for r in labels.with_label_index(empty, table, "v").collect()} == {0.0}
    assert labels.with_label_index(empty.where("false"), table, "v").collect() == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_is_the_join(spark, how):
    values = ["hot"] * 700 + [f"k{i % 90}" for i in range(900)] + ["other"] * 400 + [None] * 30
    left = rows(spark, values).withColumn("salt", F.lit("mine"))
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("other", 3), *[(f"k{i}", i) for i in range(0, 90, 2)], (None, 9)],
        "v string, hot int",
    )
    ours = salted.salted_join(left, right, "v", how)
    plain = left.join(right, "v", how)
    assert ours.columns == plain.columns
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, plain.collect()))
    assert {r["v"] for r in salted.hot_keys(left, "v").collect()} == {"hot", "other"}
    with pytest.raises(ValueError):
        salted.salted_join(left, right, "v", "right")


def test_a_hot_key_is_spread_also_against_an_aggregate(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = rows(spark, ["hot"] * 3000 + [f"k{i}" for i in range(6000)])
        summary = left.groupBy("v").agg(F.count("*").alias("n"))

        def largest(joined):
            parts = joined.select(F.spark_partition_id().alias("p")).groupBy("p").count()
            return parts.agg(F.max("count")).first()[0]

        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert largest(left.join(summary, "v")) >= 3000
        assert largest(salted.salted_join(left, summary, "v")) < 1500
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for k, v in before.items():
            spark.conf.set(k, v)
