import hashlib
import random

from pyspark.sql import functions as F

from tideglass.operators import dedup
from tideglass.plans.silver import hashed_health, to_silver_health
from tideglass.schemas import HEALTH_IDENTITY, HEALTH_SCHEMA, RAW_HEALTH_HEADERS


def test_faithful_hash_skips_nulls_and_null_safe_does_not(spark):
    rows = [("a", None, "b"), ("a", "b", None), ("a||b", None, None)]
    frame = spark.createDataFrame(rows, "x string, y string, z string")
    faithful = dedup.with_record_hash(frame, ["x", "y", "z"]).collect()
    assert {r["record_hash"] for r in faithful} == {hashlib.sha256(b"a||b").hexdigest()}
    safe = dedup.with_record_hash(frame, ["x", "y", "z"], null_safe=True)
    assert safe.select("record_hash").distinct().count() == 3


def raw_rows(spark, rows):
    base = dict.fromkeys(RAW_HEALTH_HEADERS, "1")
    data = [tuple({**base, **row}[h] for h in RAW_HEALTH_HEADERS) for row in rows]
    return spark.createDataFrame(data, [*RAW_HEALTH_HEADERS])


def test_first_row_in_order_survives(spark):
    frame = raw_rows(spark, [{"DALYs": "30"}, {"DALYs": "10"}, {"DALYs": "20"}, {"Year": "2"}])
    silver = to_silver_health(frame)
    assert silver.columns == [*HEALTH_SCHEMA.names, "record_hash"]
    assert sorted((r["Year"], r["DALYs"]) for r in silver.collect()) == [(1, 10.0), (2, 1.0)]


def test_dedup_is_idempotent_and_layout_free(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    hashed = dedup.with_record_hash(rows, ["l_orderkey", "l_linenumber"])
    once = dedup.dedup(hashed, order_by=rows.columns)
    twice = dedup.dedup(once, order_by=rows.columns)
    shuffled = dedup.dedup(hashed.repartition(13), order_by=rows.columns)
    expected = sorted(map(tuple, once.collect()))
    assert sorted(map(tuple, twice.collect())) == expected
    assert sorted(map(tuple, shuffled.collect())) == expected
    assert dedup.dedup(hashed).count() == len(expected)


def test_fingerprint_held_by_a_third_of_the_rows(spark):
    rng = random.Random(5)
    rows = [("hot", rng.randint(0, 10**6)) for _ in range(3000)]
    rows += [(f"k{i % 2000}", rng.randint(0, 10**6)) for i in range(6000)]
    frame = spark.createDataFrame(rows, "record_hash string, v int").repartition(16)
    expected: dict[str, int] = {}
    for key, value in rows:
        expected[key] = min(value, expected.get(key, value))
    result = dedup.dedup(frame, order_by=["v"])
    assert {r["record_hash"]: r["v"] for r in result.collect()} == expected
    # Copies collapse before the exchange.
    plan = result._jdf.queryExecution().sparkPlan().toString()
    assert "partial_min" in plan


def test_distinct_values_sorted(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("b",)], "x string")
    assert [r["x"] for r in dedup.distinct_values(frame, "x").collect()] == ["a", "b"]


def test_split_is_disjoint_complete_and_layout_free(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    first, second = dedup.split_rows(orders, ["o_orderkey", "o_totalprice"], 80)
    a = {r["o_orderkey"] for r in first.collect()}
    b = {r["o_orderkey"] for r in second.collect()}
    assert not a & b and len(a) + len(b) == orders.count()
    assert 0.7 < len(a) / orders.count() < 0.9
    again, _ = dedup.split_rows(orders.repartition(7), ["o_orderkey", "o_totalprice"], 80)
    assert {r["o_orderkey"] for r in again.collect()} == a
    assert "Exchange" not in first._jdf.queryExecution().executedPlan().toString()


def test_split_keeps_rows_with_null_keys(spark):
    frame = spark.createDataFrame([(None,), ("a",), ("b",)], "k string")
    first, second = dedup.split_rows(frame, ["k"], 50)
    assert first.count() + second.count() == 3


def test_sample_is_part_of_the_rows(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    share = dedup.sample_rows(orders, ["o_orderkey"], 10).count() / orders.count()
    assert 0.05 < share < 0.15


def test_identity_columns_are_hashed_after_typing(spark):
    spaced = raw_rows(spark, [{"Year": " 1 "}, {"Year": "1.9"}])
    hashes = hashed_health(spaced).select("record_hash").distinct()
    assert hashes.count() == 1
    assert set(HEALTH_IDENTITY) <= set(HEALTH_SCHEMA.names)
    assert hashed_health(spaced).filter(F.col("Year") == 1).count() == 2


def test_keys_of_any_text_stay_apart_and_fingerprints_are_grouped_by_bytes(spark):
    keys = ["ab", "AB", "aB", "abc", "0abc", "", None, "no hex", "00", "0", "ÿ" * 2, "ab "]
    rows = [(key, n) for key in keys for n in (2, 1)]
    df = spark.createDataFrame(rows, "record_hash string, n int")
    kept = dedup.dedup(df, order_by=["n"])
    assert kept.schema["record_hash"].dataType == df.schema["record_hash"].dataType
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(key, 1) for key in keys], key=str)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(" in plan and "hashpartitioning(record_hash" not in plan
