"""A third of the rows on one key: the plans split it and the results stay whole."""

import os

import compare
import pytest
from pyspark.sql import functions as F

from tideglass.catalog import health as queries
from tideglass.catalog.registry import oracle_sql
from tideglass.catalog.views import health
from tideglass.operators import marts, scenarios

SMALL = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "5k",
}


@pytest.fixture(scope="module")
def hot_dir(spark, sf_dir, tmp_path_factory):
    """Tables in which one order and one part have a third of the line items each."""
    folder = tmp_path_factory.mktemp("hot")
    for name in compare.TABLES:
        if name != "lineitem":
            os.symlink(f"{sf_dir}/{name}.parquet", folder / f"{name}.parquet")
    third = F.pmod(F.xxhash64("l_extendedprice", "l_shipdate"), F.lit(3))
    hot = lambda n, key: F.when(third == n, F.lit(1).cast("bigint")).otherwise(F.col(key))
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    path = str(folder / "parts")
    rows.repartition(8).withColumns(
        {"l_orderkey": hot(0, "l_orderkey"), "l_partkey": hot(1, "l_partkey")}
    ).write.parquet(path)
    os.symlink(path, folder / "lineitem.parquet")
    return str(folder)


@pytest.fixture
def small_limits(spark):
    before = {key: spark.conf.get(key, None) for key in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def connection(hot_dir):
    connection = compare.connect(hot_dir)
    connection.execute(
        f"CREATE OR REPLACE VIEW lineitem AS SELECT * FROM read_parquet('{hot_dir}/parts/*.parquet')"
    )
    return connection


def final_plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[: text.find("== Initial Plan")]


@pytest.mark.parametrize("name", ["country_health_summary", "silver_health_count", "peak_population"])
def test_hot_order_and_part(spark, hot_dir, connection, small_limits, name):
    df = getattr(queries, name)(spark, hot_dir)
    assert compare.difference(df, connection, oracle_sql()[name]) is None
    assert "SortMergeJoin(skew=true) [l_orderkey" in final_plan(df)


@pytest.mark.parametrize("stored", [False, True])
def test_hot_country_in_scenarios(spark, sf_dir, small_limits, tmp_path, stored):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "NATION_1")
        .otherwise(F.concat(F.lit("NATION_"), (F.col("id") % 25).cast("string")))
        .alias("Country"),
        *[F.lit("x").alias(n) for n in ("Disease_Category", "Age_Group", "Gender")],
        F.lit(2010).alias("Year"),
        F.rand(1).alias("Incidence_Rate_Percent"),
        F.col("id").cast("double").alias("DALYs"),
    )
    summary = marts.country_health_summary(health(spark, sf_dir))
    if stored:
        summary.write.parquet(str(tmp_path / "summary"))
        summary = spark.read.parquet(str(tmp_path / "summary"))
    requests = scenarios.enrich_scenarios(rows, summary)
    assert len(requests.collect()) == 30000
    rejected = scenarios.reject_scenarios(rows, summary.filter("Country != 'NATION_1'"))
    assert len(rejected.collect()) == rows.filter("Country = 'NATION_1'").count()
    if stored:
        assert "SortMergeJoin(skew=true) [Country" in final_plan(requests)
        assert "SortMergeJoin(skew=true) [Country" in final_plan(rejected)
