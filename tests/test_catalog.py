"""Every query against its SQL twin, and the shape of the plans."""

import compare
import pytest

import __spark_entry__ as contract
from tideglass import catalog
from tideglass.catalog.views import health
from tideglass.operators import lookups, marts

SLOW = {"train_and_score", "feature_importance"}
QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="session")
def connection(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf_dir, connection, name):
    assert compare.difference(QUERIES[name](spark, sf_dir), connection, SQL[name]) is None


def test_contract():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


EAGER_OR_STREAM = SLOW | {name for name in QUERIES if name.startswith("stream_")}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER_OR_STREAM))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("ArrowEvalPython", "BatchEvalPython", "InPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert node not in text


def test_marts_read_only_their_columns(spark, sf_dir, tmp_path):
    path = str(tmp_path / "silver")
    health(spark, sf_dir).write.parquet(path)
    silver = spark.read.parquet(path)
    text = plan(marts.category_impact(silver))
    assert (
        "ReadSchema: struct<Disease_Category:string,Mortality_Rate_Percent:float,"
        "Population_Affected:int>" in text
    )
    trend = plan(lookups.country_trend(marts.country_disease_yearly_details(silver), "NATION_1"))
    assert "EqualTo(Country,NATION_1)" in trend
    assert "DALYs" not in trend


def test_distinct_counts_use_no_expand(spark, sf_dir):
    assert "Expand" not in plan(marts.country_health_summary(health(spark, sf_dir)))
