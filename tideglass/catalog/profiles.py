"""Profile queries over the base tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.catalog.registry import query
from tideglass.catalog.views import rounded, table
from tideglass.operators import profiling

_MEASURES = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
]


@query(
    "describe_numeric",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count({name}) AS count,
          round(avg({name}), 6) AS mean, round(stddev_samp({name}), 6) AS std,
          round(CAST(min({name}) AS DOUBLE), 6) AS min,
          round(quantile_cont(CAST({name} AS DOUBLE), 0.25), 6) AS q25,
          round(quantile_cont(CAST({name} AS DOUBLE), 0.5), 6) AS q50,
          round(quantile_cont(CAST({name} AS DOUBLE), 0.75), 6) AS q75,
          round(CAST(max({name}) AS DOUBLE), 6) AS max FROM lineitem"""
        for name in _MEASURES
    ),
)
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profiling.describe_numeric(table(spark, sf_dir, "lineitem"), _MEASURES))


_ORDER_COLUMNS = [
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
]


@query(
    "column_info",
    " UNION ALL ".join(
        f"""SELECT {position} AS position, '{name}' AS "column", '{kind}' AS type,
        count({name}) AS non_null FROM orders"""
        for position, (name, kind) in enumerate(_ORDER_COLUMNS)
    ),
)
def column_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.column_info(table(spark, sf_dir, "orders"))


_PROFILED = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query(
    "distinct_profile",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count(DISTINCT {name}) + max(CASE WHEN {name} IS NULL
          THEN 1 ELSE 0 END) AS num_unique,
        CASE WHEN count(DISTINCT {name}) < 30 THEN
          string_agg(DISTINCT coalesce(CAST({name} AS VARCHAR), '<null>'), ', '
            ORDER BY coalesce(CAST({name} AS VARCHAR), '<null>')) END AS "values"
        FROM (SELECT * REPLACE (CASE WHEN event_id % 9 <> 0 THEN event_type END AS event_type)
          FROM events)"""
        for name in _PROFILED
    ),
)
def distinct_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn(
        "event_type", F.when(F.col("event_id") % 9 != 0, F.col("event_type"))
    )
    return profiling.distinct_profile(rows, _PROFILED)


@query(
    "value_counts",
    "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY o_orderpriority",
)
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.value_counts(table(spark, sf_dir, "orders"), "o_orderpriority")


@query(
    "histogram",
    """WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
        (max(l_extendedprice) - min(l_extendedprice)) / 30.0::DOUBLE AS w FROM lineitem),
    counted AS (SELECT CAST(least(floor((l_extendedprice - lo) / w), 29) AS INTEGER) AS bin,
        count(*) AS n FROM lineitem, b GROUP BY 1)
    SELECT CAST(i AS INTEGER) AS bin, round(lo + i * w, 6) AS bin_start,
      round(lo + (i + 1) * w, 6) AS bin_end, coalesce(n, 0) AS count
    FROM range(30) AS r(i), b LEFT JOIN counted ON counted.bin = i""",
)
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profiling.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice"))


@query(
    "density",
    """WITH s AS (SELECT count(*) AS n, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
        stddev_samp(l_extendedprice) * pow(count(*), -0.2::DOUBLE) AS h FROM lineitem),
    v AS (SELECT l_extendedprice AS v, count(*) AS w FROM lineitem GROUP BY 1),
    grid AS (SELECT i, lo + i * ((hi - lo) / 199.0::DOUBLE) AS x FROM range(200) AS r(i), s),
    summed AS (SELECT i, x, sum(w * exp(-0.5::DOUBLE * pow((x - v) / h, 2))) AS total
      FROM grid, v, s GROUP BY i, x)
    SELECT CAST(i AS INTEGER) AS point, round(x, 6) AS x,
      round(total / (n * h * sqrt(2 * pi())), 12) AS density,
      round(total / (n * h * sqrt(2 * pi())) * n * (hi - lo) / 30, 6) AS curve
    FROM summed, s""",
)
def density(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = table(spark, sf_dir, "lineitem").select("l_extendedprice")
    curve = profiling.density(values, "l_extendedprice")
    return rounded(curve, 6, density=12)
