"""Test tables in the shape of the health and abstract frames.

``health`` is an inner star join around ``lineitem``; Spark orders and implements the joins from
file sizes and shuffle sizes, and each query prunes it to the columns it uses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.schemas import HEALTH_SCHEMA

LABELS = ["economy", "promo", "small", "medium"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _whole(column: str) -> Column:
    return F.col(column).cast("int")


def _float(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("float")


def health(spark: SparkSession, sf_dir: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """The 22 health columns; ``keys`` adds columns of the base tables."""
    # Order attributes meet first, so that lineitem moves once for all of them. Lineitem and orders
    # both grow with the data: that join shuffles whatever the sizes are, so that work after it is
    # spread, and adaptive execution may split a hot key. The other sides are broadcast if small.
    buyers = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = table(spark, sf_dir, "orders").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    columns = {
        "Country": F.col("n_name"),
        "Year": F.year("o_orderdate"),
        "Disease_Name": F.col("p_brand"),
        "Disease_Category": F.col("p_type"),
        "Prevalence_Rate_Percent": _float("l_discount"),
        "Incidence_Rate_Percent": _float("l_tax"),
        "Mortality_Rate_Percent": _float("l_quantity"),
        "Age_Group": F.col("o_orderpriority"),
        "Gender": F.col("l_linestatus"),
        "Population_Affected": _whole("l_extendedprice"),
        "Healthcare_Access_Percent": _float(F.col("l_discount") * 100),
        "Doctors_per_1000": _float("p_size"),
        "Hospital_Beds_per_1000": _float("l_linenumber"),
        "Treatment_Type": F.col("l_returnflag"),
        "Average_Treatment_Cost_USD": _whole("p_retailprice"),
        "Availability_of_Vaccines_Treatment": F.col("o_orderstatus"),
        "Recovery_Rate_Percent": _float("o_totalprice"),
        "DALYs": _float("l_extendedprice"),
        "Improvement_in_5_Years_Percent": _float(F.col("l_tax") * 100),
        "Per_Capita_Income_USD": _whole("c_acctbal"),
        "Education_Index": _float("s_acctbal"),
        "Urbanization_Rate_Percent": _float("p_retailprice"),
    }
    return joined.select(
        *keys, *[columns[name].alias(name) for name in HEALTH_SCHEMA.names]
    )


HEALTH_SQL = """
health AS (
  SELECT l_orderkey, l_partkey, l_suppkey,
    n_name AS Country,
    CAST(year(o_orderdate) AS INTEGER) AS Year,
    p_brand AS Disease_Name,
    p_type AS Disease_Category,
    CAST(l_discount AS FLOAT) AS Prevalence_Rate_Percent,
    CAST(l_tax AS FLOAT) AS Incidence_Rate_Percent,
    CAST(l_quantity AS FLOAT) AS Mortality_Rate_Percent,
    o_orderpriority AS Age_Group,
    l_linestatus AS Gender,
    CAST(trunc(l_extendedprice) AS INTEGER) AS Population_Affected,
    CAST(l_discount * 100 AS FLOAT) AS Healthcare_Access_Percent,
    CAST(p_size AS FLOAT) AS Doctors_per_1000,
    CAST(l_linenumber AS FLOAT) AS Hospital_Beds_per_1000,
    l_returnflag AS Treatment_Type,
    CAST(trunc(p_retailprice) AS INTEGER) AS Average_Treatment_Cost_USD,
    o_orderstatus AS Availability_of_Vaccines_Treatment,
    CAST(o_totalprice AS FLOAT) AS Recovery_Rate_Percent,
    CAST(l_extendedprice AS FLOAT) AS DALYs,
    CAST(l_tax * 100 AS FLOAT) AS Improvement_in_5_Years_Percent,
    CAST(trunc(c_acctbal) AS INTEGER) AS Per_Capita_Income_USD,
    CAST(s_acctbal AS FLOAT) AS Education_Index,
    CAST(p_retailprice AS FLOAT) AS Urbanization_Rate_Percent
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
)"""


def abstracts(spark: SparkSession, sf_dir: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Documents with one of four labels."""
    label = F.element_at(
        F.array(*[F.lit(name) for name in LABELS]), (F.col("doc_id") % 4 + 1).cast("int")
    )
    return table(spark, sf_dir, "documents").select(*keys, "text", label.alias("label"))


ABSTRACTS_SQL = """
abstracts AS (
  SELECT doc_id, text,
    CASE doc_id % 4 WHEN 0 THEN 'economy' WHEN 1 THEN 'promo' WHEN 2 THEN 'small' ELSE 'medium' END
      AS label
  FROM documents
)"""


def rounded(df: DataFrame, digits: int = 6, **only: int) -> DataFrame:
    """Fractions as doubles, rounded: the last bits of sums depend on the order of the rows."""
    return df.select(
        [
            F.round(F.col(name).cast("double"), only.get(name, digits)).alias(name)
            if kind in ("double", "float")
            else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def health_columns_sql(names: list[str], digits: int = 4) -> str:
    """SQL select list for health columns, floats rounded as ``rounded`` does."""
    kinds = {field.name: field.dataType.simpleString() for field in HEALTH_SCHEMA}
    return ", ".join(
        f"round(CAST({name} AS DOUBLE), {digits}) AS {name}" if kinds.get(name) == "float" else name
        for name in names
    )
