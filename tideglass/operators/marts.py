"""Gold marts over Silver frames.

Every grouping has partial aggregates, so a group shrinks to one row per map task before its
shuffle; distinct counts go through one row per (group, value) and so spread a large group too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Measures averaged per country, and renames of the detail mart.
AVERAGED = [
    "Mortality_Rate_Percent",
    "DALYs",
    "Prevalence_Rate_Percent",
    "Incidence_Rate_Percent",
    "Healthcare_Access_Percent",
    "Doctors_per_1000",
    "Hospital_Beds_per_1000",
    "Average_Treatment_Cost_USD",
    "Recovery_Rate_Percent",
    "Per_Capita_Income_USD",
    "Education_Index",
    "Urbanization_Rate_Percent",
]
DETAILS = {
    "Country": "Country",
    "Year": "Year",
    "Disease_Name": "Disease_Name",
    "Disease_Category": "Disease_Category",
    "Mortality_Rate_Percent": "Mortality_Rate_Percent",
    "DALYs": "DALYs",
    "Prevalence_Rate_Percent": "Prevalence_Rate_Percent",
    "Incidence_Rate_Percent": "Incidence_Rate_Percent",
    "Population_Affected": "Population_Affected",
    "Healthcare_Access_Percent": "Healthcare_Access_Percent_CountryYear",
    "Per_Capita_Income_USD": "Per_Capita_Income_USD_CountryYear",
    "Education_Index": "Education_Index_CountryYear",
}


def country_health_summary(
    df: DataFrame,
    country: str = "Country",
    year: str = "Year",
    population: str = "Population_Affected",
    averaged: list[str] = AVERAGED,
) -> DataFrame:
    """A1: averages, total population and year coverage per country."""
    return df.groupBy(country).agg(
        *[F.avg(name).alias(f"Avg_{name}") for name in averaged],
        F.sum(population).alias("Total_Population_Affected_Overall"),
        F.count_distinct(year).alias("Num_Years_Data"),
        F.min(year).alias("First_Year_Data"),
        F.max(year).alias("Last_Year_Data"),
    )


def yearly_disease_category_summary(
    df: DataFrame,
    year: str = "Year",
    category: str = "Disease_Category",
    country: str = "Country",
) -> DataFrame:
    """A2/O1: yearly averages and totals per category, in key order."""
    return (
        df.groupBy(year, category)
        .agg(
            F.avg("Mortality_Rate_Percent").alias("Global_Avg_Mortality_Rate_Percent"),
            F.avg("DALYs").alias("Global_Avg_DALYs"),
            F.sum("Population_Affected").alias("Global_Total_Population_Affected"),
            F.count_distinct(country).alias("Num_Countries_Reported"),
        )
        .orderBy(year, category)
    )


def country_disease_yearly_details(
    df: DataFrame, columns: dict[str, str] = DETAILS
) -> DataFrame:
    """The detail mart, a projection with renames."""
    return df.select([F.col(source).alias(name) for source, name in columns.items()])


def disease_abstract_counts(
    df: DataFrame,
    label: str = "label",
    key: str = "record_hash",
    approx: float | None = None,
    unique: bool = False,
) -> DataFrame:
    """Distinct documents per label, largest first.

    ``approx`` is a relative error: a sketch then replaces the shuffle of all fingerprints. Of a
    table with one row per fingerprint (``unique``) rows are counted, which needs no such shuffle.
    """
    count = F.count_distinct(key) if approx is None else F.approx_count_distinct(key, approx)
    if unique:
        count = F.count(key)
    return (
        df.groupBy(F.col(label).alias("Disease_Category"))
        .agg(count.alias("Abstract_Count"))
        .orderBy(F.desc("Abstract_Count"), "Disease_Category")
    )


def category_impact(df: DataFrame, category: str = "Disease_Category") -> DataFrame:
    """A4: total population and average mortality per category."""
    return df.groupBy(F.col(category).alias("Disease_Category")).agg(
        F.sum("Population_Affected").alias("Total_Population_Affected"),
        F.avg("Mortality_Rate_Percent").alias("Avg_Mortality_Rate"),
    )


def disease_impact_vs_research(
    health: DataFrame, counts: DataFrame, normalize: bool = False
) -> DataFrame:
    """Category impact with document counts; a category without documents keeps null.

    Keys must be equal as they are, or after trim and lower case with ``normalize``. Both inputs
    are aggregates with a row per category; adaptive execution broadcasts the measured smaller one.
    """
    return impact_with_counts(category_impact(health), counts, normalize)


def impact_with_counts(
    impact: DataFrame, counts: DataFrame, normalize: bool = False
) -> DataFrame:
    """J1 from a category impact that is there already."""
    impact = impact.withColumn("_key", _key("Disease_Category", normalize))
    per_key = counts.groupBy(_key("Disease_Category", normalize).alias("_key")).agg(
        F.sum("Abstract_Count").alias("Abstract_Count")
    )
    return (
        impact.join(per_key, "_key", "left")
        .select(
            "Disease_Category",
            "Total_Population_Affected",
            "Avg_Mortality_Rate",
            "Abstract_Count",
        )
        .orderBy(F.desc("Total_Population_Affected"), "Disease_Category")
    )


def _key(column: str, normalize: bool) -> Column:
    return F.lower(F.trim(F.col(column))) if normalize else F.col(column)
