"""Follow-up questions over the marts: lookups, trends, peaks and display frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.functions.display import fixed_percent, flag_url, thousands, two_decimals

# Metrics offered for plotting, and the preferred default country.
TREND_METRICS = [
    "Global_Avg_Mortality_Rate_Percent",
    "Global_Avg_DALYs",
    "Global_Total_Population_Affected",
]
PREFERRED_COUNTRY = "United States"

PEAK_AGGREGATES = {"sum": F.sum, "avg": F.avg, "max": F.max}


def lookup(df: DataFrame, column: str, value: object) -> DataFrame:
    """P10: rows where ``column`` equals a value; the literal is pushed down to the scan."""
    return df.filter(F.col(column) == F.lit(value))


def yearly_trends(df: DataFrame) -> DataFrame:
    """The whole yearly mart in key order."""
    return df.orderBy("Year", "Disease_Category")


def country_trend(
    details: DataFrame, country: str, measure: str = "Mortality_Rate_Percent"
) -> DataFrame:
    """A5: one country's average of a measure by year and category."""
    return (
        lookup(details, "Country", country)
        .groupBy("Year", "Disease_Category")
        .agg(F.avg(measure).alias("avg_mortality"))
        .orderBy("Year", "Disease_Category")
    )


def peak_year(df: DataFrame, metric: str, how: str, year: str = "Year") -> DataFrame:
    """The year whose ``how`` of the metric is largest, and that value.

    ``how`` is ``sum``, ``avg`` or ``max``. The earliest year wins a tie.
    """
    per_year = df.groupBy(year).agg(PEAK_AGGREGATES[how](metric).alias("value"))
    best = F.max(F.struct("value", (-F.col(year)).alias("minus_year"))).alias("best")
    return (
        per_year.filter(F.col("value").isNotNull() & F.col(year).isNotNull())
        .agg(best)
        .select((-F.col("best.minus_year")).alias("peak_year"), F.col("best.value").alias("value"))
    )


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows per label."""
    return df.groupBy(label).agg(F.count("*").alias("count"))


def default_value(df: DataFrame, column: str, preferred: str = PREFERRED_COUNTRY) -> DataFrame:
    """``preferred`` if it occurs, else the first value in order."""
    return (
        df.select(column)
        .filter(F.col(column).isNotNull())
        .distinct()
        .orderBy(F.col(column) != preferred, column)
        .limit(1)
    )


def metric_series(df: DataFrame, metric: str) -> DataFrame:
    """P20: one of the offered metrics by year and category."""
    if metric not in TREND_METRICS:
        raise ValueError(f"metric must be one of {TREND_METRICS}, not {metric!r}")
    return df.select("Year", "Disease_Category", F.col(metric).alias("value"))


def summary_long(df: DataFrame, id_column: str = "Country") -> DataFrame:
    """One row per summary metric, all values as doubles."""
    metrics = [name for name in df.columns if name != id_column]
    doubles = df.select(id_column, *[F.col(name).cast("double").alias(name) for name in metrics])
    return doubles.unpivot([id_column], metrics, "metric", "value")


def kpi_display(df: DataFrame) -> DataFrame:
    """The headline numbers of a country summary as display text."""
    return df.select(
        "Country",
        fixed_percent(F.col("Avg_Mortality_Rate_Percent")).alias("mortality_rate"),
        fixed_percent(F.col("Avg_Healthcare_Access_Percent")).alias("healthcare_access"),
        thousands(F.col("Avg_DALYs")).alias("dalys"),
        two_decimals(F.col("Avg_Doctors_per_1000")).alias("doctors_per_1000"),
        thousands(F.col("Total_Population_Affected_Overall")).alias("population_affected"),
        F.concat(F.lit("$"), thousands(F.col("Avg_Per_Capita_Income_USD"))).alias("income"),
    )


def peak_display(peak: DataFrame, style: str) -> DataFrame:
    """A peak as display text: ``count``, ``percent`` or ``countries``."""
    styles: dict[str, Column] = {
        "count": thousands(F.col("value")),
        "percent": fixed_percent(F.col("value")),
        "countries": F.concat(F.col("value").cast("bigint").cast("string"), F.lit(" countries")),
    }
    return peak.select("peak_year", styles[style].alias("display"))


def with_flag_url(df: DataFrame, prefix: str, name: str = "Country") -> DataFrame:
    """Add the URL of the flag image of each country."""
    return df.withColumn("Flag_URL", flag_url(F.col(name), prefix))
