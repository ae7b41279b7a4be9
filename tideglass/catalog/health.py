"""Silver, Gold and lookup queries over the health frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.catalog.registry import query
from tideglass.catalog.views import (
    ABSTRACTS_SQL,
    HEALTH_SQL,
    abstracts,
    health,
    health_columns_sql,
    rounded,
    table,
)
from tideglass.operators import cleaning, dedup, lookups, marts, scenarios
from tideglass.plans.silver import hashed_abstracts, to_silver_abstracts, to_silver_health
from tideglass.schemas import (
    CATEGORICAL_FEATURES,
    HEALTH_IDENTITY,
    HEALTH_REQUIRED,
    HEALTH_SCHEMA,
    NUMERIC_FEATURES,
    RAW_HEALTH_HEADERS,
    TARGET,
)

COUNTRY = "NATION_7"
FLAG_PREFIX = "https://flags.example/"

# --- Silver ---------------------------------------------------------------------------------


def raw_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The health frame as it arrives: all text, under the raw headers."""
    typed = health(spark, sf_dir)
    text = typed.select([F.col(name).cast("string").alias(name) for name in typed.columns])
    return text.toDF(*RAW_HEALTH_HEADERS)


def raw_health_waves(spark: SparkSession, sf_dir: str, waves: int = 2) -> list[DataFrame]:
    """The rows of ``raw_health`` in frames by order, so that the joins of one of them alone are on disk
    while it is written."""
    typed = health(spark, sf_dir, ("l_orderkey",))
    own = F.pmod(F.xxhash64("l_orderkey"), F.lit(waves))
    text = [F.col(name).cast("string").alias(raw) for name, raw in zip(HEALTH_SCHEMA.names, RAW_HEALTH_HEADERS)]
    return [typed.where(own == wave).select(text) for wave in range(waves)]


_CLEAN_AGE = r"regexp_replace(Age_Group, '[^0-9\-+\s]', '', 'g')"
_IDENTITY_TEXT = ", ".join(f"CAST({name} AS VARCHAR)" for name in HEALTH_IDENTITY)
_SCHEMA_ORDER = ", ".join(f"{name} NULLS FIRST" for name in HEALTH_SCHEMA.names)
SILVER_SQL = f"""
cleaned AS (
  SELECT * REPLACE ({_CLEAN_AGE} AS Age_Group) FROM health
  WHERE Country IS NOT NULL AND Year IS NOT NULL AND Disease_Name IS NOT NULL
),
hashed AS (
  SELECT *, sha256(concat_ws('||', {_IDENTITY_TEXT})) AS record_hash FROM cleaned
),
silver AS (
  SELECT * FROM hashed
  QUALIFY row_number() OVER (PARTITION BY record_hash ORDER BY {_SCHEMA_ORDER}) = 1
)"""


@query(
    "silver_health",
    f"""WITH {HEALTH_SQL}, {SILVER_SQL}
    SELECT {health_columns_sql(HEALTH_SCHEMA.names)}, record_hash FROM silver""",
)
def silver_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(to_silver_health(raw_health(spark, sf_dir)), 4)


@query(
    "silver_health_count",
    f"""WITH {HEALTH_SQL}, {SILVER_SQL}
    SELECT Country, count(*) AS n_rows, CAST(sum(Population_Affected) AS BIGINT) AS population
    FROM silver GROUP BY Country""",
)
def silver_health_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        to_silver_health(raw_health(spark, sf_dir))
        .groupBy("Country")
        .agg(
            F.count("*").alias("n_rows"),
            F.sum("Population_Affected").alias("population"),
        )
    )


ABSTRACT_SILVER_SQL = r"""
cleaned_abstracts AS (
  SELECT trim(text, ' ') AS text, trim(lower(label), ' ') AS label FROM abstracts
),
silver_abstracts AS (
  SELECT DISTINCT text, label, sha256(concat_ws('||', text, label)) AS record_hash
  FROM cleaned_abstracts WHERE text <> '' AND label <> ''
)"""


@query(
    "silver_abstracts",
    f"""WITH {ABSTRACTS_SQL}, {ABSTRACT_SILVER_SQL}
    SELECT text, label, record_hash FROM silver_abstracts""",
)
def silver_abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver_abstracts(abstracts(spark, sf_dir))


@query(
    "null_safe_hash",
    """SELECT l_orderkey, l_linenumber, sha256(concat_ws('||',
        length(CAST(l_orderkey AS VARCHAR)) || ':' || CAST(l_orderkey AS VARCHAR),
        coalesce(length(flag) || ':' || flag, chr(0)),
        coalesce(length(status) || ':' || status, chr(0)))) AS record_hash
    FROM (SELECT l_orderkey, l_linenumber,
        CASE WHEN l_partkey % 7 <> 0 THEN l_returnflag END AS flag,
        CASE WHEN l_suppkey % 7 <> 0 THEN l_linestatus END AS status FROM lineitem)""",
)
def null_safe_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_partkey") % 7 != 0, F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_suppkey") % 7 != 0, F.col("l_linestatus")).alias("status"),
    )
    hashed = dedup.with_record_hash(rows, ["l_orderkey", "flag", "status"], null_safe=True)
    return hashed.select("l_orderkey", "l_linenumber", "record_hash")


@query(
    "normalize_columns",
    """SELECT p_partkey AS Part_Key, p_name AS Part_Name, p_size AS Size_Percent,
        p_retailprice AS Retail_Price_USD, p_type AS Type_Class, p_brand AS BrandName_
    FROM part""",
)
def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    awkward = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("Part Key"),
        F.col("p_name").alias("Part-Name"),
        F.col("p_size").alias("Size (%)"),
        F.col("p_retailprice").alias("Retail Price (USD)"),
        F.col("p_type").alias("Type/Class"),
        F.col("p_brand").alias("Brand(Name) "),
    )
    return cleaning.normalize_columns(awkward)


@query(
    "cast_to_schema",
    f"""WITH {HEALTH_SQL}, spoiled AS (
      SELECT l_orderkey, l_partkey,
        CASE l_orderkey % 7 WHEN 0 THEN 'abc' WHEN 1 THEN '' WHEN 2 THEN '12.7' WHEN 3 THEN ' 7 '
          WHEN 4 THEN '3000000000' ELSE CAST(Year AS VARCHAR) END AS year_text,
        CASE l_partkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN ' 1.5 '
          ELSE CAST(Mortality_Rate_Percent AS VARCHAR) END AS mortality_text,
        CAST(Population_Affected AS VARCHAR) AS population_text, Country FROM health)
    SELECT l_orderkey, l_partkey, Country,
      TRY_CAST(trunc(TRY_CAST(year_text AS DOUBLE)) AS INTEGER) AS Year,
      CAST(TRY_CAST(mortality_text AS FLOAT) AS DOUBLE) AS Mortality_Rate_Percent,
      TRY_CAST(population_text AS INTEGER) AS Population_Affected,
      CAST(NULL AS DOUBLE) AS Education_Index
    FROM spoiled""",
)
def cast_to_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = health(spark, sf_dir, ("l_orderkey", "l_partkey"))
    by_order, by_part = F.col("l_orderkey") % 7, F.col("l_partkey") % 5
    spoiled = typed.select(
        "l_orderkey",
        "l_partkey",
        "Country",
        F.when(by_order == 0, "abc")
        .when(by_order == 1, "")
        .when(by_order == 2, "12.7")
        .when(by_order == 3, " 7 ")
        .when(by_order == 4, "3000000000")
        .otherwise(F.col("Year").cast("string"))
        .alias("Year"),
        F.when(by_part == 0, "n/a")
        .when(by_part == 1, " 1.5 ")
        .otherwise(F.col("Mortality_Rate_Percent").cast("string"))
        .alias("Mortality_Rate_Percent"),
        F.col("Population_Affected").cast("string").alias("Population_Affected"),
    )
    return rounded(
        cleaning.cast_to_schema(spoiled, HEALTH_SCHEMA).select(
            "l_orderkey",
            "l_partkey",
            "Country",
            "Year",
            "Mortality_Rate_Percent",
            "Population_Affected",
            "Education_Index",
        )
    )


@query(
    "keep_chars",
    r"""SELECT o_orderkey, regexp_replace(o_orderpriority, '[^0-9\-+\s]', '', 'g') AS o_orderpriority
    FROM orders""",
)
def keep_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return cleaning.keep_chars(rows, "o_orderpriority")


@query(
    "probe_contains",
    r"""SELECT count(*) FILTER (contains(o_orderpriority, 'E')) AS before,
      count(*) FILTER (contains(regexp_replace(o_orderpriority, '[^0-9\-+\s]', '', 'g'), 'E'))
        AS after
    FROM orders""",
)
def probe_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("before"))
    both = cleaning.keep_chars(rows.withColumn("after", F.col("before")), "after")
    return cleaning.probe_counts(both, "E", before=F.col("before"), after=F.col("after"))


@query(
    "drop_null_keys",
    f"""WITH {HEALTH_SQL}, holes AS (
      SELECT l_orderkey, l_partkey, l_suppkey,
        CASE WHEN l_orderkey % 7 <> 0 THEN Country END AS Country,
        CASE WHEN l_partkey % 7 <> 0 THEN Year END AS Year,
        CASE WHEN l_suppkey % 7 <> 0 THEN Disease_Name END AS Disease_Name FROM health)
    SELECT * FROM holes
    WHERE Country IS NOT NULL AND Year IS NOT NULL AND Disease_Name IS NOT NULL""",
)
def drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("l_orderkey", "l_partkey", "l_suppkey")
    rows = health(spark, sf_dir, keys).select(*keys, *HEALTH_REQUIRED)
    holes = rows.withColumns(
        {
            name: F.when(F.col(key) % 7 != 0, F.col(name))
            for key, name in zip(keys, HEALTH_REQUIRED)
        }
    )
    return cleaning.drop_null_keys(holes, HEALTH_REQUIRED)


_MODEL_COLUMNS = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, TARGET]


@query(
    "model_rows",
    f"""WITH {HEALTH_SQL}, holes AS (
      SELECT * REPLACE (CASE WHEN l_orderkey % 7 <> 0 THEN DALYs END AS DALYs,
        CASE WHEN l_partkey % 7 <> 0 THEN Gender END AS Gender) FROM health)
    SELECT {health_columns_sql(_MODEL_COLUMNS)} FROM holes
    WHERE DALYs IS NOT NULL AND Gender IS NOT NULL""",
)
def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.drop_columns(
        health(spark, sf_dir, ("l_orderkey", "l_partkey")), "Disease_Name"
    ).withColumns(
        {
            "DALYs": F.when(F.col("l_orderkey") % 7 != 0, F.col("DALYs")),
            "Gender": F.when(F.col("l_partkey") % 7 != 0, F.col("Gender")),
        }
    )
    features = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    return rounded(cleaning.model_rows(rows, features, TARGET), 4)


# --- Gold -----------------------------------------------------------------------------------

_DETAIL_SQL = ", ".join(
    f"round(CAST({source} AS DOUBLE), 4) AS {name}"
    if HEALTH_SCHEMA[source].dataType.simpleString() == "float"
    else f"{source} AS {name}"
    for source, name in marts.DETAILS.items()
)


@query("country_details", f"WITH {HEALTH_SQL} SELECT {_DETAIL_SQL} FROM health")
def country_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(marts.country_disease_yearly_details(health(spark, sf_dir)), 4)


_AVERAGES_SQL = ", ".join(
    f"avg(CAST({name} AS DOUBLE)) AS Avg_{name}" for name in marts.AVERAGED
)
SUMMARY_SQL = f"""
summary AS (
  SELECT Country, {_AVERAGES_SQL},
    CAST(sum(Population_Affected) AS BIGINT) AS Total_Population_Affected_Overall,
    count(DISTINCT Year) AS Num_Years_Data,
    min(Year) AS First_Year_Data, max(Year) AS Last_Year_Data
  FROM health GROUP BY Country
)"""
_ROUNDED_SUMMARY_SQL = ", ".join(
    f"round(Avg_{name}, 6) AS Avg_{name}" for name in marts.AVERAGED
)


@query(
    "country_health_summary",
    f"""WITH {HEALTH_SQL}, {SUMMARY_SQL}
    SELECT Country, {_ROUNDED_SUMMARY_SQL}, Total_Population_Affected_Overall, Num_Years_Data,
      First_Year_Data, Last_Year_Data FROM summary""",
)
def country_health_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(marts.country_health_summary(health(spark, sf_dir)))


YEARLY_SQL = """
yearly AS (
  SELECT Year, Disease_Category,
    avg(CAST(Mortality_Rate_Percent AS DOUBLE)) AS Global_Avg_Mortality_Rate_Percent,
    avg(CAST(DALYs AS DOUBLE)) AS Global_Avg_DALYs,
    CAST(sum(Population_Affected) AS BIGINT) AS Global_Total_Population_Affected,
    count(DISTINCT Country) AS Num_Countries_Reported
  FROM health GROUP BY Year, Disease_Category
)"""
_ROUNDED_YEARLY_SQL = """
SELECT Year, Disease_Category,
  round(Global_Avg_Mortality_Rate_Percent, 6) AS Global_Avg_Mortality_Rate_Percent,
  round(Global_Avg_DALYs, 6) AS Global_Avg_DALYs,
  Global_Total_Population_Affected, Num_Countries_Reported
FROM yearly"""


def yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.yearly_disease_category_summary(health(spark, sf_dir))


@query("yearly_disease_category_summary", f"WITH {HEALTH_SQL}, {YEARLY_SQL} {_ROUNDED_YEARLY_SQL}")
def yearly_disease_category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(yearly(spark, sf_dir))


COUNTS_SQL = """
counts AS (
  SELECT label AS Disease_Category, count(DISTINCT record_hash) AS Abstract_Count
  FROM silver_abstracts GROUP BY label
)"""
_RESEARCH_SQL = f"{ABSTRACTS_SQL}, {ABSTRACT_SILVER_SQL}, {COUNTS_SQL}"


def research_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counting distinct fingerprints needs no deduplication before it."""
    return marts.disease_abstract_counts(hashed_abstracts(abstracts(spark, sf_dir)))


@query("disease_abstract_counts", f"WITH {_RESEARCH_SQL} SELECT * FROM counts")
def disease_abstract_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return research_counts(spark, sf_dir)


@query(
    "category_impact",
    f"""WITH {HEALTH_SQL}
    SELECT Disease_Category, CAST(sum(Population_Affected) AS BIGINT) AS Total_Population_Affected,
      round(avg(CAST(Mortality_Rate_Percent AS DOUBLE)), 6) AS Avg_Mortality_Rate
    FROM health GROUP BY Disease_Category""",
)
def category_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(marts.category_impact(health(spark, sf_dir)))


def _impact_sql(health_key: str, count_key: str) -> str:
    return f"""WITH {HEALTH_SQL}, {_RESEARCH_SQL}, impact AS (
      SELECT Disease_Category,
        CAST(sum(Population_Affected) AS BIGINT) AS Total_Population_Affected,
        round(avg(CAST(Mortality_Rate_Percent AS DOUBLE)), 6) AS Avg_Mortality_Rate
      FROM health GROUP BY Disease_Category)
    SELECT impact.*, Abstract_Count FROM impact
    LEFT JOIN counts ON {health_key} = {count_key}"""


@query(
    "impact_vs_research_strict",
    _impact_sql("impact.Disease_Category", "counts.Disease_Category"),
)
def impact_vs_research_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        marts.disease_impact_vs_research(health(spark, sf_dir), research_counts(spark, sf_dir))
    )


@query(
    "impact_vs_research_normalized",
    _impact_sql("lower(trim(impact.Disease_Category))", "lower(trim(counts.Disease_Category))"),
)
def impact_vs_research_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = research_counts(spark, sf_dir)
    return rounded(marts.disease_impact_vs_research(health(spark, sf_dir), counts, normalize=True))


@query(
    "impact_vs_research_matches",
    _impact_sql("impact.Disease_Category", "upper(counts.Disease_Category)"),
)
def impact_vs_research_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, strict, with labels in the letter case of the categories."""
    counts = research_counts(spark, sf_dir).withColumn(
        "Disease_Category", F.upper("Disease_Category")
    )
    return rounded(marts.disease_impact_vs_research(health(spark, sf_dir), counts))


# --- Lookups --------------------------------------------------------------------------------


@query(
    "country_trend",
    f"""WITH {HEALTH_SQL}
    SELECT Year, Disease_Category,
      round(avg(CAST(Mortality_Rate_Percent AS DOUBLE)), 6) AS avg_mortality
    FROM health WHERE Country = '{COUNTRY}' GROUP BY Year, Disease_Category""",
)
def country_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = marts.country_disease_yearly_details(health(spark, sf_dir))
    return rounded(lookups.country_trend(details, COUNTRY))


@query(
    "lookup_country",
    f"""WITH {HEALTH_SQL}, {SUMMARY_SQL}
    SELECT Country, {_ROUNDED_SUMMARY_SQL}, Total_Population_Affected_Overall, Num_Years_Data,
      First_Year_Data, Last_Year_Data FROM summary WHERE Country = '{COUNTRY}'""",
)
def lookup_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = marts.country_health_summary(health(spark, sf_dir))
    return rounded(lookups.lookup(summary, "Country", COUNTRY))


@query("yearly_trends", f"WITH {HEALTH_SQL}, {YEARLY_SQL} {_ROUNDED_YEARLY_SQL}")
def yearly_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(lookups.yearly_trends(yearly(spark, sf_dir)))


def _peak_sql(value: str) -> str:
    return f"""WITH {HEALTH_SQL}, {YEARLY_SQL},
    per_year AS (SELECT Year, {value} AS value FROM yearly GROUP BY Year)
    SELECT Year AS peak_year, value FROM per_year ORDER BY value DESC, Year LIMIT 1"""


@query(
    "peak_population", _peak_sql("CAST(sum(Global_Total_Population_Affected) AS BIGINT)")
)
def peak_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.peak_year(yearly(spark, sf_dir), "Global_Total_Population_Affected", "sum")


@query("peak_mortality", _peak_sql("round(avg(Global_Avg_Mortality_Rate_Percent), 6)"))
def peak_mortality(spark: SparkSession, sf_dir: str) -> DataFrame:
    peak = lookups.peak_year(yearly(spark, sf_dir), "Global_Avg_Mortality_Rate_Percent", "avg")
    return rounded(peak)


@query("peak_countries", _peak_sql("max(Num_Countries_Reported)"))
def peak_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.peak_year(yearly(spark, sf_dir), "Num_Countries_Reported", "max")


@query(
    "metric_series",
    f"""WITH {HEALTH_SQL}, {YEARLY_SQL}
    SELECT Year, Disease_Category, round(Global_Avg_DALYs, 6) AS value FROM yearly""",
)
def metric_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(lookups.metric_series(yearly(spark, sf_dir), "Global_Avg_DALYs"))


_LONG_METRICS = [
    *[f"Avg_{name}" for name in marts.AVERAGED],
    "Total_Population_Affected_Overall",
    "Num_Years_Data",
    "First_Year_Data",
    "Last_Year_Data",
]


@query(
    "summary_long",
    f"WITH {HEALTH_SQL}, {SUMMARY_SQL} "
    + " UNION ALL ".join(
        f"SELECT Country, '{name}' AS metric, round(CAST({name} AS DOUBLE), 6) AS value FROM summary"
        for name in _LONG_METRICS
    ),
)
def summary_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(lookups.summary_long(marts.country_health_summary(health(spark, sf_dir))))


@query(
    "kpi_display",
    f"""WITH {HEALTH_SQL}, {SUMMARY_SQL}
    SELECT Country,
      format('{{:.2f}}', Avg_Mortality_Rate_Percent) || '%' AS mortality_rate,
      format('{{:.2f}}', Avg_Healthcare_Access_Percent) || '%' AS healthcare_access,
      format('{{:,}}', CAST(trunc(Avg_DALYs) AS BIGINT)) AS dalys,
      format('{{:.2f}}', Avg_Doctors_per_1000) AS doctors_per_1000,
      format('{{:,}}', Total_Population_Affected_Overall) AS population_affected,
      '$' || format('{{:,}}', CAST(trunc(Avg_Per_Capita_Income_USD) AS BIGINT)) AS income
    FROM summary""",
)
def kpi_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.kpi_display(marts.country_health_summary(health(spark, sf_dir)))


@query(
    "peak_display",
    f"""WITH {HEALTH_SQL}, {YEARLY_SQL},
    per_year AS (SELECT Year, CAST(sum(Global_Total_Population_Affected) AS BIGINT) AS value
      FROM yearly GROUP BY Year)
    SELECT Year AS peak_year, format('{{:,}}', value) AS display
    FROM per_year ORDER BY value DESC, Year LIMIT 1""",
)
def peak_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.peak_display(peak_population(spark, sf_dir), "count")


@query(
    "flag_url",
    f"""SELECT n_name || ' / ~*+(é)' AS Country,
      '{FLAG_PREFIX}' || replace(url_encode(n_name || ' / ~*+(é)'), '%2F', '/') || '.png'
        AS Flag_URL
    FROM nation""",
)
def flag_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "nation").select(
        F.concat("n_name", F.lit(" / ~*+(é)")).alias("Country")
    )
    return lookups.with_flag_url(names, FLAG_PREFIX)


@query(
    "default_value",
    f"""WITH {HEALTH_SQL} SELECT DISTINCT Country FROM health
    ORDER BY Country <> 'United States', Country LIMIT 1""",
)
def default_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.default_value(health(spark, sf_dir), "Country")


@query(
    "distinct_countries",
    f"WITH {HEALTH_SQL} SELECT DISTINCT Country FROM health",
)
def distinct_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.distinct_values(health(spark, sf_dir), "Country")


# --- Scenarios ------------------------------------------------------------------------------


def scenario_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as scenarios: some out of bounds, some with blanks, some of an unknown country."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        "c_custkey",
        F.when(key % 10 == 0, "Atlantis").otherwise(F.col("n_name")).alias("Country"),
        F.when(key % 6 == 0, "UNHEARD OF").otherwise("PROMO").alias("Disease_Category"),
        F.when(key % 4 == 0, "1-").otherwise("1-URGENT").alias("Age_Group"),
        F.when(key % 3 == 0, "O").otherwise("F").alias("Gender"),
        F.when(key % 11 != 0, (F.lit(1996) + key % 40).cast("int")).alias("Year"),
        F.when(key % 13 != 0, F.col("c_acctbal") / 50).alias("Incidence_Rate_Percent"),
        F.col("c_acctbal").alias("DALYs"),
    )


SCENARIO_SQL = """
scenarios AS (
  SELECT c_custkey,
    CASE WHEN c_custkey % 10 = 0 THEN 'Atlantis' ELSE n_name END AS Country,
    CASE WHEN c_custkey % 6 = 0 THEN 'UNHEARD OF' ELSE 'PROMO' END AS Disease_Category,
    CASE WHEN c_custkey % 4 = 0 THEN '1-' ELSE '1-URGENT' END AS Age_Group,
    CASE WHEN c_custkey % 3 = 0 THEN 'O' ELSE 'F' END AS Gender,
    coalesce(CASE WHEN c_custkey % 11 <> 0 THEN CAST(1996 + c_custkey % 40 AS INTEGER) END, 2023)
      AS Year,
    coalesce(CASE WHEN c_custkey % 13 <> 0 THEN c_acctbal / 50 END, 1.0) AS Incidence_Rate_Percent,
    coalesce(c_acctbal, 400.0) AS DALYs
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""


@query(
    "validate_scenarios",
    f"""WITH {HEALTH_SQL}, {SCENARIO_SQL}
    SELECT c_custkey, nullif(concat_ws(',',
      CASE WHEN Year NOT BETWEEN 2000 AND 2030 THEN 'Year' END,
      CASE WHEN Incidence_Rate_Percent NOT BETWEEN 0 AND 100 THEN 'Incidence_Rate_Percent' END,
      CASE WHEN DALYs < 0 THEN 'DALYs' END,
      CASE WHEN Disease_Category NOT IN (SELECT Disease_Category FROM health)
        THEN 'Disease_Category' END,
      CASE WHEN Age_Group NOT IN (SELECT Age_Group FROM health) THEN 'Age_Group' END,
      CASE WHEN Gender NOT IN (SELECT Gender FROM health) THEN 'Gender' END), '') AS reject_reason
    FROM scenarios""",
)
def validate_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scenarios.with_form_defaults(scenario_rows(spark, sf_dir))
    rules = scenarios.rules_from_data(health(spark, sf_dir))
    return scenarios.validate_scenarios(rows, rules).select("c_custkey", "reject_reason")


@query(
    "enrich_scenarios",
    f"""WITH {HEALTH_SQL}, {SUMMARY_SQL}, {SCENARIO_SQL}
    SELECT c_custkey, Year,
      round(CAST(CAST(coalesce(Avg_Prevalence_Rate_Percent, 5.0) AS FLOAT) AS DOUBLE), 4)
        AS Prevalence_Rate_Percent,
      round(CAST(CAST(Incidence_Rate_Percent AS FLOAT) AS DOUBLE), 4) AS Incidence_Rate_Percent,
      CAST(trunc(coalesce(Avg_Average_Treatment_Cost_USD, 1000)) AS INTEGER)
        AS Average_Treatment_Cost_USD,
      round(CAST(CAST(coalesce(Avg_Recovery_Rate_Percent, 50.0) AS FLOAT) AS DOUBLE), 1)
        AS Recovery_Rate_Percent,
      round(CAST(CAST(DALYs AS FLOAT) AS DOUBLE), 4) AS DALYs,
      CAST(trunc(coalesce(Avg_Per_Capita_Income_USD, 0)) AS INTEGER) AS Per_Capita_Income_USD,
      Country, Disease_Category, Age_Group, Gender
    FROM scenarios JOIN summary USING (Country)""",
)
def enrich_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scenarios.with_form_defaults(scenario_rows(spark, sf_dir))
    summary = marts.country_health_summary(health(spark, sf_dir))
    requests = scenarios.enrich_scenarios(rows, summary, keep=["c_custkey"])
    return rounded(requests, 4, Recovery_Rate_Percent=1)


@query(
    "reject_scenarios",
    f"""WITH {HEALTH_SQL}, {SCENARIO_SQL}
    SELECT c_custkey, Country FROM scenarios
    WHERE Country NOT IN (SELECT Country FROM health)""",
)
def reject_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = marts.country_health_summary(health(spark, sf_dir))
    rejected = scenarios.reject_scenarios(scenario_rows(spark, sf_dir), summary)
    return rejected.select("c_custkey", "Country")
