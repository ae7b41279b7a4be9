"""Column names and types of the Bronze, Silver, Gold and model frames."""

from __future__ import annotations

from pyspark.sql.types import StructType


def _struct(fields: list[tuple[str, str]]) -> StructType:
    schema = StructType()
    for name, type_name in fields:
        schema.add(name, type_name)
    return schema


# --- Fixed values: the data contract shared with existing producers and readers ---

HEALTH_SCHEMA = _struct(
    [
        ("Country", "string"),
        ("Year", "integer"),
        ("Disease_Name", "string"),
        ("Disease_Category", "string"),
        ("Prevalence_Rate_Percent", "float"),
        ("Incidence_Rate_Percent", "float"),
        ("Mortality_Rate_Percent", "float"),
        ("Age_Group", "string"),
        ("Gender", "string"),
        ("Population_Affected", "integer"),
        ("Healthcare_Access_Percent", "float"),
        ("Doctors_per_1000", "float"),
        ("Hospital_Beds_per_1000", "float"),
        ("Treatment_Type", "string"),
        ("Average_Treatment_Cost_USD", "integer"),
        ("Availability_of_Vaccines_Treatment", "string"),
        ("Recovery_Rate_Percent", "float"),
        ("DALYs", "float"),
        ("Improvement_in_5_Years_Percent", "float"),
        ("Per_Capita_Income_USD", "integer"),
        ("Education_Index", "float"),
        ("Urbanization_Rate_Percent", "float"),
    ]
)

# Raw message fields; every value arrives as text and is typed in Silver.
RAW_HEALTH_HEADERS = [
    "Country",
    "Year",
    "Disease Name",
    "Disease Category",
    "Prevalence Rate (%)",
    "Incidence Rate (%)",
    "Mortality Rate (%)",
    "Age Group",
    "Gender",
    "Population Affected",
    "Healthcare Access (%)",
    "Doctors per 1000",
    "Hospital Beds per 1000",
    "Treatment Type",
    "Average Treatment Cost (USD)",
    "Availability of Vaccines/Treatment",
    "Recovery Rate (%)",
    "DALYs",
    "Improvement in 5 Years (%)",
    "Per Capita Income (USD)",
    "Education Index",
    "Urbanization Rate (%)",
]

ABSTRACT_SCHEMA = _struct(
    [
        ("text", "string"),
        ("label", "string"),
    ]
)

HEALTH_REQUIRED = ["Country", "Year", "Disease_Name"]
HEALTH_IDENTITY = [
    "Country",
    "Year",
    "Disease_Name",
    "Age_Group",
    "Gender",
    "Prevalence_Rate_Percent",
    "Incidence_Rate_Percent",
    "Mortality_Rate_Percent",
]
ABSTRACT_IDENTITY = ["text", "label"]

# The model's features: numerics first, then the categoricals, and the target.
NUMERIC_FEATURES = [
    "Year",
    "Prevalence_Rate_Percent",
    "Incidence_Rate_Percent",
    "Average_Treatment_Cost_USD",
    "Recovery_Rate_Percent",
    "DALYs",
    "Per_Capita_Income_USD",
]
CATEGORICAL_FEATURES = ["Country", "Disease_Category", "Age_Group", "Gender"]
TARGET = "Mortality_Rate_Percent"

# --- End of fixed values ---


def string_schema(names: list[str]) -> StructType:
    """All-string schema for a raw scan: no inference pass, no failure on an empty folder."""
    schema = StructType()
    for name in names:
        schema.add(name, "string")
    return schema


RAW_HEALTH_SCHEMA = string_schema(RAW_HEALTH_HEADERS)
REQUEST_SCHEMA = StructType(
    [HEALTH_SCHEMA[name] for name in NUMERIC_FEATURES + CATEGORICAL_FEATURES]
)
