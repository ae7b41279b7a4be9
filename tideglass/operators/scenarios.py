"""Prediction scenarios as set operations: validation, enrichment and rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.operators.salted import salted_join
from tideglass.schemas import REQUEST_SCHEMA

# Form defaults and limits, and the feature -> (summary column, fallback) rules.
FORM_DEFAULTS = {"Year": 2023, "Incidence_Rate_Percent": 1.0, "DALYs": 400.0}
FORM_RANGES = {
    "Year": (2000, 2030),
    "Incidence_Rate_Percent": (0.0, 100.0),
    "DALYs": (0.0, None),
}
FORM_AGE_GROUPS = ["0-19", "20-39", "40-59", "60-79", "80+"]
FORM_GENDERS = ["Male", "Female"]
FORM_CATEGORIES = [
    "Cardiovascular Diseases",
    "Infectious Diseases",
    "Cancers",
    "Respiratory Diseases",
]
FILLED = {
    "Prevalence_Rate_Percent": ("Avg_Prevalence_Rate_Percent", 5.0),
    "Average_Treatment_Cost_USD": ("Avg_Average_Treatment_Cost_USD", 1000),
    "Recovery_Rate_Percent": ("Avg_Recovery_Rate_Percent", 50.0),
    "Per_Capita_Income_USD": ("Avg_Per_Capita_Income_USD", 0),
}


@dataclass(frozen=True)
class ScenarioRules:
    """Closed ranges (None = open end) and allowed values, as a list or as a frame's column."""

    ranges: Mapping[str, tuple] = field(default_factory=lambda: dict(FORM_RANGES))
    allowed: Mapping[str, Sequence[str] | DataFrame] = field(default_factory=dict)


FORM_RULES = ScenarioRules(
    allowed={
        "Disease_Category": FORM_CATEGORIES,
        "Age_Group": FORM_AGE_GROUPS,
        "Gender": FORM_GENDERS,
    }
)


def rules_from_data(
    df: DataFrame, columns: Sequence[str] = ("Disease_Category", "Age_Group", "Gender")
) -> ScenarioRules:
    """P16 with the allowed values that occur in ``df``, so scenarios match what was trained on."""
    return ScenarioRules(allowed={name: df.select(name) for name in columns})


def with_form_defaults(scenarios: DataFrame) -> DataFrame:
    """A blank or absent form field takes its default."""
    filled = {
        name: F.coalesce(F.col(name), F.lit(value)) if name in scenarios.columns else F.lit(value)
        for name, value in FORM_DEFAULTS.items()
    }
    return scenarios.withColumns(filled)


def validate_scenarios(scenarios: DataFrame, rules: ScenarioRules = FORM_RULES) -> DataFrame:
    """Add ``reject_reason``: the fields out of bounds, comma-separated, or null if all are fine.

    Allowed values from a frame are joined; adaptive execution broadcasts them if they are few.
    """
    problems = []
    checked = scenarios
    for name, (low, high) in rules.ranges.items():
        fine = F.lit(True)
        if low is not None:
            fine = fine & (F.col(name) >= low)
        if high is not None:
            fine = fine & (F.col(name) <= high)
        problems.append((name, fine))
    for name, values in rules.allowed.items():
        if isinstance(values, DataFrame):
            known = values.select(F.col(name).alias(f"_{name}")).distinct()
            checked = checked.join(known, F.col(name) == F.col(f"_{name}"), "left")
            problems.append((name, F.col(f"_{name}").isNotNull()))
        else:
            problems.append((name, F.col(name).isin(*values)))
    bad = F.concat_ws(
        ",", *[F.when(~F.coalesce(fine, F.lit(False)), F.lit(name)) for name, fine in problems]
    )
    reason = F.when(bad != "", bad).alias("reject_reason")
    return checked.select(*scenarios.columns, reason)


def enrich_scenarios(
    scenarios: DataFrame, summary: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """Model requests with the country's averages filled in; whole numbers are cut off.

    Scenarios for a country without summary are left out here and come from ``reject_scenarios``.
    Adaptive execution broadcasts a summary of few countries. A country that many scenarios name is
    spread over many tasks, also where the summary comes from an aggregation and is partitioned by
    country already.
    """
    averages = summary.select("Country", *[column for column, _ in FILLED.values()])
    filled = {
        name: F.coalesce(F.col(column), F.lit(default))
        for name, (column, default) in FILLED.items()
    }
    joined = salted_join(scenarios, averages, "Country").withColumns(filled)
    request = [F.col(f.name).cast(f.dataType).alias(f.name) for f in REQUEST_SCHEMA]
    return joined.select(*keep, *request)


def reject_scenarios(scenarios: DataFrame, summary: DataFrame) -> DataFrame:
    """Scenarios whose country has no summary."""
    return scenarios.join(summary.select("Country"), "Country", "left_anti")
