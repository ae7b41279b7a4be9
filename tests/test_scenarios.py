import pytest

from tideglass.operators import scenarios
from tideglass.schemas import REQUEST_SCHEMA

COLUMNS = (
    "Country string, Disease_Category string, Age_Group string, Gender string, "
    "Year int, Incidence_Rate_Percent double, DALYs double"
)
GOOD = ("A", "Cancers", "0-19", "Male", 2010, 1.0, 5.0)


def changed(**values):
    names = [part.split()[0] for part in COLUMNS.split(", ")]
    return tuple({**dict(zip(names, GOOD)), **values}[name] for name in names)


def summary(spark):
    schema = "Country string, " + ", ".join(
        f"{column} double" for column, _ in scenarios.FILLED.values()
    )
    rows = [("A", 1.5, 99.9, 2.5, 7.9), ("B", None, None, None, None)]
    return spark.createDataFrame(rows, schema)


def test_validation_reasons(spark):
    cases = [
        (GOOD, None),
        (changed(Year=1999), "Year"),
        (changed(Year=2030), None),
        (changed(Incidence_Rate_Percent=100.5, DALYs=-1.0), "Incidence_Rate_Percent,DALYs"),
        (changed(Gender="Other", Age_Group=None), "Age_Group,Gender"),
        (changed(Year=None), "Year"),
    ]
    frame = spark.createDataFrame([row for row, _ in cases], COLUMNS).coalesce(1)
    checked = scenarios.validate_scenarios(frame)
    assert checked.columns == [*frame.columns, "reject_reason"]
    assert [r["reject_reason"] for r in checked.collect()] == [reason for _, reason in cases]


def test_allowed_values_from_data(spark):
    seen = spark.createDataFrame(
        [("Cancers", "0-19", "Male"), ("Cancers", None, "Male")],
        "Disease_Category string, Age_Group string, Gender string",
    )
    frame = spark.createDataFrame([GOOD, changed(Gender="Female"), changed(Age_Group=None)], COLUMNS)
    checked = scenarios.validate_scenarios(frame, scenarios.rules_from_data(seen))
    found = {(r["Gender"], r["Age_Group"]): r["reject_reason"] for r in checked.collect()}
    assert found == {
        ("Male", "0-19"): None, ("Female", "0-19"): "Gender", ("Male", None): "Age_Group",
    }


def test_form_defaults(spark):
    frame = spark.createDataFrame([("A", None)], "Country string, DALYs double")
    row = scenarios.with_form_defaults(frame).first()
    assert (row["Year"], row["Incidence_Rate_Percent"], row["DALYs"]) == (2023, 1.0, 400.0)


def test_enrichment_fills_truncates_and_falls_back(spark):
    frame = spark.createDataFrame([GOOD, changed(Country="B"), changed(Country="Atlantis")], COLUMNS)
    requests = scenarios.enrich_scenarios(frame, summary(spark))
    assert [(f.name, f.dataType) for f in requests.schema] == [
        (f.name, f.dataType) for f in REQUEST_SCHEMA
    ]
    rows = {r["Country"]: r for r in requests.collect()}
    assert set(rows) == {"A", "B"}
    filled = list(scenarios.FILLED)
    assert [rows["A"][name] for name in filled] == [1.5, 99, 2.5, 7]
    assert [rows["B"][name] for name in filled] == [5.0, 1000, 50.0, 0]
    rejected = scenarios.reject_scenarios(frame, summary(spark))
    assert [r["Country"] for r in rejected.collect()] == ["Atlantis"]
