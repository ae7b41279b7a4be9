import pytest
from pyspark.sql import functions as F

from tideglass.catalog.views import health
from tideglass.operators import lookups, marts


@pytest.fixture(scope="module")
def frame(spark, sf_dir):
    cached = health(spark, sf_dir).cache()
    yield cached
    cached.unpersist()


def category_rows(spark):
    rows = [("Cancer", 10, 1.0), ("viral", 20, 2.0), ("viral", 5, 4.0)]
    return spark.createDataFrame(
        rows,
        "Disease_Category string, Population_Affected int, Mortality_Rate_Percent float",
    )


def counts_rows(spark):
    return spark.createDataFrame(
        [("cancer", 3), ("viral", 2)], "Disease_Category string, Abstract_Count bigint"
    )


@pytest.mark.parametrize("normalize,cancer", [(False, None), (True, 3)])
def test_impact_join(spark, normalize, cancer):
    result = marts.disease_impact_vs_research(category_rows(spark), counts_rows(spark), normalize)
    assert [tuple(r) for r in result.collect()] == [
        ("viral", 25, 3.0, 2),
        ("Cancer", 10, 1.0, cancer),
    ]


def test_result_types(spark, frame):
    summary = dict(marts.country_health_summary(frame).dtypes)
    assert summary["Avg_DALYs"] == "double"
    assert summary["Total_Population_Affected_Overall"] == "bigint"
    assert (summary["Num_Years_Data"], summary["First_Year_Data"]) == ("bigint", "int")
    details = marts.country_disease_yearly_details(frame)
    assert details.columns == list(marts.DETAILS.values())


def test_gold_totals_equal_silver_totals(frame):
    total = frame.agg(F.sum("Population_Affected")).first()[0]
    for mart, column in (
        (marts.country_health_summary(frame), "Total_Population_Affected_Overall"),
        (marts.yearly_disease_category_summary(frame), "Global_Total_Population_Affected"),
        (marts.category_impact(frame), "Total_Population_Affected"),
    ):
        assert mart.agg(F.sum(column)).first()[0] == total


def test_order_of_marts(spark, frame):
    keys = [(r[0], r[1]) for r in marts.yearly_disease_category_summary(frame).collect()]
    assert keys == sorted(keys)
    rows = [("a", "1"), ("b", "1"), ("b", "2"), ("b", "2"), ("c", "9"), ("c", "8")]
    docs = spark.createDataFrame(rows, "label string, record_hash string")
    counts = [tuple(r) for r in marts.disease_abstract_counts(docs).collect()]
    assert counts == [("b", 2), ("c", 2), ("a", 1)]
    approx = marts.disease_abstract_counts(docs, approx=0.05)
    assert [tuple(r) for r in approx.collect()] == counts


def peaks(spark):
    rows = [(2003, "a", 4), (2001, "a", 1), (2001, "b", 3), (2002, "a", 4), (2004, "a", None), (None, "a", 9)]
    return spark.createDataFrame(rows, "Year int, c string, v bigint")


@pytest.mark.parametrize("how,expected", [("sum", (2001, 4)), ("avg", (2002, 4.0)), ("max", (2002, 4))])
def test_peak_ties_take_the_earliest_year(spark, how, expected):
    assert tuple(lookups.peak_year(peaks(spark), "v", how).first()) == expected


def test_peak_display(spark):
    peak = spark.createDataFrame([(2001, 1234567.891)], "peak_year int, value double")
    shown = [lookups.peak_display(peak, s).first()["display"] for s in ("count", "percent", "countries")]
    assert shown == ["1,234,567", "1234567.89%", "1234567 countries"]


def test_default_value(spark):
    names = spark.createDataFrame([("B",), ("United States",), ("A",), (None,)], "Country string")
    assert lookups.default_value(names, "Country").first()[0] == "United States"
    assert lookups.default_value(names, "Country", "Nowhere").first()[0] == "A"


def test_lookup_binds_quotes(spark):
    names = spark.createDataFrame([("Côte d'Ivoire",), ("x",)], "Country string")
    assert lookups.lookup(names, "Country", "Côte d'Ivoire").count() == 1


def test_metric_must_be_offered(spark, frame):
    with pytest.raises(ValueError):
        lookups.metric_series(marts.yearly_disease_category_summary(frame), "Num_Countries_Reported")


def test_flag_name(spark):
    names = spark.createDataFrame([("South Korea",)], "Country string")
    assert lookups.with_flag_url(names, "p/").first()["Flag_URL"] == "p/South%20Korea.png"


def test_display_rounds_like_c(spark):
    from tideglass.functions.display import fixed_percent, thousands

    frame = spark.createDataFrame([(0.125,), (1.005,), (-1234.5,)], "x double")
    shown = [r[0] for r in frame.select(fixed_percent(F.col("x"))).collect()]
    assert shown == [f"{x:.2f}%" for x in (0.125, 1.005, -1234.5)]
    assert [r[0] for r in frame.select(thousands(F.col("x"))).collect()] == ["0", "1", "-1,234"]


def test_summary_long_has_all_metrics(frame):
    summary = marts.country_health_summary(frame)
    long = lookups.summary_long(summary)
    assert long.count() == summary.count() * (len(summary.columns) - 1)
