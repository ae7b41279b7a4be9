import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideglass.operators import cleaning
from tideglass.schemas import HEALTH_SCHEMA, RAW_HEALTH_HEADERS


def values(df, column):
    return [row[column] for row in df.collect()]


def one_column(spark, name, items):
    return spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, {name} string")


def test_raw_headers_become_schema_names():
    assert [cleaning.normalize_name(h) for h in RAW_HEALTH_HEADERS] == HEALTH_SCHEMA.names


def test_colliding_names_raise(spark):
    frame = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError, match="a_b"):
        cleaning.normalize_columns(frame)


@pytest.mark.parametrize("kind", ["integer", "long"])
def test_whole_number_text(spark, kind):
    items = ["12", "12.7", "abc", "", " 7 ", "3000000000", None, "1e3", "1d", "NaN", "-4.9", ".5"]
    frame = one_column(spark, "Year", items)
    typed = cleaning.cast_to_schema(frame, StructType().add("Year", kind)).orderBy("i")
    big = 3000000000 if kind == "long" else None
    assert values(typed, "Year") == [12, 12, None, None, 7, big, None, None, None, None, -4, 0]


def test_schema_columns_come_first_and_absent_ones_are_null(spark):
    frame = spark.createDataFrame([("x", "1.5", "C")], "extra string, DALYs string, Country string")
    typed = cleaning.cast_to_schema(frame, HEALTH_SCHEMA)
    assert typed.columns == [*HEALTH_SCHEMA.names, "extra"]
    row = typed.first()
    assert (row["Country"], row["DALYs"], row["Year"], row["extra"]) == ("C", 1.5, None, "x")
    assert {f.name: f.dataType for f in typed.schema}["Year"] == HEALTH_SCHEMA["Year"].dataType


def test_age_cleaning(spark):
    frame = one_column(spark, "age", ["0-18 years", "61+", "adults", None])
    assert values(cleaning.keep_chars(frame, "age").orderBy("i"), "age") == ["0-18 ", "61+", "", None]
    trimmed = cleaning.keep_chars(frame, "age", trim=True).orderBy("i")
    assert values(trimmed, "age") == ["0-18", "61+", "", None]


def test_label_and_text_cleaning(spark):
    rows = [(" t ", " Cancer "), ("t", "CANCER"), ("t", ""), ("t", None), ("  ", "x"), (None, "x")]
    frame = spark.createDataFrame(rows, "text string, label string")
    clean = cleaning.require_non_empty(cleaning.clean_text(frame), ["text", "label"])
    assert [tuple(r) for r in clean.collect()] == [("t", "cancer"), ("t", "cancer")]


def test_trim_removes_blanks_only(spark):
    frame = spark.createDataFrame([("\ta\n", "l")], "text string, label string")
    assert cleaning.clean_text(frame).first()["text"] == "\ta\n"


def test_null_keys_one_at_a_time(spark):
    rows = [("c", 1, "d"), (None, 1, "d"), ("c", None, "d"), ("c", 1, None)]
    frame = spark.createDataFrame(rows, "Country string, Year int, Disease_Name string")
    assert cleaning.drop_null_keys(frame, ["Country", "Year", "Disease_Name"]).count() == 1


def test_probe(spark):
    frame = one_column(spark, "age", ["10 years", "20", "x", None])
    assert values(cleaning.probe_contains(frame, "age", "s", n=5), "age") == ["10 years"]
    counts = cleaning.probe_counts(
        frame, "s", before=F.col("age"), after=F.regexp_replace("age", "[^0-9]", "")
    ).first()
    assert (counts["before"], counts["after"]) == (1, 0)


def test_model_rows_drop_null_and_nan(spark):
    rows = [(1.0, "a", 2.0), (float("nan"), "a", 2.0), (1.0, None, 2.0), (1.0, "a", None)]
    frame = spark.createDataFrame(rows, "x double, k string, y double")
    assert cleaning.model_rows(frame, ["x", "k"], "y").count() == 1


def test_headers_in_other_letter_case(spark):
    from tideglass.plans.silver import hashed_health
    from tideglass.schemas import RAW_HEALTH_HEADERS

    row = dict.fromkeys(RAW_HEALTH_HEADERS, "1")
    frame = spark.createDataFrame([row]).withColumnRenamed("Country", "country").withColumn("More", F.lit("x"))
    silver = hashed_health(frame).first()
    assert silver["Country"] == "1" and silver["More"] == "x"
    with pytest.raises(ValueError, match="compete"):
        # Names that differ in letter case only, as a session with case rules off reads them.
        hashed_health(frame.toDF(*["COUNTRY" if n == "More" else n for n in frame.columns]))
