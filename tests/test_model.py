import random

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tideglass.operators import features
from tideglass.plans.training import train
from tideglass.schemas import (
    CATEGORICAL_FEATURES,
    NUMERIC_FEATURES,
    REQUEST_SCHEMA,
    TARGET,
)
from tideglass.sources import load_model, rows_to_frame, save_model


@pytest.fixture(scope="module")
def signal(spark):
    """Mortality follows the country and the incidence rate."""
    rng = random.Random(7)
    rows = []
    for _ in range(1500):
        country = rng.choice(["A", "B", "C"])
        incidence = rng.uniform(0, 10)
        mortality = {"A": 0.0, "B": 5.0, "C": 10.0}[country] + incidence + rng.gauss(0, 0.2)
        rows.append(
            (
                rng.randint(2000, 2020), rng.random(), incidence, rng.randint(1, 900),
                rng.random(), rng.random(), rng.randint(1, 900), country,
                rng.choice("xy"), rng.choice("yo"), rng.choice("mf"), mortality,
            )
        )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REQUEST_SCHEMA)
    return spark.createDataFrame(rows, f"{schema}, {TARGET} float")


@pytest.fixture(scope="module")
def training(signal):
    return train(signal)


def test_beats_the_mean_and_stays_in_range(signal, training):
    metrics = training.metrics.first()
    assert metrics["r2"] > 0.7 and metrics["rows"] > 100
    low, high = signal.agg(F.min(TARGET), F.max(TARGET)).first()
    outside = training.predictions.filter(~F.col("prediction").between(low, high))
    assert outside.isEmpty()


def test_metrics_agree_with_the_evaluator(training):
    metrics = training.metrics.first()
    for name in ("rmse", "r2"):
        evaluator = RegressionEvaluator(labelCol=TARGET, metricName=name)
        assert metrics[name] == pytest.approx(evaluator.evaluate(training.predictions), abs=1e-9)


def test_metrics_of_a_constant_label(spark):
    frame = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, prediction double")
    assert features.regression_metrics(frame, "y").first()["r2"] is None


def predictions(model, frame):
    return [r["prediction"] for r in features.score(model, frame).collect()]


def test_same_seed_same_model_and_reload(signal, training, tmp_path):
    requests = signal.drop(TARGET).limit(50)
    ours = predictions(training.model, requests)
    assert predictions(train(signal.coalesce(1)).model, requests) == pytest.approx(ours, abs=2.0)
    save_model(training.model, str(tmp_path / "m"))
    save_model(training.model, str(tmp_path / "m"))
    assert predictions(load_model(str(tmp_path / "m")), requests) == ours
    with pytest.raises(Exception):
        load_model(str(tmp_path / "none"))


def test_required_and_missing_features(training, signal):
    assert features.required_features(training.model) == (NUMERIC_FEATURES, CATEGORICAL_FEATURES)
    assert features.missing_features(training.model, signal) == []
    request = signal.drop("Year", "Country")
    assert features.missing_features(training.model, request) == ["Country", "Year"]
    with pytest.raises(features.MissingFeatures) as error:
        features.score(training.model, request)
    assert error.value.names == ["Country", "Year"]


def test_unseen_country_is_an_all_zero_vector(spark, training, signal):
    unseen = signal.limit(1).withColumn("Country", F.lit("Nowhere"))
    row = features.score(training.model, unseen).first()
    assert row["Country_vec"].numNonzeros() == 0 and row["prediction"] is not None


def test_request_rows_are_cast(spark, training):
    request = {name: 1 for name in NUMERIC_FEATURES} | {n: "A" for n in CATEGORICAL_FEATURES}
    frame = rows_to_frame(spark, [request], REQUEST_SCHEMA)
    text = spark.createDataFrame([{k: str(v) for k, v in request.items()}])
    assert predictions(training.model, frame) == predictions(training.model, text)


def test_streaming_scores_equal_batch_scores(spark, training, signal, tmp_path):
    requests = signal.drop(TARGET)
    requests.write.parquet(str(tmp_path / "requests"))
    stream = spark.readStream.schema(requests.schema).parquet(str(tmp_path / "requests"))
    query = (
        features.score(training.model, stream)
        .select("Year", "Country", "prediction")
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "scored"))
        .option("checkpointLocation", str(tmp_path / "offsets"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    streamed = sorted(map(tuple, spark.read.parquet(str(tmp_path / "scored")).collect()))
    batch = features.score(training.model, requests).select("Year", "Country", "prediction")
    assert streamed == sorted(map(tuple, batch.collect()))


def test_no_complete_rows_no_model(signal):
    assert train(signal.withColumn("DALYs", F.lit(None).cast("float"))) is None


def test_required_columns_by_what_stages_make(spark):
    rows = spark.createDataFrame(
        [(float(i), "ab"[i % 2], float(i)) for i in range(20)],
        "plain_vec double, kind string, y double",
    )
    stages = features.encoding_stages(["plain_vec"], ["kind"])
    model = features.Pipeline(stages=[*stages, features.random_forest("y", trees=1)]).fit(rows)
    assert features.required_features(model) == (["plain_vec"], ["kind"])


def test_importance_finds_the_signal(signal):
    named = signal.withColumn("Disease_Name", F.lit("d"))
    top = features.feature_importance(named, pct=100, trees=20, depth=6, n=5).collect()
    weights = [r["importance"] for r in top]
    assert weights == sorted(weights, reverse=True) and len(top) == 5
    best = {r["feature"] for r in top[:3]}
    # The first country in order is the dropped level.
    assert best == {"Incidence_Rate_Percent", "Country_vec_B", "Country_vec_C"}


def test_many_rows_are_fitted_in_tasks_of_bounded_size(spark, signal, monkeypatch):
    """However few partitions the rows have, each task holds its share alone."""
    sizes = []
    forest = features.random_forest

    def watched(*args, **kwargs):
        made = forest(*args, **kwargs)
        fit = made.fit

        def fit_watched(frame):
            sizes.extend(frame.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect())
            return fit(frame)

        made.fit = fit_watched
        return made

    monkeypatch.setattr(features, "random_forest", watched)
    rows = signal.select(*features.NUMERIC_FEATURES, *features.CATEGORICAL_FEATURES, features.TARGET).na.drop().coalesce(1)
    number = rows.count()
    model = features.fit_regression(rows, trees=3, depth=2, task_rows=-(-number // 16))
    assert len(sizes) >= 16 and sum(sizes) == number and max(sizes) < number / 4
    assert features.required_features(model) == (features.NUMERIC_FEATURES, features.CATEGORICAL_FEATURES)
    assert features.score(model, rows).count() == number


def test_a_large_forest_is_grown_by_fits_of_bounded_size(spark, signal, monkeypatch):
    """All trees, on all rows, by fits that hold few trees' numbers with each row and rows dealt evenly."""
    fits = []
    forest = features.random_forest

    def watched(target, trees, depth, seed, *rest):
        made = forest(target, trees, depth, seed, *rest)
        fit = made._fit

        def fit_watched(frame):
            sizes = frame.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
            fits.append((trees, depth, seed, sizes))
            return fit(frame)

        made._fit = fit_watched
        return made

    monkeypatch.setattr(features, "random_forest", watched)
    rows = signal.drop("Disease_Name").na.drop().coalesce(1)
    number = rows.count()
    ranked = features.feature_importance(rows, n=1000, pct=100, trees=45, depth=4, task_rows=-(-number // 16)).collect()
    assert sum(trees for trees, *_ in fits) == 45 and all(1 < trees <= features.FIT_TREES for trees, *_ in fits)
    assert {depth for _, depth, *_ in fits} == {4} and len({seed for _, _, seed, _ in fits}) == len(fits)
    for *_, sizes in fits:
        assert sum(sizes) == number and max(sizes) < number / 4
    assert sum(r["importance"] for r in ranked) == pytest.approx(1)
    assert {r["feature"] for r in ranked[:3]} == {"Incidence_Rate_Percent", "Country_vec_B", "Country_vec_C"}
    again = features.feature_importance(rows, n=1000, pct=100, trees=45, depth=4, task_rows=-(-number // 16)).collect()
    assert [r["feature"] for r in again[:3]] == [r["feature"] for r in ranked[:3]]
