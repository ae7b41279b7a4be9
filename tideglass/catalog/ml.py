"""Model queries."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.catalog.registry import query
from tideglass.catalog.views import HEALTH_SQL, health, rounded, table
from tideglass.operators import dedup, features, labels
from tideglass.operators.cleaning import model_rows
from tideglass.plans.training import train
from tideglass.schemas import CATEGORICAL_FEATURES, HEALTH_SCHEMA, NUMERIC_FEATURES, TARGET
from tideglass.session import materialize, scratch_path
from tideglass.sources import (
    decode_messages,
    load_model,
    read_topic_stream,
    save_model,
    to_messages,
    write_messages,
)

_INDEX_SQL = """
types AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS type_index,
  count(*) OVER () AS n_types FROM part GROUP BY p_type),
brands AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS brand_index,
  count(*) OVER () AS n_brands FROM part GROUP BY p_brand)"""


@query(
    "string_index",
    f"""WITH {_INDEX_SQL}
    SELECT p_partkey, CAST(type_index AS DOUBLE) AS p_type_index,
      CAST(brand_index AS DOUBLE) AS p_brand_index
    FROM part JOIN types USING (p_type) JOIN brands USING (p_brand)""",
)
def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    indexed = features.string_indexer(["p_type", "p_brand"]).fit(part).transform(part)
    return indexed.select("p_partkey", "p_type_index", "p_brand_index")


def _nonzero(df: DataFrame, vector: str) -> DataFrame:
    """Non-zero vector entries as rows."""
    entries = df.select(
        "p_partkey", F.posexplode(vector_to_array(vector)).alias("position", "value")
    )
    return entries.filter(F.col("value") != 0)


@query(
    "one_hot",
    f"""WITH {_INDEX_SQL}
    SELECT p_partkey, CAST(type_index AS INTEGER) AS position, CAST(1 AS DOUBLE) AS value
    FROM part JOIN types USING (p_type)""",
)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    stages = [features.string_indexer(["p_type"]), features.one_hot_encoder(["p_type"])]
    return _nonzero(Pipeline(stages=stages).fit(part).transform(part), "p_type_vec")


@query(
    "assemble",
    f"""WITH {_INDEX_SQL}
    SELECT p_partkey, CAST(0 AS INTEGER) AS position, CAST(p_size AS DOUBLE) AS value
    FROM part WHERE p_size <> 0
    UNION ALL SELECT p_partkey, 1, p_retailprice FROM part WHERE p_retailprice <> 0
    UNION ALL SELECT p_partkey, CAST(2 + type_index AS INTEGER), 1.0
      FROM part JOIN types USING (p_type)
    UNION ALL SELECT p_partkey,
        CAST(2 + (SELECT count(DISTINCT p_type) FROM part) + brand_index AS INTEGER), 1.0
      FROM part JOIN brands USING (p_brand)""",
)
def assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    stages = features.encoding_stages(["p_size", "p_retailprice"], ["p_type", "p_brand"])
    return _nonzero(Pipeline(stages=stages).fit(part).transform(part), features.FEATURES)


@query(
    "hash_split",
    """SELECT o_orderkey, CAST('0x' || substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT)
      % 100 < 80 AS in_first FROM orders""",
)
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    first, second = dedup.split_rows(orders, ["o_orderkey"], 80)
    return first.withColumn("in_first", F.lit(True)).unionAll(
        second.withColumn("in_first", F.lit(False))
    )


@query(
    "regression_metrics",
    """WITH p AS (SELECT p_retailprice AS y, avg(p_retailprice) OVER (PARTITION BY p_type) AS yhat
      FROM part)
    SELECT count(*) AS rows, round(sqrt(avg(pow(y - yhat, 2))), 6) AS rmse,
      round(1 - sum(pow(y - yhat, 2)) / (count(*) * var_pop(y)), 6) AS r2 FROM p""",
)
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_type", "p_retailprice")
    by_type = part.groupBy("p_type").agg(F.avg("p_retailprice").alias("prediction"))
    predicted = part.join(by_type, "p_type")
    return rounded(features.regression_metrics(predicted, "p_retailprice"))


_MODEL_COLUMNS = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, TARGET]


#: The side of an order in a split, as ``hash_bucket`` has it.
_BUCKET_SQL = "CAST('0x' || substr(sha256(CAST(l_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100"


@query(
    "train_and_score",
    f"""WITH {HEALTH_SQL}, used AS (
      SELECT l_orderkey, l_partkey, l_suppkey, round(CAST({TARGET} AS DOUBLE), 4) AS label,
        {_BUCKET_SQL} AS bucket
      FROM health WHERE {" AND ".join(f"{name} IS NOT NULL" for name in _MODEL_COLUMNS)})
    SELECT l_orderkey, l_partkey, l_suppkey, label, true AS in_label_range,
      true AS loaded_model_agrees, true AS metrics_agree FROM used WHERE bucket >= 80""",
)
def train_and_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load, and score the held-out rows with the loaded model: each held-out row with its keys
    and label, and what must hold of any forest's prediction for it."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    rows = health(spark, sf_dir, tuple(keys)).select(*keys, *_MODEL_COLUMNS)
    # All lines of an order are on one side; the other keys only pass through.
    rows = rows.withColumn("keys", F.struct(*keys[1:])).drop(*keys[1:])
    staged = materialize(spark, rows, "model-rows")
    training = train(staged.drop("keys"), split_on=["l_orderkey"])
    path = scratch_path(spark, "model")
    save_model(training.model, path)
    held_out = staged.na.drop(subset=_MODEL_COLUMNS).where(dedup.hash_bucket(["l_orderkey"]) >= 80)
    fresh = training.model.transform(held_out).withColumnRenamed("prediction", "fresh")
    # Both evaluators and the loaded model read these rows.
    fresh = materialize(spark, fresh.drop(*_made_columns(training.model)), "fresh")
    scored = features.score(load_model(path), fresh)
    measured = training.metrics.first()
    evaluated = {
        name: RegressionEvaluator(labelCol=TARGET, predictionCol="fresh", metricName=name).evaluate(fresh)
        for name in ("rmse", "r2")
    }
    agree = all(math.isclose(measured[n], v, rel_tol=1e-6, abs_tol=1e-9) for n, v in evaluated.items())
    used = model_rows(staged, [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES], TARGET)
    bounds = used.agg(F.min(TARGET).alias("low"), F.max(TARGET).alias("high")).first()
    return scored.select(
        "l_orderkey",
        "keys.*",
        F.round(F.col(TARGET).cast("double"), 4).alias("label"),
        F.col("prediction").between(bounds["low"], bounds["high"]).alias("in_label_range"),
        (F.col("prediction") == F.col("fresh")).alias("loaded_model_agrees"),
        F.lit(agree).alias("metrics_agree"),
    )


def _made_columns(model) -> list[str]:
    """Columns that the stages of a model add, but for the prediction."""
    return [c for stage in model.stages for c in features._columns(stage, "outputCol")]


@query(
    "stream_scored",
    f"""WITH {HEALTH_SQL}
    SELECT l_orderkey, count(*) AS n_rows, true AS in_label_range, true AS as_in_batch FROM health
    WHERE {" AND ".join(f"{name} IS NOT NULL" for name in _MODEL_COLUMNS)} GROUP BY l_orderkey""",
)
def stream_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows sent as requests and scored by a stream; by order, whether the predictions lie in the
    range of the labels, as a forest's do, and are those of a batch."""
    rows = health(spark, sf_dir, ("l_orderkey",)).select("l_orderkey", *_MODEL_COLUMNS)
    rows = materialize(spark, rows.na.drop(subset=_MODEL_COLUMNS), "model-rows")
    model = features.fit_regression(rows, trees=4, depth=3)
    requests = rows.drop(TARGET)
    folder, path = scratch_path(spark, "requests"), scratch_path(spark, "scored")
    write_messages(to_messages(requests), folder)
    messages = decode_messages(read_topic_stream(spark, folder=folder), requests.schema)
    (
        features.score(model, messages.drop("reject"))
        .select("l_orderkey", "prediction")
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", scratch_path(spark, "scored-offsets"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    bounds = rows.agg(F.min(TARGET).alias("low"), F.max(TARGET).alias("high")).first()

    def by_order(scored: DataFrame, name: str) -> DataFrame:
        return scored.groupBy("l_orderkey").agg(
            F.count("*").alias(f"{name}_rows"),
            F.sum("prediction").alias(f"{name}_sum"),
            F.bool_and(F.col("prediction").between(bounds["low"], bounds["high"])).alias(f"{name}_in"),
        )

    streamed = by_order(spark.read.parquet(path), "stream")
    batch = by_order(features.score(model, requests), "batch")
    close = F.abs(F.col("stream_sum") - F.col("batch_sum")) <= 1e-9 * F.abs(F.col("batch_sum"))
    return streamed.join(batch, "l_orderkey", "full").select(
        "l_orderkey",
        F.col("stream_rows").alias("n_rows"),
        F.col("stream_in").alias("in_label_range"),
        F.coalesce(close & (F.col("stream_rows") == F.col("batch_rows")), F.lit(False)).alias("as_in_batch"),
    )


@query(
    "string_index_many",
    """SELECT p_partkey, CAST(n AS DOUBLE) AS p_name_index FROM part JOIN (
      SELECT p_name, row_number() OVER (ORDER BY count(*) DESC, p_name) - 1 AS n FROM part GROUP BY p_name)
      USING (p_name)""",
)
def string_index_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 for a column with nearly as many values as rows; no label comes to the driver."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    indexed = labels.with_label_index(part, labels.label_index(part, "p_name"), "p_name")
    return indexed.select("p_partkey", "p_name_index")


_TEXT = [
    field.name
    for field in HEALTH_SCHEMA
    if field.dataType.simpleString() == "string" and field.name != "Disease_Name"
]
_PLAIN = [
    field.name
    for field in HEALTH_SCHEMA
    if field.dataType.simpleString() != "string" and field.name != TARGET
]


@query(
    "feature_importance",
    f"""WITH {HEALTH_SQL}, sample AS (
      SELECT * FROM (SELECT *, {_BUCKET_SQL} AS bucket FROM health) WHERE bucket < 10) """
    + " UNION ALL ".join(
        [f"SELECT '{name}' AS feature, true AS weight_fits FROM region WHERE r_regionkey = 0" for name in _PLAIN]
        + [
            f"""SELECT '{name}_vec_' || v, true FROM (SELECT DISTINCT {name} AS v FROM sample)
            WHERE v <> (SELECT min({name}) FROM sample)"""
            for name in _TEXT
        ]
    ),
)
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every position of the vectors by name, as the sample has them, and whether its weight is a share of
    one that is not above the weight of the position before it."""
    rows = health(spark, sf_dir, ("l_orderkey",)).select("l_orderkey", *HEALTH_SCHEMA.names)
    ranked = features.feature_importance(rows, n=2**31 - 1, sample_on=["l_orderkey"])
    # As many rows as a vector has positions.
    weights = [(row["feature"], row["importance"]) for row in ranked.collect()]
    total = math.isclose(sum(w for _, w in weights), 1)
    above = [1.0] + [w for _, w in weights]
    fits = [(name, bool(total and 0 <= w <= most)) for (name, w), most in zip(weights, above)]
    return spark.createDataFrame(fits, "feature string, weight_fits boolean")


_REQUIRED = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
#: Requests give the year of early orders only, and the country of one nation's.
_GIVEN = {"Year": "Year < 1996", "Country": "Country = 'NATION_3'", "Gender": "Gender = 'none'"}


@query(
    "missing_features",
    f"WITH {HEALTH_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS feature, count(*) AS n_given, count(*) > 0 AS present FROM health "
        f"WHERE {_GIVEN.get(name, 'true')}"
        for name in _REQUIRED
    ),
)
def missing_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract of encoders fitted to the health frame, against requests that leave fields out: a
    field is there if any request has it."""
    rows = health(spark, sf_dir).select(*_REQUIRED)
    model = Pipeline(
        stages=features.encoding_stages(NUMERIC_FEATURES, CATEGORICAL_FEATURES)
    ).fit(rows)
    numeric, categorical = features.required_features(model)
    given = rows.select(
        *[F.when(F.expr(_GIVEN.get(name, "true")), F.col(name)).alias(name) for name in rows.columns]
    )
    requests = given.select(F.to_json(F.struct("*")).alias("value"))
    keys = requests.select(F.explode(F.json_object_keys("value")).alias("feature"))
    counts = {r["feature"]: r["n_given"] for r in keys.groupBy("feature").agg(F.count("*").alias("n_given")).collect()}
    absent = features.missing_features(model, list(counts))
    return spark.createDataFrame(
        [(name, counts.get(name, 0), name not in absent) for name in [*numeric, *categorical]],
        "feature string, n_given bigint, present boolean",
    )
