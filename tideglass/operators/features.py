"""Feature encoding, the feature contract and model quality measures on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel, PredictionModel
from pyspark.ml.feature import (
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.operators.cleaning import cast_to_schema
from tideglass.operators.dedup import sample_rows
from tideglass.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, REQUEST_SCHEMA, TARGET
from tideglass.session import materialize

FEATURES = "features"
INDEX_SUFFIX = "_index"
VECTOR_SUFFIX = "_vec"
#: Rows of one task of a fit: about 0.3 GB where a forest of 20 trees holds them.
FIT_ROWS = 500_000
#: Trees that one fit of a large forest grows: with each row, a fit holds one number per tree, twice as many with
#: node ids. Several fits share the trees.
FIT_TREES = 20
#: MB of sums that one pass of a large forest adds to: a few nodes' worth, so that they stay in a core's cache.
FIT_PASS_MB = 4


class MissingFeatures(ValueError):
    """Scoring input without columns the model needs; ``names`` lists them in order."""

    def __init__(self, names: list[str]):
        super().__init__(f"columns required by the model are missing: {names}")
        self.names = names


def string_indexer(columns: Sequence[str], order: str = "frequencyDesc") -> StringIndexer:
    """M1: all columns indexed in one pass; unseen values and nulls get an extra last index.

    Spark keeps the labels of each column on the driver, and one-hot vectors are as wide as labels
    are many: leave out columns whose values grow with the data.
    """
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[name + INDEX_SUFFIX for name in columns],
        handleInvalid="keep",
        stringOrderType=order,
    )


def one_hot_encoder(columns: Sequence[str]) -> OneHotEncoder:
    """M2: the last index (unseen) is dropped, so unseen values become all-zero vectors."""
    return OneHotEncoder(
        inputCols=[name + INDEX_SUFFIX for name in columns],
        outputCols=[name + VECTOR_SUFFIX for name in columns],
    )


def vector_assembler(numeric: Sequence[str], categorical: Sequence[str]) -> VectorAssembler:
    """M3: numerics, then encoded categoricals. A null numeric raises."""
    return VectorAssembler(
        inputCols=[*numeric, *[name + VECTOR_SUFFIX for name in categorical]], outputCol=FEATURES
    )


def encoding_stages(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    return [
        string_indexer(categorical),
        one_hot_encoder(categorical),
        vector_assembler(numeric, categorical),
    ]


def random_forest(
    target: str = TARGET,
    trees: int = 20,
    depth: int = 5,
    seed: int = 42,
    memory_mb: int = 1024,
) -> RandomForestRegressor:
    """M4: a forest with a pinned seed. More ``memory_mb`` means fewer passes per tree level."""
    return RandomForestRegressor(
        featuresCol=FEATURES,
        labelCol=target,
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        maxMemoryInMB=memory_mb,
    )


def regression_pipeline(
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    target: str = TARGET,
    **forest,
) -> Pipeline:
    """M5: the encoders and the forest in one chain."""
    return Pipeline(
        stages=[*encoding_stages(numeric, categorical), random_forest(target, **forest)]
    )


def fit_regression(
    rows: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    target: str = TARGET,
    number: int | None = None,
    task_rows: int = FIT_ROWS,
    **forest,
) -> PipelineModel:
    """M5: the chain of ``regression_pipeline`` fitted to ``rows`` (``number`` of them, if known).

    A forest reads its input three times and then holds all of it, each task the rows of its partition
    as arrays, which are many times larger than in a file. So many rows are encoded once and dealt evenly
    to tasks of about ``task_rows``, however large the partitions of their files are.
    """
    encoders = Pipeline(stages=encoding_stages(numeric, categorical)).fit(rows)
    encoded = encoders.transform(rows).select(FEATURES, target)
    encoded = _dealt(encoded, rows.count() if number is None else number, task_rows)
    return PipelineModel([*encoders.stages, random_forest(target, **forest).fit(encoded)])


def _dealt(encoded: DataFrame, number: int, task_rows: int) -> DataFrame:
    """The ``number`` rows in even partitions of about ``task_rows``, if they are more than one has."""
    tasks = -(-number // task_rows)
    if tasks <= 1:
        return encoded
    # By a seeded number: as even as round robin, without the sort that makes that repeatable.
    tasks = max(tasks, encoded.sparkSession.sparkContext.defaultParallelism)
    return encoded.repartition(tasks, F.rand(0))


def required_features(model: PipelineModel) -> tuple[list[str], list[str]]:
    """M9: numeric and categorical columns that the fitted stages need and none of them makes."""
    made: set[str] = set()
    numeric: dict[str, None] = {}
    categorical: dict[str, None] = {}
    for stage in model.stages:
        kind = categorical if isinstance(stage, StringIndexerModel) else numeric
        needed = [] if isinstance(stage, PredictionModel) else _columns(stage, "inputCol")
        kind.update(dict.fromkeys(name for name in needed if name not in made))
        made.update(_columns(stage, "outputCol"))
    if not numeric and not categorical:
        raise ValueError("the model has no stage to read its features from")
    return list(numeric), list(categorical)


def _columns(stage, param: str) -> list[str]:
    """Values of a column parameter, in its plural or singular form."""
    for name in (param + "s", param):
        if stage.hasParam(name) and stage.isSet(name):
            value = stage.getOrDefault(name)
            return [value] if isinstance(value, str) else list(value)
    return []


def missing_features(model: PipelineModel, columns: DataFrame | Sequence[str]) -> list[str]:
    """M9: required columns that are absent, sorted."""
    present = columns.columns if isinstance(columns, DataFrame) else columns
    numeric, categorical = required_features(model)
    return sorted({*numeric, *categorical} - set(present))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Check the contract, cast the request columns, add ``prediction``. Batch or stream."""
    absent = missing_features(model, df)
    if absent:
        raise MissingFeatures(absent)
    listed = [field for field in REQUEST_SCHEMA if field.name in df.columns]
    return model.transform(cast_to_schema(df, type(REQUEST_SCHEMA)(listed)))


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Number of rows, RMSE and R2 in one pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    rows = df.select(y.alias("y"), ((y - p) * (y - p)).alias("se"))
    return rows.agg(
        F.count("se").alias("rows"),
        F.sqrt(F.avg("se")).alias("rmse"),
        (1 - F.try_divide(F.sum("se"), F.count("y") * F.var_pop("y"))).alias("r2"),
    )


def feature_names(encoded: DataFrame) -> list[str]:
    """Names of the vector positions, from the column metadata."""
    groups = encoded.schema[FEATURES].metadata["ml_attr"]["attrs"]
    named = {a["idx"]: a["name"] for group in groups.values() for a in group}
    return [named[position] for position in range(len(named))]


def forest_importance(
    encoded: DataFrame, target: str, trees: int, depth: int, seed: int
) -> list[float]:
    """Share of each vector position in what a forest of ``trees`` gains, each tree counting alike.

    The trees do not depend on each other, so they are grown by as many fits as keep each at ``FIT_TREES`` or
    fewer, on all rows. Node ids are kept, so that a pass need not walk each row down each tree again.
    """
    fits = -(-trees // FIT_TREES)
    total = 0.0
    for i in range(fits):
        # Never a fit of one tree among several, which Spark would grow on all features.
        share = trees // fits + (i < trees % fits)
        # Seeds far apart, as a fit draws the rows of its partitions by the numbers after its own.
        forest = random_forest(target, share, depth, seed + i * 1_000_003, FIT_PASS_MB)
        grown = forest.setCacheNodeIds(True).setCheckpointInterval(-1).fit(encoded)
        total = total + sum(tree.featureImportances.toArray() for tree in grown.trees)
    return (total / (total.sum() or 1.0)).tolist()


def feature_importance(
    df: DataFrame,
    target: str = TARGET,
    exclude: Sequence[str] = ("Disease_Name",),
    n: int = 20,
    pct: int = 10,
    trees: int = 100,
    depth: int = 10,
    seed: int = 42,
    sample_on: Sequence[str] = (),
    task_rows: int = FIT_ROWS,
) -> DataFrame:
    """The ``n`` most important features of a forest fitted to a ``pct`` percent sample.

    All text columns are one-hot encoded without their first value in order, all others are
    numeric. The sample is a property of the report; ``pct=100`` fits all rows. It is drawn by a hash of the
    whole row, or of the columns ``sample_on``, which are no features. The vectors are written once, as a
    forest reads them several times, in even partitions of about ``task_rows``.
    """
    kept = [name for name in df.columns if name not in exclude and name not in sample_on]
    rows = df.na.drop(subset=kept)
    if pct < 100:
        rows = sample_rows(rows, sample_on or kept, pct)
    rows = rows.select(kept)
    categorical = [name for name, kind in rows.dtypes if kind == "string" and name != target]
    numeric = [name for name in rows.columns if name not in categorical and name != target]
    rows = materialize(df.sparkSession, rows, "importance-rows")
    stages = []
    if categorical:
        # In descending order the first value comes last, where the encoder drops it.
        indexer = string_indexer(categorical, "alphabetDesc").setHandleInvalid("error")
        stages = [indexer, one_hot_encoder(categorical)]
    stages.append(vector_assembler(numeric, categorical))
    encoded = Pipeline(stages=stages).fit(rows).transform(rows).select(FEATURES, target)
    encoded = _dealt(encoded, rows.count(), task_rows)
    encoded = materialize(df.sparkSession, encoded, "importance-vectors")
    weights = forest_importance(encoded, target, trees, depth, seed)
    ranked = list(zip(feature_names(encoded), weights))
    return (
        df.sparkSession.createDataFrame(ranked, "feature string, importance double")
        .orderBy(F.desc("importance"), "feature")
        .limit(n)
    )
