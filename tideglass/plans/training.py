"""Train, evaluate and keep the regression model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.operators.cleaning import model_rows
from tideglass.operators.dedup import hash_bucket
from tideglass.operators.features import fit_regression, regression_metrics
from tideglass.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET
from tideglass.session import materialize

FIT_SIDE = "_fit"


@dataclass(frozen=True)
class Training:
    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame


def train(
    silver: DataFrame,
    numeric: list[str] = NUMERIC_FEATURES,
    categorical: list[str] = CATEGORICAL_FEATURES,
    target: str = TARGET,
    pct: int = 80,
    staged: bool = False,
    split_on: Sequence[str] = (),
    **forest,
) -> Training | None:
    """Fit on ``pct`` percent of the complete rows, score and measure the others.

    The fit reads the rows several times. From a table that is a pruned scan each time, which
    survives lost executors. If ``silver`` is the result of joins, ``staged`` writes the rows once,
    with their side of the split, so that the joins run once. No complete rows means no model.

    The split is by a hash of the whole row, or of the columns ``split_on``: rows that agree there stay on
    one side, and the predictions keep those columns.
    """
    features = [*numeric, *categorical]
    if split_on:
        # Model rows must be complete in features and target; what they are split on may be null.
        rows = silver.select(*split_on, *features, target).na.drop(subset=[*features, target])
    else:
        rows = model_rows(silver, features, target)
    rows = rows.withColumn(FIT_SIDE, hash_bucket(split_on or rows.columns) < pct)
    if staged:
        rows = materialize(silver.sparkSession, rows, "model-rows")
    number = rows.count()
    if not number:
        return None
    fit_rows = rows.filter(FIT_SIDE).drop(FIT_SIDE)
    test_rows = rows.filter(~F.col(FIT_SIDE)).drop(FIT_SIDE)
    about = -(-number * pct // 100)
    model = fit_regression(fit_rows, numeric, categorical, target, number=about, **forest)
    predictions = model.transform(test_rows)
    return Training(model, predictions, regression_metrics(predictions, target))
