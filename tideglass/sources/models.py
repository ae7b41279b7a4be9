"""Model folders."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str) -> None:
    """K4: overwrite the model folder."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a fitted pipeline; a missing or broken folder raises."""
    return PipelineModel.load(path)
