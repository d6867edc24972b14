"""Fitted pipeline and model persistence.

Each save goes to its own path and overwrites (never a second writer into
an existing model folder); paths live on the shared filesystem.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegressionModel


def save_model(model, path: str) -> str:
    """``write().overwrite().save`` so a re-run does not fail."""
    model.write().overwrite().save(path)
    return path


def load_pipeline(path: str) -> PipelineModel:
    """A saved ``PipelineModel``."""
    return PipelineModel.load(path)


def load_linear(path: str) -> LinearRegressionModel:
    """A saved ``LinearRegressionModel``."""
    return LinearRegressionModel.load(path)
