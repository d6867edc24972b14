"""Linear regression and its evaluation.

Fitting uses ``pyspark.ml.regression.LinearRegression`` with its defaults
unchanged (the reference's parameters): the normal-equation summaries are
built with one ``treeAggregate`` pass, so the data is read once and only a
``d x d`` matrix reaches the driver.  One-hot blocks are collinear with the
intercept, so coefficients are not unique; predictions are (K6).

Metrics are one aggregate pass (optionally grouped) instead of one job per
metric: ``sse = sum((y - p)^2)``, ``sst = var_pop(y) * n``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.operators.encoding import FEATURES

PREDICTION = "prediction"


def linear_regression(features_col: str = FEATURES, label_col: str = "label",
                      prediction_col: str = PREDICTION, **params) -> LinearRegression:
    """M6: the estimator with reference defaults; ``params`` override."""
    return LinearRegression(featuresCol=features_col, labelCol=label_col,
                            predictionCol=prediction_col, **params)


def fit_linear(df: DataFrame, features_col: str = FEATURES, label_col: str = "label",
               persist: bool = False, **params) -> LinearRegressionModel:
    """M6: fit on ``df``; only the needed columns are read.

    The fit reads its input several times (feature statistics, normal
    equations), by default the pruned input columns each time.  With
    ``persist=True`` the two-column training frame is kept (memory, spilling
    to local disk; lost blocks are recomputed) for the duration of the fit.
    """
    data = df.select(features_col, label_col)
    if not persist:
        return linear_regression(features_col, label_col, **params).fit(data)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return linear_regression(features_col, label_col, **params).fit(data)
    finally:
        data.unpersist()


def predict(model: LinearRegressionModel, df: DataFrame) -> DataFrame:
    """M7: narrow transform; adds ``prediction``."""
    return model.transform(df)


def regression_metrics(df: DataFrame, label_col: str = "label",
                       prediction_col: str = PREDICTION,
                       group_cols: Sequence[str] = ()) -> DataFrame:
    """M9 + M10: ``n, sse, rmse, r2`` in one pass, per group if given.

    Rows without a label or a prediction count nowhere.  ``r2`` is ``1 - sse / sst`` with ``throughOrigin=false``; a constant label
    (``sst = 0``) gives null instead of a division error.
    """
    y = F.col(label_col).cast("double")
    p = F.col(prediction_col).cast("double")
    aggs = [
        F.count(y - p).alias("n"),
        F.sum((y - p) * (y - p)).alias("sse"),
        F.var_pop(F.when(p.isNotNull(), y)).alias("_var"),
    ]
    g = df.groupBy(*group_cols) if group_cols else df.groupBy()
    out = g.agg(*aggs)
    sst = F.col("_var") * F.col("n")
    return (out.withColumn("rmse", F.sqrt(F.col("sse") / F.col("n")))
            .withColumn("r2", F.when(sst > 0, 1.0 - F.col("sse") / sst))
            .drop("_var"))
