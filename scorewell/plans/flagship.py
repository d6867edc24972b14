"""Flagship: the reference's notebook pipeline as one Spark plan.

drop null targets -> canonical text -> index -> one-hot -> assemble ->
linear regression -> predictions -> per-level calibration table.  The
calibration table is the least-squares check: with a full one-hot block per
feature, the mean prediction of every level equals its mean label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewell.operators.compiled import can_compile, prediction_expression
from scorewell.operators.encoding import (Feature, as_features, cat_col, fit_preprocessor,
                                          preprocessor_features)
from scorewell.operators.regression import PREDICTION, fit_linear
from scorewell.operators.rows import drop_null_rows


def fit_and_predict(df: DataFrame, features: Sequence[Feature | str], target: str, **lr_params):
    """Fit preprocessor + regression on ``df`` and return (prep, lr, predictions)."""
    feats = as_features(features)
    clean = drop_null_rows(df, [target])
    prep = fit_preprocessor(clean, feats)
    prepared = prep.transform(clean).withColumn("label", F.col(target).cast("double"))
    lr = fit_linear(prepared, label_col="label", **lr_params)
    return prep, lr, predictions(clean, prep, lr, target)


def predictions(df: DataFrame, prep, lr, target: str, compiled: bool = True) -> DataFrame:
    """``df`` + canonical text columns + ``label`` + ``prediction``.

    Inlined expressions (same doubles, one codegen stage) unless the caller
    passes ``compiled=False``, as for large label sets: then the ML transforms.
    """
    feats = preprocessor_features(prep)
    if compiled and can_compile(prep, lr):
        return df.select(
            "*", *[F.expr(f.coerce_sql()).alias(cat_col(f.name)) for f in feats],
            F.col(target).cast("double").alias("label"),
            prediction_expression(prep, lr).alias(PREDICTION))
    return lr.transform(prep.transform(df).withColumn("label", F.col(target).cast("double")))


# Relative gap allowed between a level's mean prediction and mean label;
# the default solver tolerance (1e-6) leaves gaps near 3e-7.
CALIBRATION_RTOL = 1e-5


def level_calibration(pred: DataFrame, features: Sequence[Feature], label: str = "label",
                      digits: int = 2) -> DataFrame:
    """``(feature, level, n, avg_label, calibrated)`` for every level.

    ``calibrated``: mean prediction equals mean label within
    ``CALIBRATION_RTOL`` (least-squares residuals sum to zero per level).
    One pass: feature/level pairs are unpivoted and aggregated with
    map-side combine; the output has one row per level.
    """
    cols = [F.col(cat_col(f.name)).alias(f.name) for f in features]
    slim = pred.select(*cols, F.col(label).alias("_y"), F.col(PREDICTION).alias("_p"))
    long = slim.unpivot(ids=["_y", "_p"], values=[f.name for f in features],
                        variableColumnName="feature", valueColumnName="level")
    agg = long.groupBy("feature", "level").agg(
        F.count(F.lit(1)).alias("n"), F.avg("_y").alias("_my"), F.avg("_p").alias("_mp"))
    gap = F.abs(F.col("_mp") - F.col("_my"))
    tol = F.greatest(F.abs(F.col("_my")), F.lit(1.0)) * CALIBRATION_RTOL
    return agg.select("feature", "level", "n", F.round("_my", digits).alias("avg_label"),
                      (gap <= tol).alias("calibrated"))
