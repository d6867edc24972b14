"""Scoring jobs (P1-P3, P5): table in, table out.

``score`` is narrow: coercion, index lookup, one-hot, assembly and the
linear model are a chain of projections inside one whole-stage-codegen
span, so scoring never shuffles and scales with the number of input
partitions.  The probability, status, band and ``n_unseen`` columns are
plain expressions.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewell.functions.scalars import (FALLBACK_PROBABILITY, STATUS_FALLBACK,
                                         STATUS_SUCCESS, coerce_category,
                                         normalize_probability, risk_band, round4)
from scorewell.operators.compiled import (can_compile, prediction_expression,
                                          unseen_expression)
from scorewell.operators.encoding import (Feature, as_features, preprocessor_features,
                                          unseen_count)
from scorewell.operators.regression import PREDICTION
from scorewell.session import ship_package


# Largest pickled Python model that is broadcast to executors.
MAX_MODEL_BYTES = 512 << 20


def _finish(df: DataFrame, keep: Sequence[str], raw: str, status: str, n_unseen) -> DataFrame:
    prob = round4(normalize_probability(F.col(raw)))
    return df.select(
        *keep,
        F.col(raw).alias(PREDICTION),
        prob.alias("probability"),
        F.lit(status).alias("status"),
        risk_band(prob, F.lit(status)).alias("band"),
        n_unseen.alias("n_unseen"),
    )


def score(df: DataFrame, preprocessor: PipelineModel | None, model: Transformer | None,
          keep: Sequence[str] = (), compiled: bool = False) -> DataFrame:
    """Coerce -> preprocess -> predict -> normalise -> round -> band.

    ``preprocessor.transform`` then ``model.transform``; with ``compiled`` a
    linear model is evaluated as inlined Catalyst expressions instead
    (``operators.compiled``, same doubles), which suits small label sets.

    No model -> fallback rows (P3).  A model without its preprocessor is an
    error raised before any job runs (K11).
    """
    if model is None:
        return score_fallback(df, keep)
    if preprocessor is None:
        raise RuntimeError("preprocessor not found for the Spark model")
    feats = preprocessor_features(preprocessor)
    missing = [f.name for f in feats if f.name not in df.columns]
    if missing:
        raise ValueError(f"records lack required features: {missing}")
    if compiled and can_compile(preprocessor, model):
        scored = df.withColumn(PREDICTION, prediction_expression(preprocessor, model))
        return _finish(scored, keep, PREDICTION, STATUS_SUCCESS, unseen_expression(preprocessor))
    scored = model.transform(preprocessor.transform(df))
    return _finish(scored, keep, PREDICTION, STATUS_SUCCESS, unseen_count(preprocessor))


def score_fallback(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Constant 0.5 with ``status='fallback'`` for every row."""
    return _finish(df.withColumn("_fallback", F.lit(FALLBACK_PROBABILITY)), keep,
                   "_fallback", STATUS_FALLBACK, F.lit(None).cast("int"))


def score_python_model(df: DataFrame, model, features: Sequence[Feature | str],
                       keep: Sequence[str] = ()) -> DataFrame:
    """Score with any Python object exposing ``predict(pandas_frame)``.

    Coercion to category text stays in the JVM; only the feature columns
    cross to Python, in Arrow batches (``mapInPandas``).  The model is
    shipped once per executor as a broadcast variable.  A scalar result is
    repeated for the whole batch, a sequence is taken row by row.
    """
    # cloudpickle handles models defined in notebooks or functions; the
    # payload size is checked before it is broadcast to every executor
    payload = cloudpickle.dumps(model)
    if len(payload) > MAX_MODEL_BYTES:
        raise ValueError(f"model pickles to {len(payload)} bytes; limit {MAX_MODEL_BYTES}")
    bmodel = df.sparkSession.sparkContext.broadcast(payload)
    return score_with(df, lambda: pickle.loads(bmodel.value), features, keep)


def score_with(df: DataFrame, load: Callable[[], object], features: Sequence[Feature | str],
               keep: Sequence[str] = ()) -> DataFrame:
    """P2 with a model that each task gets from ``load``."""
    feats = as_features(features)
    names = [f.name for f in feats]
    prepared = df.select(*keep, *[
        (coerce_category(f.name) if f.kind == "score" else F.col(f.name).cast("string")).alias(f.name)
        for f in feats])
    ship_package(df.sparkSession)
    keep_fields = [prepared.schema[k] for k in keep]
    out_schema = T.StructType([*keep_fields, T.StructField("_raw", T.DoubleType())])

    def run(batches):
        m = load()
        for pdf in batches:
            preds = m.predict(pdf[names])
            if hasattr(preds, "__len__"):
                values = np.asarray(preds, dtype="float64").reshape(-1)  # by place, not by index
                if len(values) != len(pdf):
                    raise ValueError(f"{len(values)} predictions for {len(pdf)} rows")
            else:
                values = pd.Series(float(preds), index=pdf.index, dtype="float64")
            out = pdf[list(keep)].copy()
            out["_raw"] = values
            yield out

    raw = prepared.mapInPandas(run, out_schema)
    return _finish(raw, keep, "_raw", STATUS_SUCCESS, F.lit(None).cast("int"))


class GroupMeanModel:
    """Plain Python model: mean label per level of one categorical feature.

    Fitted by Spark (``groupBy().avg()``), held as a small dict; the number
    of levels is checked before it is collected.
    """

    MAX_LEVELS = 1_000_000

    def __init__(self, feature: str, means: dict[str, float], default: float):
        self.feature = feature
        self.means = means
        self.default = default

    @classmethod
    def fit(cls, df: DataFrame, feature: Feature, label: str) -> "GroupMeanModel":
        text = (coerce_category(feature.name) if feature.kind == "score"
                else F.col(feature.name).cast("string"))
        levels = (df.select(text.alias("level"), F.col(label).cast("double").alias("y"))
                  .groupBy("level").agg(F.avg("y").alias("mean"), F.count(F.lit(1)).alias("n")))
        rows = levels.limit(cls.MAX_LEVELS + 1).collect()
        if len(rows) > cls.MAX_LEVELS:
            raise ValueError("too many levels for an in-memory model")
        total_n = sum(r["n"] for r in rows)
        default = sum(r["mean"] * r["n"] for r in rows) / total_n if total_n else 0.0
        return cls(feature.name, {r["level"]: r["mean"] for r in rows if r["level"] is not None},
                   default)

    def predict(self, pdf: pd.DataFrame):
        return pdf[self.feature].map(self.means).fillna(self.default).to_numpy()


def sample_record(spark, preprocessor: PipelineModel, value: float = 5.0) -> DataFrame:
    """P5: one record with every feature set to ``value``, rounded half-even to
    integer text as served (a category fitted on integers knows no ``5.0``)."""
    feats = preprocessor_features(preprocessor)
    schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in feats])
    return spark.createDataFrame([[str(int(round(value)))] * len(feats)], schema)
