"""Linear regression on categories of any size, as tables.

A one-hot regression is additive: intercept plus one coefficient for each
feature's level.  With many levels neither a vector nor a model fits in a
task, so both stay tables:

* **Fit** by block-wise backfitting.  Rows fold into cells (one per
  combination of levels: count and label sum), a partial aggregation.  For one
  feature after the other the mean residual of each level, an aggregation
  again, is added to its coefficient and joined back to the cells.  Each step
  is an exact least-squares step on its block, so the squared error never
  rises and the fixed point is the least-squares fit; there the mean
  prediction of every level is its mean label.
* **Score** by one join a feature: a row stays one row, meets the levels of one
  feature after the other and adds up their coefficients, so rows are never
  multiplied nor sorted.

In scoring, a feature of few levels is broadcast, and one of many is shuffled
and hashed by partition; adaptive execution splits a hot level.  The joins of
the fit are left to Spark.  The driver sees one number a step, and two a
feature in scoring.

The coefficient table has feature, value, coefficient.  A row with a null
value is the slot of null and unseen levels; the intercept is a feature of its
own (``gram.INTERCEPT``).  ``gram.fit_gram`` and ``coefficient_table`` give
the same form, so any linear model can be scored this way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.operators.encoding import Feature, as_features, indexer_of, preprocessor_features
from scorewell.operators.gram import COEFFICIENTS, INTERCEPT
from scorewell.operators.regression import PREDICTION
from scorewell.session import scratch_path

#: Levels of a feature that are sent to all tasks in scoring, at most.
FEW_LEVELS = 1 << 15


def fit_additive(df: DataFrame, features: Sequence[Feature | str], label: str, tol: float = 1e-8,
                 max_sweeps: int = 100) -> DataFrame:
    """M6: coefficient table of the least-squares fit.

    ``tol``: the fit stands when no level's mean residual is larger than this
    share of the label's standard deviation in a whole sweep; one that does
    not get there in ``max_sweeps`` is an error.  Rows with a null label are
    left out; a table without any gives an intercept of 0.
    """
    feats = as_features(features)
    spark, root = df.sparkSession, scratch_path(df.sparkSession, "additive")

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    levels = [f"f{i}" for i in range(len(feats))]
    rows = df.select(*[F.expr(f.coerce_sql()).alias(c) for f, c in zip(feats, levels)],
                     F.col("`" + label.replace("`", "``") + "`").cast("double").alias("y")).where("y is not null")
    cells = written(rows.groupBy(*levels).agg(F.count("y").alias("n"), F.sum("y").alias("y"),
                                              F.sum(F.col("y") * F.col("y")).alias("yy")), "cells")
    whole = cells.agg(F.sum("n").alias("n"), F.sum("y").alias("y"), F.sum("yy").alias("yy")).first()
    mean = whole.y / whole.n if whole.n else 0.0
    least = tol * max(whole.yy / whole.n - mean * mean, 0.0) ** 0.5 if whole.n else 0.0
    # residual sum of a cell; its fit is the same for all of its rows
    cells = cells.select(*levels, "n", (F.col("y") - F.col("n") * mean).alias("rest"))
    steps, sweep = [], 0
    while feats and whole.n:
        worst = 0.0
        for i, (f, c) in enumerate(zip(feats, levels)):
            step = cells.groupBy(c).agg((F.sum("rest") / F.sum("n")).alias("step"))
            step = written(step, f"step{sweep}_{i}")
            steps.append(step.select(F.lit(f.name).alias("feature"), F.col(c).alias("value"),
                                     F.col("step").alias("coefficient")))
            worst = max(worst, step.agg(F.max(F.abs("step"))).first()[0])
            moved = step.withColumnRenamed(c, "level")
            cells = cells.join(moved, cells[c].eqNullSafe(moved["level"])).select(
                *levels, "n", (F.col("rest") - F.col("n") * F.col("step")).alias("rest"))
        cells, sweep = written(cells, f"cells{sweep}"), sweep + 1
        if worst <= least or len(feats) == 1:
            break
        if sweep == max_sweeps:
            raise RuntimeError(f"a level is still off by {worst} after {sweep} sweeps; allow more")
    out = spark.createDataFrame([(INTERCEPT, None, float(mean))], COEFFICIENTS)
    for s in steps:
        out = out.unionByName(s)
    return written(out.groupBy("feature", "value").agg(F.sum("coefficient").alias("coefficient")), "coefficients")


def coefficient_table(preprocessor: PipelineModel, model: LinearRegressionModel) -> DataFrame:
    """The same table from a fitted preprocessor and linear model (which hold
    all labels in memory themselves)."""
    spark = SparkSession.getActiveSession()
    rows, at = [(INTERCEPT, None, float(model.intercept))], 0
    for f, labels in zip(preprocessor_features(preprocessor), indexer_of(preprocessor).labelsArray):
        for value in [*labels, None]:  # the last slot is that of null and unseen values
            rows.append((f.name, value, float(model.coefficients[at])))
            at += 1
    return spark.createDataFrame(rows, COEFFICIENTS)


def score_additive(df: DataFrame, coefficients: DataFrame, features: Sequence[Feature | str],
                   keep: Sequence[str] = (), prediction_col: str = PREDICTION) -> DataFrame:
    """``keep``, prediction and n_unseen of every row.

    A null or unseen level takes its feature's null slot, 0 where it has
    none, and counts in ``n_unseen``.
    """
    feats = as_features(features)
    path = scratch_path(df.sparkSession, "coefficients")
    coefficients.write.parquet(path)
    coefficients = df.sparkSession.read.parquet(path)
    # one row for each feature of the list comes to the driver
    known = {r.feature: r for r in coefficients.where(F.col("feature").isin([INTERCEPT, *[f.name for f in feats]])).groupBy(
        "feature").agg(F.count("value").alias("levels"), F.sum(F.when(F.col("value").isNull(), F.col("coefficient"))).alias("slot")).collect()}

    def slot(name: str) -> Column:
        return F.lit(known[name].slot if name in known and known[name].slot is not None else 0.0)
    kept = [f"k{i}" for i in range(len(keep))]
    at = F.monotonically_increasing_id().cast("string")
    # a null value gets a key of its own that no level has, so nulls do not meet in one task
    rows = df.select(*[F.col("`" + c.replace("`", "``") + "`").alias(k) for c, k in zip(keep, kept)], at.alias("at"),
                     *[F.expr(f.coerce_sql()).alias(f"f{i}") for i, f in enumerate(feats)],
                     slot(INTERCEPT).alias("total"), F.lit(0).alias("unseen"))
    # features of many levels come last, when rows have shed the others
    few = {i for i, f in enumerate(feats) if f.name not in known or known[f.name].levels <= FEW_LEVELS}
    order = sorted(range(len(feats)), key=lambda i: i not in few)
    for done, i in enumerate(order, 1):
        f = feats[i]
        levels = coefficients.where((F.col("feature") == f.name) & F.col("value").isNotNull()).groupBy(
            F.col("value").alias("key"), F.lit(False).alias("none")).agg(F.sum("coefficient").alias("own"))
        # hashed are the levels, each of them once, so rows are not sorted
        levels = levels.hint("broadcast" if i in few else "shuffle_hash")
        value, later = F.col(f"f{i}"), [f"f{j}" for j in order[done:]]
        rows = rows.withColumn("none", value.isNull()).withColumn("key", F.coalesce(value, "at")).join(
            levels, ["key", "none"], "left").select(
                *kept, "at", *later, (F.col("total") + F.coalesce(F.col("own"), slot(f.name))).alias("total"),
                (F.col("unseen") + F.col("own").isNull().cast("int")).alias("unseen"))
    return rows.select(*[F.col(k).alias(c) for c, k in zip(keep, kept)], F.col("total").alias(prediction_col),
                       F.col("unseen").alias("n_unseen"))
