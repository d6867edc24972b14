"""Experiment tracking and model registry as Spark tables.

Tables (Parquet, append-only, under a root folder on shared storage):

* ``runs``         experiment, run_id, run_name, start_time, artifact_path
* ``run_metrics``  run_id, key, value, logged_at
* ``metric_info``  key, evaluator_class, labelCol, metricName, predictionCol, throughOrigin
* ``run_params``   run_id, stage, name, value
* ``model_versions`` name, version, run_id, path

Queries over them are joins and aggregates; top-1 per group uses a
``min(struct(...))`` aggregate (partial aggregation, no per-group sort),
and version numbers come from ``ordered_position`` (no single-task window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.operators.ranking import ordered_position

RUNS = "runs"
METRICS = "run_metrics"
PARAMS = "run_params"
INFO = "metric_info"
VERSIONS = "model_versions"


def _fmt(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v)


def param_rows(spark: SparkSession, model, run_id: str | None = None) -> DataFrame:
    """Every explicit or default parameter of an estimator/model."""
    stage = type(model).__name__.removesuffix("Model")
    rows = sorted((stage, p.name, _fmt(v)) for p, v in model.extractParamMap().items())
    df = spark.createDataFrame(rows, "stage string, name string, value string")
    return df if run_id is None else df.select(F.lit(run_id).alias("run_id"), "*")


def metric_definitions(spark: SparkSession) -> DataFrame:
    """How the logged metrics are defined."""
    evaluator = "org.apache.spark.ml.evaluation.RegressionEvaluator"
    return spark.createDataFrame(
        [("test_r2", evaluator, "label", "r2", "prediction", False),
         ("test_rmse", evaluator, "label", "rmse", "prediction", None)],
        "key string, evaluator_class string, labelCol string, metricName string, "
        "predictionCol string, throughOrigin boolean")


def run_id_of(*parts) -> F.Column:
    """Deterministic run id: md5 of the experiment and run name."""
    return F.md5(F.concat_ws("/", *parts))


def grouped_regression_runs(df: DataFrame, experiment: F.Column, run_name: F.Column,
                            x: str, y: str, order: F.Column | None = None
                            ) -> tuple[DataFrame, DataFrame]:
    """T1 source: one simple regression per (experiment, run) group.

    One aggregation pass computes ``test_r2`` and ``test_rmse`` of
    ``y ~ a + b x`` for every group (SQL regression aggregates, map-side
    combined), so thousands of runs cost one job, not one fit each.
    Returns ``(runs, run_metrics)``.
    """
    g = df.select(experiment.alias("experiment"), run_name.alias("run_name"),
                  (order if order is not None else F.lit(0)).alias("_ord"),
                  F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    agg = g.groupBy("experiment", "run_name").agg(
        F.min("_ord").alias("_ord"),
        F.count(F.lit(1)).alias("n"),
        F.regr_r2("_y", "_x").alias("r2"),
        F.regr_slope("_y", "_x").alias("slope"),
        F.regr_intercept("_y", "_x").alias("intercept"),
        F.var_pop("_y").alias("_vy"))
    runs = agg.select(
        "experiment", run_id_of("experiment", "run_name").alias("run_id"), "run_name",
        F.timestamp_seconds(F.col("_ord").cast("bigint")).alias("start_time"),
        F.concat(F.lit("runs/"), run_id_of("experiment", "run_name"), F.lit("/model")).alias("artifact_path"),
        "n", "r2", "slope", "intercept", "_vy")
    metrics = runs.select("run_id", F.posexplode(F.array(
        F.struct(F.lit("test_r2").alias("key"), F.col("r2").alias("value")),
        F.struct(F.lit("test_rmse").alias("key"),
                 F.sqrt(F.greatest(F.lit(0.0), (1 - F.col("r2")) * F.col("_vy"))).alias("value")),
    ))).select("run_id", "col.key", "col.value")
    return runs.drop("_vy"), metrics


def log_runs(root: str, runs: DataFrame, metrics: DataFrame,
             params: DataFrame | None = None) -> None:
    """Append runs, metrics and params (one Parquet folder each)."""
    runs.select("experiment", "run_id", "run_name", "start_time", "artifact_path") \
        .write.mode("append").parquet(f"{root}/{RUNS}")
    at = F.col("logged_at") if "logged_at" in metrics.columns else F.current_timestamp()
    metrics.select("run_id", "key", "value", at.alias("logged_at")).write.mode("append").parquet(f"{root}/{METRICS}")
    if params is not None:
        params.select("run_id", "stage", "name", "value").write.mode("append").parquet(
            f"{root}/{PARAMS}")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}")


def runs_with_metric(runs: DataFrame, metrics: DataFrame, key: str) -> DataFrame:
    """Runs left-joined to one metric (missing metric -> null value)."""
    m = metrics.where(F.col("key") == key)
    # a metric logged again counts as logged last; tables without a time take the largest
    order = F.struct("logged_at", "value") if "logged_at" in m.columns else F.struct("value")
    m = m.groupBy("run_id").agg(F.max_by("value", order).alias("metric"))
    return runs.join(m, "run_id", "left")


def _run_order() -> list[F.Column]:
    """Best first: a number before NaN and null, largest first, newest first
    (unknown start times last), run id; every part ascends."""
    none = F.col("metric").isNull() | F.isnan("metric")
    return [none.alias("_none"), F.when(~none, -F.col("metric")).alias("_neg"),
            F.col("start_time").isNull().alias("_undated"),
            (-F.unix_micros("start_time")).alias("_age"), F.col("run_id")]


def best_run(runs: DataFrame, metrics: DataFrame, experiment: str,
             key: str = "test_r2") -> DataFrame:
    """Best run of one experiment (metric desc, newest, run_id).

    Empty result when the experiment is unknown or has no runs.
    """
    r = runs_with_metric(runs.where(F.col("experiment") == experiment), metrics, key)
    return r.orderBy(*_run_order()).limit(1)


def best_run_per_experiment(runs: DataFrame, metrics: DataFrame,
                            key: str = "test_r2") -> DataFrame:
    """T3 per group: ``min(struct(order keys, payload))`` per experiment.

    The struct is ordered as ``best_run`` orders, so one partial aggregate picks the winner; a hot experiment
    is combined map-side instead of being sorted in one task.
    """
    r = runs_with_metric(runs, metrics, key)
    pick = F.struct(*_run_order(), F.col("run_name"), F.col("metric"), F.col("artifact_path"))
    best = r.groupBy("experiment").agg(F.min(pick).alias("b"))
    return best.select("experiment", "b.run_id", "b.run_name", "b.metric", "b.artifact_path")


def register_versions(candidates: DataFrame, name: F.Column,
                      existing: DataFrame | None = None) -> DataFrame:
    """T4: new registry rows, version = previous max per name + position.

    ``candidates`` carries run_id, artifact_path, start_time; registration
    order is start_time then run_id.  Versions are numbered with a
    distributed position, so a name with very many versions is not sorted
    in one task.
    """
    c = candidates.select(name.alias("name"), "run_id", F.col("artifact_path").alias("path"),
                          "start_time")
    numbered = ordered_position(c, "name", [F.col("start_time").asc(), F.col("run_id").asc()],
                                name="_pos")
    if existing is not None:
        base = existing.groupBy("name").agg(F.max("version").alias("_base"))
        base = base.withColumnRenamed("name", "_name")
        numbered = numbered.join(base, F.col("name").eqNullSafe(F.col("_name")), "left").drop("_name")
    else:
        numbered = numbered.withColumn("_base", F.lit(None).cast("int"))
    return numbered.select(
        "name", (F.coalesce(F.col("_base"), F.lit(0)) + F.col("_pos") + 1).cast("int").alias("version"),
        "run_id", "path")


def latest_versions(registry: DataFrame) -> DataFrame:
    """T5: ``models:/<name>/latest`` for every name (one aggregate)."""
    return registry.groupBy("name").agg(
        F.max("version").alias("version"),
        F.max_by("path", "version").alias("path"),
        F.max_by("run_id", "version").alias("run_id"))
