"""Driver queries: tracking, registry, artifact catalog and scoring."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from scorewell.functions.scalars import STATUS_SUCCESS
from scorewell.operators import catalog as C
from scorewell.operators import tracking as TR
from scorewell.operators.encoding import Feature
from scorewell.operators.ranking import ordered_position
from scorewell.operators.scoring import (GroupMeanModel, sample_record, score, score_fallback,
                                         score_python_model)
from scorewell.plans.flagship import fit_and_predict
from scorewell.plans.registry import memo, query
from scorewell.plans.serving import score_from_registry
from scorewell.plans.training import TrainParams, register_run, run_pipeline
from scorewell.session import scratch_path, table
from scorewell.sources.files import path_has_data
from scorewell.sources.models import save_model
from scorewell.streaming.scoring import read_stream, start_record_scoring, start_scoring

# ---------------------------------------------------------------- tracking

# Runs: one simple regression (l_extendedprice ~ l_quantity) per
# (l_returnflag, l_linenumber); experiment = return flag.
_RUNS_CTE = """
runs AS (
  SELECT 'flag_' || l_returnflag AS experiment, 'line_' || CAST(l_linenumber AS VARCHAR) AS run_name,
         md5('flag_' || l_returnflag || '/' || 'line_' || CAST(l_linenumber AS VARCHAR)) AS run_id,
         min(l_linenumber) AS ord, count(*) AS n,
         regr_r2(l_extendedprice, l_quantity) AS r2,
         sqrt(greatest(0.0, (1 - regr_r2(l_extendedprice, l_quantity)) * var_pop(l_extendedprice))) AS rmse
  FROM lineitem GROUP BY l_returnflag, l_linenumber)"""


def _runs(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return TR.grouped_regression_runs(
        li, F.concat(F.lit("flag_"), "l_returnflag"),
        F.concat(F.lit("line_"), F.col("l_linenumber").cast("string")),
        "l_quantity", "l_extendedprice", order=F.col("l_linenumber"))


def _logged_runs(spark, sf_dir):
    """Runs appended to tracking tables, read back (as a tracker would)."""
    def build():
        root = scratch_path(spark, "tracking")
        runs, metrics = _runs(spark, sf_dir)
        TR.log_runs(root, runs, metrics)
        return root
    root = memo(spark, sf_dir, "tracking", build)
    return TR.read_table(spark, root, TR.RUNS), TR.read_table(spark, root, TR.METRICS)


@query("tracking_runs", f"""
WITH {_RUNS_CTE}
SELECT experiment, run_id, run_name, round(r2, 6) AS test_r2, round(rmse, 4) AS test_rmse FROM runs""")
def tracking_runs(spark, sf_dir):
    """Runs and metrics appended and read back, metrics pivoted."""
    runs, metrics = _logged_runs(spark, sf_dir)
    wide = metrics.groupBy("run_id").agg(
        F.max(F.when(F.col("key") == "test_r2", F.col("value"))).alias("r2"),
        F.max(F.when(F.col("key") == "test_rmse", F.col("value"))).alias("rmse"))
    return runs.join(wide, "run_id").select(
        "experiment", "run_id", "run_name", F.round("r2", 6).alias("test_r2"),
        F.round("rmse", 4).alias("test_rmse"))


@query("best_run", f"""
WITH {_RUNS_CTE}
SELECT experiment, run_id, run_name, round(r2, 6) AS test_r2 FROM runs
WHERE experiment = 'flag_A' ORDER BY r2 DESC NULLS LAST, ord DESC, run_id LIMIT 1""")
def best_run(spark, sf_dir):
    """Best run of one experiment by test_r2."""
    runs, metrics = _logged_runs(spark, sf_dir)
    b = TR.best_run(runs, metrics, "flag_A", "test_r2")
    return b.select("experiment", "run_id", "run_name", F.round("metric", 6).alias("test_r2"))


@query("best_run_per_group", f"""
WITH {_RUNS_CTE}
SELECT experiment, run_id, run_name, round(r2, 6) AS test_r2 FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY r2 DESC NULLS LAST, ord DESC, run_id) AS rk
  FROM runs) t WHERE rk = 1""")
def best_run_per_group(spark, sf_dir):
    """T3 per experiment, as one partial aggregate."""
    runs, metrics = _logged_runs(spark, sf_dir)
    b = TR.best_run_per_experiment(runs, metrics, "test_r2")
    return b.select("experiment", "run_id", "run_name", F.round("metric", 6).alias("test_r2"))


_REGISTRY_SQL = f"""
WITH {_RUNS_CTE},
reg AS (SELECT 'model_' || experiment AS name,
               CAST(row_number() OVER (PARTITION BY experiment ORDER BY ord, run_id) AS INTEGER) AS version,
               run_id, 'runs/' || run_id || '/model' AS path FROM runs)"""


def _registry(spark, sf_dir):
    runs, _ = _logged_runs(spark, sf_dir)
    first = runs.where(F.col("run_name") <= "line_3")
    rest = runs.where(F.col("run_name") > "line_3")
    name = F.concat(F.lit("model_"), F.col("experiment"))
    v1 = TR.register_versions(first, name)
    v2 = TR.register_versions(rest, name, existing=v1)
    return v1.unionByName(v2)


@query("registry_versions", _REGISTRY_SQL + "\nSELECT name, version, run_id, path FROM reg")
def registry_versions(spark, sf_dir):
    """T4: two registration batches; versions continue after the first."""
    return _registry(spark, sf_dir)


@query("registry_latest", _REGISTRY_SQL + """
SELECT name, max(version) AS version, arg_max(path, version) AS path, arg_max(run_id, version) AS run_id
FROM reg GROUP BY name""")
def registry_latest(spark, sf_dir):
    """T5: ``models:/<name>/latest`` per name."""
    return TR.latest_versions(_registry(spark, sf_dir))


# ---------------------------------------------------------------- artifact catalog

_FLAVOR_SQL = ("CASE substr(experiment, 6, 1) WHEN 'A' THEN 'mlflow.spark' "
               "WHEN 'N' THEN 'mlflow.sklearn' ELSE 'mlflow.pyfunc.model' END")


def _catalog(spark, sf_dir):
    """Manifests written by Spark for every logged run, then scanned."""
    def build():
        runs, _ = _runs(spark, sf_dir)
        flavor = (F.when(F.substring("experiment", 6, 1) == "A", F.lit(C.SPARK_FLAVOR))
                  .when(F.substring("experiment", 6, 1) == "N", F.lit(C.SKLEARN_FLAVOR))
                  .otherwise(F.lit("mlflow.pyfunc.model")))
        created = F.date_format("start_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        m = runs.select("run_id", C.manifest_text(flavor, F.lit("3.13.1"), F.col("n"),
                                                  F.col("run_id"), created).alias("manifest"))
        root = scratch_path(spark, "manifests")
        C.write_manifests(m, root)
        return root
    root = memo(spark, sf_dir, "manifests", build)
    return C.manifest_catalog(spark, root, file_glob="*.txt")


@query("manifest_catalog", f"""
WITH {_RUNS_CTE}
SELECT run_id, {_FLAVOR_SQL} AS loader_module, '3.13.1' AS python_version, n AS model_size_bytes
FROM runs""")
def manifest_catalog(spark, sf_dir):
    """binaryFile scan of manifests + field extraction."""
    return _catalog(spark, sf_dir).select("run_id", "loader_module", "python_version",
                                          "model_size_bytes")


_RANK_SQL = f"""
WITH {_RUNS_CTE},
cat AS (SELECT run_id, ord, {_FLAVOR_SQL} AS loader_module FROM runs),
ok AS (SELECT *, CASE loader_module WHEN 'mlflow.spark' THEN 0 WHEN 'mlflow.sklearn' THEN 2 ELSE 1 END
              AS flavor_rank FROM cat WHERE loader_module <> 'mlflow.sklearn'),
ranked AS (SELECT run_id, loader_module, flavor_rank,
  row_number() OVER (ORDER BY flavor_rank, ord DESC, run_id) - 1 AS position FROM ok)"""


def _ranked(spark, sf_dir):
    cat = _catalog(spark, sf_dir)
    ranked = C.rank_artifacts(cat.withColumn("_created", F.col("utc_time_created")),
                              load_spark=True, time_col="_created")
    return ranked


@query("artifact_rank", _RANK_SQL + "\nSELECT run_id, loader_module, flavor_rank, position FROM ranked")
def artifact_rank(spark, sf_dir):
    """Spark-mode order (spark, other; sklearn dropped), newest first."""
    r = _ranked(spark, sf_dir)
    return r.select("run_id", "loader_module", F.col("flavor_rank").cast("int").alias("flavor_rank"),
                    "position")


def _model_dirs(cat):
    return cat.where(F.col("loader_module") == C.SPARK_FLAVOR).select(
        "run_id", F.col("artifact_dir").alias("path"), F.col("utc_time_created").alias("mtime"))


@query("resolve_model", _RANK_SQL + """
SELECT 'model_dir' AS source, run_id, CAST(0 AS BIGINT) AS position FROM cat
WHERE loader_module = 'mlflow.spark' ORDER BY ord DESC, run_id LIMIT 1""")
def resolve_model(spark, sf_dir):
    """A name the registry does not hold falls to the newest model folder."""
    latest = TR.latest_versions(_registry(spark, sf_dir))
    dirs = _model_dirs(_catalog(spark, sf_dir))
    best = C.resolve_model(latest, dirs, _ranked(spark, sf_dir), "model_flag_unknown")
    return best.select("source", "run_id", "position")


@query("model_candidates", _REGISTRY_SQL.replace("WITH ", "WITH ", 1) + f""",
cat AS (SELECT run_id, ord, {_FLAVOR_SQL} AS loader_module FROM runs),
ok AS (SELECT *, CASE loader_module WHEN 'mlflow.spark' THEN 0 WHEN 'mlflow.sklearn' THEN 2 ELSE 1 END
              AS flavor_rank FROM cat WHERE loader_module <> 'mlflow.sklearn'),
ranked AS (SELECT run_id, row_number() OVER (ORDER BY flavor_rank, ord DESC, run_id) - 1 AS position
           FROM ok),
latest AS (SELECT run_id FROM reg WHERE name = 'model_flag_N' ORDER BY version DESC LIMIT 1),
newest AS (SELECT run_id FROM cat WHERE loader_module = 'mlflow.spark' ORDER BY ord DESC, run_id LIMIT 1),
c AS (SELECT 0 AS source_rank, 'registry' AS source, run_id, 0 AS position FROM latest
      UNION ALL SELECT 1, 'model_dir', run_id, 0 FROM newest
      UNION ALL SELECT 2, 'artifact', run_id, position FROM ranked)
SELECT source, run_id, row_number() OVER (ORDER BY source_rank, position) - 1 AS load_order FROM c""")
def model_candidates_q(spark, sf_dir):
    """Every candidate in load order -- registry latest, newest Spark
    model folder, then ranked artifacts; ``load_order`` 0 is tried first."""
    ranked = _ranked(spark, sf_dir)
    model_dirs = _model_dirs(_catalog(spark, sf_dir))
    latest = TR.latest_versions(_registry(spark, sf_dir))
    cands = C.model_candidates(latest, model_dirs, ranked, "model_flag_N").withColumn("_all", F.lit(0))
    ordered = ordered_position(cands, "_all", [F.col("source_rank").asc(), F.col("position").asc()],
                               name="load_order")
    return ordered.select("source", "run_id", "load_order")


@query("readiness", f"""
WITH {_RUNS_CTE}
SELECT count(*) AS n_artifacts, bool_or({_FLAVOR_SQL} = 'mlflow.spark') AS spark_artifacts_present,
       true AS preprocessor_present, 'spark' AS model_type, true AS model_loaded FROM runs""")
def readiness(spark, sf_dir):
    """Readiness summary of the catalog; the preprocessor is looked for on disk."""
    prep, _ = _event_model(spark, sf_dir)
    path = scratch_path(spark, "readiness_preprocessor")
    save_model(prep, path)
    return C.readiness(_catalog(spark, sf_dir), F.lit(path_has_data(spark, path)))


# ---------------------------------------------------------------- scoring

EVENT_FEATURE = Feature("risk_score", "score")


def _events(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.withColumn("risk_score", F.least(F.floor(F.col("value") / 10), F.lit(10)))


def _event_model(spark, sf_dir):
    def build():
        prep, lr, _ = fit_and_predict(_events(spark, sf_dir), [EVENT_FEATURE], "value")
        return prep, lr
    return memo(spark, sf_dir, "events1", build)


_BAND = ("CASE WHEN probability < 0.35 THEN 'LOW RISK' WHEN probability < 0.65 THEN 'MODERATE RISK' "
         "ELSE 'CRITICAL RISK' END")
_SCORE_SQL = f"""
WITH e AS (SELECT event_id, value, least(floor(value / 10), 10) AS s FROM events),
m AS (SELECT s, avg(value) AS mu FROM e GROUP BY s),
p AS (SELECT e.event_id,
        round(greatest(0.0, least(1.0, CASE WHEN mu > 1 AND mu <= 100 THEN mu / 100 ELSE mu END)), 4)
        AS probability FROM e JOIN m ON e.s = m.s)
SELECT event_id, probability, 'success' AS status, {_BAND} AS band, {{unseen}} AS n_unseen FROM p"""

_SCORE_COLS = ["event_id", "probability", "status", "band", "n_unseen"]


@query("score_batch", _SCORE_SQL.format(unseen="0"))
def score_batch(spark, sf_dir):
    """Batch scoring; one narrow stage after the (small) model fit."""
    prep, lr = _event_model(spark, sf_dir)
    return score(_events(spark, sf_dir), prep, lr, keep=["event_id"], compiled=True).select(*_SCORE_COLS)


_GAPS = "CASE event_id % 10 WHEN 3 THEN NULL WHEN 7 THEN 99 ELSE least(floor(value / 10), 10) END"


@query("score_unseen", f"""
WITH e AS (SELECT event_id, value, least(floor(value / 10), 10) AS s FROM events),
m AS (SELECT s, avg(value) AS mu FROM e GROUP BY s),
g AS (SELECT event_id, {_GAPS} AS s FROM events)
SELECT g.event_id, CAST(m.s IS NULL AS INTEGER) AS n_unseen,
       CASE WHEN m.s IS NOT NULL THEN round(greatest(0.0, least(1.0, CASE WHEN mu > 1 AND mu <= 100
         THEN mu / 100 ELSE mu END)), 4) END AS probability
FROM g LEFT JOIN m ON g.s = m.s""")
def score_unseen(spark, sf_dir):
    """Null and unseen features are counted; they take the intercept, whose
    split from the coefficients is not unique, so only its count is shown."""
    prep, lr = _event_model(spark, sf_dir)
    ev = _events(spark, sf_dir).withColumn("risk_score", F.expr(
        "CASE event_id % 10 WHEN 3 THEN NULL WHEN 7 THEN 99 ELSE risk_score END"))
    out = score(ev, prep, lr, keep=["event_id"])
    return out.select("event_id", "n_unseen", F.when(F.col("n_unseen") == 0, F.col("probability")).alias(
        "probability"))


@query("score_registry", """
WITH t AS (SELECT l_linenumber, l_extendedprice AS y,
                  ('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8))::BIGINT < 0.8 * 4294967296 AS is_train
           FROM lineitem),
m AS (SELECT l_linenumber, avg(y) AS mu FROM t WHERE is_train GROUP BY l_linenumber)
SELECT t.l_linenumber, count(*) AS n, round(any_value(mu), 0) AS avg_prediction, 'run' AS source
FROM t JOIN m ON t.l_linenumber = m.l_linenumber GROUP BY t.l_linenumber""")
def score_registry(spark, sf_dir):
    """T8 + P1: the registry's latest version has a broken path, so the newest
    run's artifact is loaded and scores the whole table."""
    root = scratch_path(spark, "score_registry")
    res = run_pipeline(spark, TrainParams(
        sources=[os.path.join(sf_dir, "lineitem.parquet")], root=root, features=[Feature("l_linenumber")],
        target="l_extendedprice", split="hash:l_orderkey", experiment="lineitem", model_name="price"))
    broken = {"run_id": res["run_id"], "artifact_path": f"{root}/artifacts/lost/model"}
    register_run(spark, root, broken, "price")
    source, scored = score_from_registry(spark, root, table(spark, sf_dir, "lineitem"), "price",
                                         keep=["l_linenumber"])
    return scored.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("prediction"), 0).alias("avg_prediction")
    ).withColumn("source", F.lit(source))


@query("registry_by_name", f"""
WITH {_RUNS_CTE},
best AS (SELECT run_id FROM runs WHERE experiment = 'flag_A' ORDER BY r2 DESC NULLS LAST, ord DESC, run_id LIMIT 1)
SELECT v.name, CAST(v.version AS INTEGER) AS version, best.run_id
FROM best, (VALUES ('first', 1), ('first', 2), ('second', 1)) AS v(name, version)""")
def registry_by_name(spark, sf_dir):
    """T4: every registration is a new version of its name, whatever other names hold."""
    root = scratch_path(spark, "registry_by_name")
    runs, metrics = _logged_runs(spark, sf_dir)
    best = TR.best_run(runs, metrics, "flag_A").first()
    for name in ("first", "second", "first"):
        register_run(spark, root, best, name)
    return TR.read_table(spark, root, TR.VERSIONS).select("name", "version", "run_id")


@query("best_run_edges", f"""
WITH {_RUNS_CTE},
x AS (SELECT experiment, run_id, CASE WHEN ord % 3 = 0 THEN NULL WHEN ord % 3 = 1 THEN r2 END AS v, ord FROM runs)
SELECT experiment, run_id FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY v DESC NULLS LAST, ord DESC, run_id) AS rk
  FROM x) t WHERE rk = 1""")
def best_run_edges(spark, sf_dir):
    """NaN and missing metrics come last, a metric logged again counts once, as logged last."""
    runs, metrics = _logged_runs(spark, sf_dir)
    m = metrics.where("key = 'test_r2'").join(runs.select("run_id", F.substring("run_name", 6, 9).cast(
        "int").alias("ord")), "run_id").where("ord % 3 <> 0")
    again = m.withColumn("logged_at", F.lit("2000-01-01").cast("timestamp")).withColumn("value", F.lit(9.0))
    m = m.withColumn("value", F.when(F.col("ord") % 3 == 2, F.lit(float("nan"))).otherwise(F.col("value")))
    best = TR.best_run_per_experiment(runs, again.unionByName(m).drop("ord"))
    return best.select("experiment", "run_id")


@query("score_pandas", _SCORE_SQL.format(unseen="CAST(NULL AS INTEGER)"))
def score_pandas(spark, sf_dir):
    """A plain Python model through Arrow batches (mapInPandas)."""
    ev = _events(spark, sf_dir)
    model = memo(spark, sf_dir, "events_py",
                 lambda: GroupMeanModel.fit(ev, EVENT_FEATURE, "value"))
    return score_python_model(ev, model, [EVENT_FEATURE], keep=["event_id"]).select(*_SCORE_COLS)


@query("score_fallback", """
SELECT event_id, CAST(0.5 AS DOUBLE) AS probability, 'fallback' AS status, 'DEMO VALUE' AS band,
       CAST(NULL AS INTEGER) AS n_unseen FROM events""")
def score_fallback_q(spark, sf_dir):
    """No model -> 0.5 / fallback for every row."""
    return score_fallback(table(spark, sf_dir, "events"), keep=["event_id"]).select(*_SCORE_COLS)


@query("score_stream", _SCORE_SQL.format(unseen="0"))
def score_stream(spark, sf_dir):
    """The same scoring as a Structured Streaming query (availableNow)."""
    prep, lr = _event_model(spark, sf_dir)
    schema = table(spark, sf_dir, "events").schema
    out = scratch_path(spark, "score_stream_out")
    ck = scratch_path(spark, "score_stream_ckpt")
    stream = read_stream(spark, os.path.abspath(sf_dir), schema, file_glob="events.parquet")
    stream = stream.withColumn("risk_score", F.least(F.floor(F.col("value") / 10), F.lit(10)))
    q = start_scoring(stream, prep, lr, out, ck, keep=["event_id"])
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out).select(*_SCORE_COLS)


@query("score_sample", f"""
WITH e AS (SELECT value, least(floor(value / 10), 10) AS s FROM events),
m AS (SELECT round(greatest(0.0, least(1.0, CASE WHEN avg(value) > 1 AND avg(value) <= 100
        THEN avg(value) / 100 ELSE avg(value) END)), 4) AS probability FROM e WHERE s = 5)
SELECT probability, '{STATUS_SUCCESS}' AS status, {_BAND} AS band, 0 AS n_unseen FROM m""")
def score_sample(spark, sf_dir):
    """P5: a record with every feature = 5 through the fitted model."""
    prep, lr = _event_model(spark, sf_dir)
    rec = sample_record(spark, prep, 5.0)
    return score(rec, prep, lr).select("probability", "status", "band", "n_unseen")



@query("score_records_stream", f"""
WITH e AS (SELECT event_id, event_type, value, least(floor(value / 10), 10) AS s FROM events),
m AS (SELECT s, avg(value) AS mu FROM e GROUP BY s),
p AS (SELECT e.event_id, e.event_type,
        round(greatest(0.0, least(1.0, CASE WHEN mu > 1 AND mu <= 100 THEN mu / 100 ELSE mu END)), 4)
        AS probability FROM e JOIN m ON e.s = m.s)
SELECT event_id, probability, 'success' AS status, {_BAND} AS band, 0 AS n_unseen
FROM p WHERE event_type <> 'error'
UNION ALL
SELECT event_id, CAST(NULL AS DOUBLE) AS probability, 'rejected' AS status,
       'not a number: risk_score' AS band, CAST(NULL AS INTEGER) AS n_unseen
FROM e WHERE event_type = 'error'""")
def score_records_stream(spark, sf_dir):
    """P4 + S7: JSON records derived from ``events`` (error events carry a
    non-numeric score) stream through validation; valid rows are scored,
    rejects keep their reason (reported in ``band``)."""
    prep, lr = _event_model(spark, sf_dir)
    src = scratch_path(spark, "records_src")
    ev = _events(spark, sf_dir)
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(
        F.col("risk_score").cast("int").cast("string"))
    ev.select(F.col("event_id").cast("string").alias("event_id"),
              text.alias("risk_score")).write.mode("overwrite").json(src)
    out, rej, ck = (scratch_path(spark, "records_out"), scratch_path(spark, "records_rej"),
                    scratch_path(spark, "records_ckpt"))
    q = start_record_scoring(spark, src, ["event_id"], ["risk_score"], prep, lr, out, rej, ck)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    scored = spark.read.parquet(out).select(
        F.col("event_id").cast("bigint").alias("event_id"), "probability", "status", "band",
        "n_unseen")
    rejects = spark.read.parquet(rej).select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.lit(None).cast("double").alias("probability"), F.lit("rejected").alias("status"),
        F.col("error").alias("band"), F.lit(None).cast("int").alias("n_unseen"))
    return scored.unionByName(rejects)
