"""Regression, metrics, scoring (batch, Python model, stream, fallback)."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from scorewell.operators.encoding import Feature
from scorewell.operators.regression import regression_metrics
from scorewell.operators.scoring import (GroupMeanModel, sample_record, score, score_fallback,
                                         score_python_model)
from scorewell.plans.flagship import fit_and_predict, level_calibration
from scorewell.session import scratch_path, table
from scorewell.sources.models import load_linear, load_pipeline, save_model
from scorewell.streaming.scoring import read_stream, start_scoring

FEAT = Feature("risk_score", "score")


def _events(spark, d=SF_CHECK):
    return table(spark, d, "events").withColumn(
        "risk_score", F.least(F.floor(F.col("value") / 10), F.lit(10)))


@pytest.fixture(scope="module")
def event_model(spark):
    prep, lr, pred = fit_and_predict(_events(spark), [FEAT], "value")
    return prep, lr, pred


def test_one_pass_metrics_equal_evaluator(spark, event_model):
    _, _, pred = event_model
    m = regression_metrics(pred).first()
    r2 = RegressionEvaluator(metricName="r2").evaluate(pred)
    rmse = RegressionEvaluator(metricName="rmse").evaluate(pred)
    assert m["r2"] == pytest.approx(r2, rel=1e-9)
    assert m["rmse"] == pytest.approx(rmse, rel=1e-9)


def test_group_mean_property(spark, event_model):
    _, _, pred = event_model
    cal = level_calibration(pred, [FEAT]).collect()
    assert cal and all(r["calibrated"] for r in cal)


def test_score_columns_and_no_shuffle(spark, event_model):
    prep, lr, _ = event_model
    out = score(_events(spark), prep, lr, keep=["event_id"])
    assert out.columns == ["event_id", "prediction", "probability", "status", "band", "n_unseen"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "InMemoryTableScan" not in plan
    r = out.agg(F.min("probability"), F.max("probability"), F.max("n_unseen")).first()
    assert 0.0 <= r[0] <= r[1] <= 1.0 and r[2] == 0


def test_all_unseen_record_predicts_intercept(spark, event_model):
    prep, lr, _ = event_model
    rec = spark.createDataFrame([("99",)], "risk_score string")
    row = score(rec, prep, lr).first()
    assert row["n_unseen"] == 1
    assert row["prediction"] == pytest.approx(lr.intercept, rel=1e-9, abs=1e-9)


def test_model_without_preprocessor_is_an_error(spark, event_model):
    _, lr, _ = event_model
    with pytest.raises(RuntimeError):
        score(_events(spark), None, lr)


def test_fallback(spark):
    out = score_fallback(_events(spark, SF_SMALL), keep=["event_id"])
    r = out.agg(F.countDistinct("probability"), F.max("probability"), F.max("status"),
                F.max("band")).first()
    assert tuple(r) == (1, 0.5, "fallback", "DEMO VALUE")
    assert score(_events(spark, SF_SMALL), None, None).first()["status"] == "fallback"


def test_python_model_equals_spark_model(spark, event_model):
    prep, lr, _ = event_model
    ev = _events(spark)
    py = GroupMeanModel.fit(ev, FEAT, "value")
    a = score(ev, prep, lr, keep=["event_id"]).select("event_id", "probability", "band")
    b = score_python_model(ev, py, [FEAT], keep=["event_id"]).select("event_id", "probability",
                                                                    "band")
    diff = a.join(b, "event_id").where(F.abs(a["probability"] - b["probability"]) > 1e-4)
    assert diff.count() == 0


def test_python_model_scalar_result(spark):
    class Const:
        def predict(self, pdf):
            return 42.0
    out = score_python_model(_events(spark, SF_SMALL), Const(), [FEAT], keep=["event_id"])
    assert out.agg(F.countDistinct("probability")).first()[0] == 1
    assert out.first()["probability"] == 0.42


def test_stream_equals_batch(spark, event_model):
    prep, lr, _ = event_model
    schema = table(spark, SF_CHECK, "events").schema
    out, ck = scratch_path(spark, "t_stream"), scratch_path(spark, "t_ck")
    stream = read_stream(spark, SF_CHECK, schema, file_glob="events.parquet").withColumn(
        "risk_score", F.least(F.floor(F.col("value") / 10), F.lit(10)))
    q = start_scoring(stream, prep, lr, out, ck, keep=["event_id"])
    q.awaitTermination()
    s = spark.read.parquet(out).select("event_id", "probability", "band", "status")
    b = score(_events(spark), prep, lr, keep=["event_id"]).select(
        "event_id", "probability", "band", "status")
    assert s.count() == b.count()
    assert s.exceptAll(b).count() == 0


def test_save_twice_and_reload(spark, event_model):
    prep, lr, _ = event_model
    base = scratch_path(spark, "t_models")
    for _ in range(2):  # a second save must not fail
        save_model(prep, f"{base}/prep")
        save_model(lr, f"{base}/lr")
    prep2, lr2 = load_pipeline(f"{base}/prep"), load_linear(f"{base}/lr")
    a = score(_events(spark), prep, lr, keep=["event_id"])
    b = score(_events(spark), prep2, lr2, keep=["event_id"])
    assert a.exceptAll(b).count() == 0


def test_sample_record(spark, event_model):
    prep, lr, _ = event_model
    row = score(sample_record(spark, prep, 5.0), prep, lr).first()
    assert row["status"] == "success" and row["n_unseen"] == 0
    mean5 = _events(spark).where("risk_score = 5").agg(F.avg("value")).first()[0]
    assert row["probability"] == pytest.approx(round(mean5 / 100, 4), abs=1e-4)


def test_compiled_scoring_equals_ml_transform(spark):
    from scorewell.plans.q_model import LINE_FEATURES
    li = table(spark, SF_CHECK, "lineitem")
    prep, lr, _ = fit_and_predict(li.where("l_quantity > 3"), LINE_FEATURES, "l_extendedprice")
    test = li.withColumn("l_tax", F.expr("nullif(l_tax, 0.02)"))  # nulls -> unseen slot
    keep = ["l_orderkey", "l_linenumber", "l_quantity", "l_tax"]
    a = score(test, prep, lr, keep=keep, compiled=True)
    b = score(test, prep, lr, keep=keep, compiled=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.where("n_unseen > 0").count() > 0


def test_predictions_invariant_to_partitioning(spark):
    ev = _events(spark)
    _, _, p1 = fit_and_predict(ev.repartition(3), [FEAT], "value")
    _, _, p2 = fit_and_predict(ev.repartition(13, "event_id"), [FEAT], "value")
    a = p1.select("event_id", F.round("prediction", 6).alias("p"))
    b = p2.select("event_id", F.round("prediction", 6).alias("p"))
    gap = a.join(b.withColumnRenamed("p", "q"), "event_id").agg(
        F.max(F.abs(F.col("p") - F.col("q")) / F.greatest(F.abs("p"), F.lit(1.0)))).first()[0]
    assert gap < 1e-6


def test_fit_without_persist_same_model(spark):
    from scorewell.operators.encoding import fit_preprocessor
    from scorewell.operators.regression import fit_linear
    ev = _events(spark)
    prep = fit_preprocessor(ev, [FEAT])
    data = prep.transform(ev).withColumn("label", F.col("value"))
    a, b = fit_linear(data), fit_linear(data, persist=False)
    assert a.intercept == pytest.approx(b.intercept, rel=1e-9)
    assert list(a.coefficients) == pytest.approx(list(b.coefficients), rel=1e-9, abs=1e-9)
