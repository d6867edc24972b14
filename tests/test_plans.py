"""Physical-plan properties the scale design relies on."""

import re

from pyspark.sql import functions as F

from conftest import SF_CHECK
from scorewell.operators.encoding import Feature, label_counts
from scorewell.operators.scoring import GroupMeanModel, score, score_python_model
from scorewell.plans.flagship import fit_and_predict, level_calibration
from scorewell.plans.queries import queries
from scorewell.session import table


def _plan(df) -> str:
    """Full text of ``df.explain("formatted")``."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")


def _events(spark):
    return table(spark, SF_CHECK, "events").withColumn(
        "risk_score", F.least(F.floor(F.col("value") / 10), F.lit(10)))


def test_scan_pushes_filters_and_prunes_columns(spark):
    plan = _plan(queries()["parquet_scan"](spark, SF_CHECK))
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_quantity), " \
           "EqualTo(l_returnflag,R), GreaterThan(l_quantity,10.0)]" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == sorted(
        ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"])


def test_compiled_scoring_is_one_narrow_jvm_stage(spark):
    ev = _events(spark)
    prep, lr, _ = fit_and_predict(ev, [Feature("risk_score", "score")], "value")
    plan = _plan(score(ev, prep, lr, keep=["event_id"], compiled=True))
    assert "Exchange" not in plan                    # no shuffle at all
    assert "EvalPython" not in plan and "PythonUDF" not in plan
    assert "UDF(" not in plan                        # no opaque ML UDFs either
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_calibration_has_one_shuffle_with_partial_aggregation(spark):
    ev = _events(spark)
    feats = [Feature("risk_score", "score")]
    _, _, pred = fit_and_predict(ev, feats, "value")
    plan = _plan(level_calibration(pred, feats))
    assert plan.count("Arguments: hashpartitioning(") == 1
    assert "partial_count" in plan and "partial_avg" in plan


def test_label_counts_combine_map_side(spark):
    li = table(spark, SF_CHECK, "lineitem")
    plan = _plan(label_counts(li, [Feature("l_returnflag", "category"),
                                   Feature("l_linenumber", "score")]))
    assert plan.count("Arguments: hashpartitioning(") == 1
    assert "partial_count" in plan
    assert "ReadSchema: struct<l_linenumber:int,l_returnflag:string>" in plan


def test_python_model_runs_in_arrow_batches(spark):
    ev = _events(spark)
    model = GroupMeanModel.fit(ev, Feature("risk_score", "score"), "value")
    plan = _plan(score_python_model(ev, model, [Feature("risk_score", "score")], keep=["event_id"]))
    assert "MapInPandas" in plan or "MapInArrow" in plan
    assert "BatchEvalPython" not in plan
