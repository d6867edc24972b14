"""Gram matrices, backfitting and scoring by joins against the dense models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewell.operators import gram as G
from scorewell.operators.additive import coefficient_table, fit_additive, score_additive
from scorewell.operators.encoding import Feature
from scorewell.operators.regression import regression_metrics
from scorewell.plans.flagship import fit_and_predict

from conftest import SF_SMALL

FEATURES = [Feature("l_returnflag", "category"), Feature("l_linestatus", "category"), Feature("l_linenumber", "score"),
            Feature("l_tax", "category"), Feature("l_discount", "category")]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")


@pytest.fixture(scope="module")
def dense(lines):
    """Preprocessor, model and predictions of the vector path."""
    return fit_and_predict(lines, FEATURES, "l_extendedprice")


def by_row(df):
    rows = df.groupBy("l_returnflag", "l_linestatus", "l_linenumber", "l_tax", "l_discount").agg(
        F.min("prediction").alias("low"), F.max("prediction").alias("high")).collect()
    return {tuple(r)[:5]: (r.low, r.high) for r in rows}


KEEP = [f.name for f in FEATURES]


def close(a, b, rel=1e-5):
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=rel)


def test_dense_model_scored_by_joins(spark, lines, dense):
    prep, model, pred = dense
    got = score_additive(lines, coefficient_table(prep, model), FEATURES, KEEP)
    assert got.count() == lines.count() and got.columns == [*KEEP, "prediction", "n_unseen"]
    assert got.agg(F.sum("n_unseen")).first()[0] == 0
    close(by_row(got), by_row(pred), 1e-9)


def test_gram_and_backfitting_predict_as_the_dense_model(spark, lines, dense):
    want = by_row(dense[2])
    fit = G.fit_gram(G.gram(lines, FEATURES, "l_extendedprice"))
    close(by_row(score_additive(lines, fit, FEATURES, KEEP)), want)
    close(by_row(score_additive(lines, fit_additive(lines, FEATURES, "l_extendedprice"), FEATURES, KEEP)), want)


def test_unseen_and_null_levels_take_their_slot(spark, lines, dense):
    prep, model, _ = dense
    odd = lines.where("l_orderkey < 40").select(
        F.when(F.col("l_linenumber") > 2, F.lit("?")).alias("l_returnflag"), "l_linestatus",
        F.lit(99).alias("l_linenumber"), "l_tax", "l_discount")
    got = score_additive(odd, coefficient_table(prep, model), FEATURES, KEEP)
    assert {r.n_unseen for r in got.collect()} == {2}
    close(by_row(got), by_row(model.transform(prep.transform(odd))), 1e-9)


def test_levels_by_the_thousand(spark, lines):
    feats = [Feature("l_partkey", "category"), Feature("l_returnflag", "category")]
    data = lines.withColumn("l_partkey", F.when(F.col("l_partkey") % 7 > 0, F.col("l_partkey")))
    fit = fit_additive(data, feats, "l_extendedprice")
    scored = score_additive(data, fit, feats, ["l_partkey", "l_returnflag", "l_extendedprice"])
    for c in ("l_partkey", "l_returnflag"):
        off = scored.groupBy(c).agg(F.avg("prediction").alias("p"), F.avg("l_extendedprice").alias("y"))
        assert off.where(F.abs(F.col("p") - F.col("y")) > 1e-3).count() == 0
    best = regression_metrics(scored, "l_extendedprice").first()
    one = score_additive(data, fit_additive(data, feats[:1], "l_extendedprice"), feats[:1], ["l_extendedprice"])
    assert best.r2 > regression_metrics(one, "l_extendedprice").first().r2


def test_backfitting_edges(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", None), ("b", "x", 3.0), (None, None, 8.0)],
                               "f string, g string, y double")
    feats = [Feature("f", "category"), Feature("g", "category")]
    fit = fit_additive(df, feats, "y")
    got = {r.f: r.prediction for r in score_additive(df.where("y is not null"), fit, feats, ["f"]).collect()}
    assert got == pytest.approx({"a": 1.0, "b": 3.0, None: 8.0}, abs=1e-6)
    none = fit_additive(df.where("y > 99"), feats, "y").collect()
    assert [tuple(r) for r in none] == [(G.INTERCEPT, None, 0.0)]
    with pytest.raises(RuntimeError):
        fit_additive(df, feats, "y", tol=-1.0, max_sweeps=2)


def test_gram_parts_merge_and_come_off(spark, lines):
    feats = [Feature("l_returnflag", "category")]
    whole = G.gram(lines, feats, "l_extendedprice", ["l_quantity"])
    parts = [G.gram(lines.where(F.col("l_linenumber") % 3 == i), feats, "l_extendedprice", ["l_quantity"]) for i in range(3)]

    def table(g):
        return {tuple(r)[:4]: r.product for r in g.collect() if abs(r.product) > 1e-6}
    assert table(G.merged(parts)) == pytest.approx(table(whole), rel=1e-12)
    assert table(G.without(whole, parts[1])) == pytest.approx(table(G.merged([parts[0], parts[2]])), rel=1e-9)


def test_folds_equal_fits_of_their_own(spark, lines):
    feats, fold = FEATURES[:3], F.col("l_orderkey") % 4
    got = {r.fold: r for r in G.cross_validate(lines, feats, "l_extendedprice", fold, 5, ["l_quantity"]).collect()}
    assert sorted(got) == [0, 1, 2, 3]  # fold 4 has no rows
    pdf = lines.select(*[f.name for f in feats], "l_quantity", "l_extendedprice", fold.alias("k")).toPandas()
    cols = [np.ones(len(pdf)), pdf["l_quantity"].to_numpy(float)]
    cols += [(pdf[f.name] == v).to_numpy(float) for f in feats for v in sorted(pdf[f.name].unique())]
    x, y = np.column_stack(cols), pdf["l_extendedprice"].to_numpy(float)
    for k, r in got.items():
        test = (pdf["k"] == k).to_numpy()
        beta = np.linalg.lstsq(x[~test], y[~test], rcond=None)[0]
        rest = y[test] - x[test] @ beta
        assert r.n == test.sum() and r.rmse == pytest.approx(np.sqrt((rest ** 2).mean()), rel=1e-6)
        assert r.r2 == pytest.approx(1 - (rest ** 2).sum() / ((y[test] - y[test].mean()) ** 2).sum(), abs=1e-6)


def test_one_scan(spark, lines):
    plan = G.cross_validate(lines, FEATURES[:1], "l_extendedprice", F.col("l_orderkey") % 5, 5)._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("Scan parquet") == 1


def test_wide_models_are_refused(spark):
    df = spark.range(G.MAX_WIDTH + 5).select("id", F.lit(1.0).alias("y"))
    with pytest.raises(Exception, match="operators.additive"):
        G.fit_gram(G.gram(df, [Feature("id", "category")], "y")).collect()


def test_scored_rows_are_neither_multiplied_nor_sorted(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, 4.0), ("c", 8.0)], "f string, y double")
    fit = spark.createDataFrame([("(intercept)", None, 1.0), ("f", "a", 2.0), ("f", "b", 3.0), ("f", None, 0.5)],
                                "feature string, value string, coefficient double")
    got = score_additive(df, fit, [Feature("f", "category")], ["f", "y"])
    assert {(r.f, r.y, r.prediction, r.n_unseen) for r in got.collect()} == {
        ("a", 1.0, 3.0, 0), ("b", 2.0, 4.0, 0), (None, 4.0, 1.5, 1), ("c", 8.0, 1.5, 1)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()


def test_many_levels_are_hashed_and_rows_not_sorted(spark, monkeypatch):
    from scorewell.operators import additive
    df = spark.createDataFrame([("a", "x", 1), (None, "x", 2), ("b", None, 3), ("a", "z", 4), ("1", "x", 5)],
                               "f string, g string, id int")
    fit = spark.createDataFrame([("(intercept)", None, 1.0), ("f", "a", 2.0), ("f", "b", 3.0), ("f", None, 0.5),
                                 ("g", "x", 10.0)], "feature string, value string, coefficient double")
    feats = [Feature("f", "category"), Feature("g", "category")]
    want = {(1, 13.0, 0), (2, 11.5, 1), (3, 4.0, 1), (4, 3.0, 1), (5, 11.5, 1)}
    for few in (0, 1, 10):
        monkeypatch.setattr(additive, "FEW_LEVELS", few)
        got = score_additive(df, fit, feats, ["id"])
        assert {tuple(r) for r in got.collect()} == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and ("ShuffledHashJoin" in plan) == (few < 10)
