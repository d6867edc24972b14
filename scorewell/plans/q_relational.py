"""Driver queries: regression and scoring kept in tables (M6, M7, P1, §2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorewell.functions.scalars import stable_hash32
from scorewell.operators.additive import fit_additive, score_additive
from scorewell.operators.encoding import Feature
from scorewell.operators.exact_split import exact_split
from scorewell.operators.gram import cross_validate, fit_gram, gram, merged, without
from scorewell.operators.moments import append_moments, error_moments, merged_moments, metrics_of, read_moments
from scorewell.operators.regression import regression_metrics
from scorewell.plans.q_model import _EVAL_SQL, _one_feature_predictions
from scorewell.plans.registry import memo, query
from scorewell.session import scratch_path, table

_FOLD = "('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8))::BIGINT % 5"


@query("cv_one_pass", f"""
WITH t AS (SELECT l_linenumber AS g, l_extendedprice AS y, {_FOLD} AS f FROM lineitem),
s AS (SELECT g, f, sum(y) AS sy, count(*) AS n FROM t GROUP BY g, f),
m AS (SELECT a.g, a.f, (SELECT sum(sy) / sum(n) FROM s b WHERE b.g = a.g AND b.f <> a.f) AS mu FROM s a)
SELECT CAST(t.f AS INTEGER) AS fold, count(*) AS n, round(sqrt(sum((y - mu) * (y - mu)) / count(*)), 3) AS rmse,
       round(1 - sum((y - mu) * (y - mu)) / (var_pop(y) * count(*)), 6) AS r2
FROM t JOIN m ON t.g = m.g AND t.f = m.f GROUP BY t.f""")
def cv_one_pass(spark, sf_dir):
    """§2.8: five folds from one scan, each trained on total minus fold."""
    out = cross_validate(table(spark, sf_dir, "lineitem"), [Feature("l_linenumber")], "l_extendedprice",
                         stable_hash32("l_orderkey") % 5, 5)
    return out.select("fold", "n", F.round("rmse", 3).alias("rmse"), F.round("r2", 6).alias("r2"))


@query("gram_merge", """
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept
FROM lineitem GROUP BY l_returnflag
UNION ALL
SELECT 'A+N', round(regr_slope(l_extendedprice, l_quantity), 4), round(regr_intercept(l_extendedprice, l_quantity), 2)
FROM lineitem WHERE l_returnflag IN ('A', 'N')
UNION ALL
SELECT 'all-R', round(regr_slope(l_extendedprice, l_quantity), 4), round(regr_intercept(l_extendedprice, l_quantity), 2)
FROM lineitem WHERE l_returnflag <> 'R'""")
def gram_merge(spark, sf_dir):
    """M6 from Gram tables of parts: each part, two added, one taken off the whole."""
    path = scratch_path(spark, "gram")
    gram(table(spark, sf_dir, "lineitem"), [], "l_extendedprice", ["l_quantity"], ["l_returnflag"]).write.parquet(path)
    parts = spark.read.parquet(path)
    a, n, r = (parts.where(F.col("l_returnflag") == f).drop("l_returnflag") for f in "ANR")
    out = None
    for name, g in (("A", a), ("N", n), ("R", r), ("A+N", merged([a, n])),
                    ("all-R", without(merged([parts.drop("l_returnflag")]), r))):
        fit = fit_gram(g).groupBy().agg(
            F.max(F.when(F.col("feature") == "l_quantity", F.col("coefficient"))).alias("slope"),
            F.max(F.when(F.col("feature") != "l_quantity", F.col("coefficient"))).alias("intercept"))
        fit = fit.select(F.lit(name).alias("l_returnflag"), F.round("slope", 4).alias("slope"),
                         F.round("intercept", 2).alias("intercept"))
        out = fit if out is None else out.unionByName(fit)
    return out


PART_FLAG = [Feature("l_partkey", "category"), Feature("l_returnflag", "category")]


def _part_flag_scores(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    fit = memo(spark, sf_dir, "additive", lambda: fit_additive(li, PART_FLAG, "l_extendedprice"))
    return score_additive(li, fit, PART_FLAG, keep=["l_partkey", "l_returnflag", "l_extendedprice"])


@query("lr_additive", """
SELECT 'l_partkey' AS feature, CAST(l_partkey AS VARCHAR) AS level, count(*) AS n,
       round(avg(l_extendedprice), 0) AS avg_prediction FROM lineitem GROUP BY l_partkey
UNION ALL
SELECT 'l_returnflag', l_returnflag, count(*), round(avg(l_extendedprice), 0) FROM lineitem GROUP BY l_returnflag""")
def lr_additive(spark, sf_dir):
    """M6 on thousands of levels by backfitting, scored by joins: the mean
    prediction of every part and flag is its mean label."""
    scored = _part_flag_scores(spark, sf_dir)
    long = scored.select(F.col("l_partkey").cast("string").alias("l_partkey"), "l_returnflag", "prediction").unpivot(
        ["prediction"], ["l_partkey", "l_returnflag"], "feature", "level")
    # fitted means agree to about 1e-8 of the label's deviation
    return long.groupBy("feature", "level").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.round(F.avg("prediction"), 3), 0).alias("avg_prediction"))


@query("score_relational", """
WITH t AS (SELECT l_linenumber AS g, l_extendedprice AS y FROM lineitem),
m AS (SELECT g, avg(y) AS mu FROM t GROUP BY g)
SELECT count(*) AS n, round(sqrt(sum((y - mu) * (y - mu)) / count(*)), 3) AS rmse,
       round(1 - sum((y - mu) * (y - mu)) / (var_pop(y) * count(*)), 6) AS r2, CAST(0 AS BIGINT) AS n_unseen
FROM t JOIN m ON t.g = m.g""")
def score_relational(spark, sf_dir):
    """Coefficients of a Gram fit, one join a feature over all rows."""
    li = table(spark, sf_dir, "lineitem")
    feats = [Feature("l_linenumber")]
    fit = fit_gram(gram(li, feats, "l_extendedprice"))
    scored = score_additive(li, fit, feats, keep=["l_extendedprice"])
    unseen = scored.agg(F.sum("n_unseen").alias("n_unseen")).scalar()
    m = regression_metrics(scored, "l_extendedprice")
    return m.select("n", F.round("rmse", 3).alias("rmse"), F.round("r2", 6).alias("r2"), unseen.alias("n_unseen"))


@query("eval_metrics_merged", _EVAL_SQL.format(keys="l_returnflag, ", group="GROUP BY l_returnflag"))
def eval_metrics_merged(spark, sf_dir):
    """M9/M10 from stored moments: four batches of predictions, each read once."""
    pred, root = _one_feature_predictions(spark, sf_dir), scratch_path(spark, "moments")
    for k in range(4):
        append_moments(error_moments(pred.where(F.col("l_orderkey") % 4 == k), by=["l_returnflag"]), root, str(k))
    m = metrics_of(merged_moments(read_moments(spark, root), ["l_returnflag"]))
    return m.select("l_returnflag", "n", F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))


@query("split_exact", """
SELECT CAST(floor(0.2 * count(*) + 0.5) AS BIGINT) AS n_test, CAST(count(*) - floor(0.2 * count(*) + 0.5) AS BIGINT) AS n_train,
       CAST(sum(l_orderkey) AS BIGINT) AS all_keys, CAST(0 AS BIGINT) AS test_above_train FROM lineitem""")
def split_exact(spark, sf_dir):
    """A test part of exactly round(0.2 n) rows; every test hash is below every train hash or equal to it."""
    keys = ["l_orderkey", "l_linenumber"]
    train, test = exact_split(table(spark, sf_dir, "lineitem"), keys)
    both = test.withColumn("part", F.lit("test")).unionByName(train.withColumn("part", F.lit("train")))
    h = F.xxhash64(*keys)
    out = both.agg(F.count_if(F.col("part") == "test").alias("n_test"), F.count_if(F.col("part") == "train").alias("n_train"),
                   F.sum("l_orderkey").alias("all_keys"), F.max(F.when(F.col("part") == "test", h)).alias("high"),
                   F.min(F.when(F.col("part") == "train", h)).alias("low"))
    return out.select("n_test", "n_train", "all_keys", F.when(F.col("high") > F.col("low"), 1).otherwise(0).cast(
        "long").alias("test_above_train"))
