"""Driver queries: encoding, regression and evaluation."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from scorewell.functions.scalars import stable_hash32
from scorewell.operators.encoding import (Feature, apply_label_table, cat_col, fit_preprocessor,
                                          index_col, label_table, num_labels, vector_col, vector_width)
from scorewell.operators.regression import fit_linear, linear_regression, regression_metrics
from scorewell.operators.tracking import metric_definitions, param_rows
from scorewell.plans.flagship import fit_and_predict, level_calibration, predictions
from scorewell.plans.registry import memo, query
from scorewell.session import scratch_path, table

# ---------------------------------------------------------------- flagship

ORDER_FEATURES = [Feature("o_orderstatus", "category"), Feature("o_orderpriority", "category")]


def flagship(spark, sf_dir):
    """Notebook pipeline on ``orders``: per-level calibration of the fit."""
    orders = table(spark, sf_dir, "orders")
    _, _, pred = fit_and_predict(orders, ORDER_FEATURES, "o_totalprice")
    return level_calibration(pred, ORDER_FEATURES)


def _calibration_sql(tbl: str, label: str, cols: list[tuple[str, str]]) -> str:
    parts = [
        f"SELECT '{name}' AS feature, CAST({name} AS VARCHAR) AS level, count(*) AS n, "
        f"round(avg({label}), 2) AS avg_label, true AS calibrated "
        f"FROM {tbl} WHERE {label} IS NOT NULL GROUP BY {name}"
        for name, _ in cols]
    return "\nUNION ALL\n".join(parts)


query("flagship_calibration", _calibration_sql(
    "orders", "o_totalprice", [(f.name, f.kind) for f in ORDER_FEATURES]))(flagship)

# ---------------------------------------------------------------- lineitem model

LINE_FEATURES = [Feature("l_returnflag", "category"), Feature("l_linestatus", "category"),
                 Feature("l_linenumber", "score"), Feature("l_tax", "category"),
                 Feature("l_discount", "category")]


def _line_model(spark, sf_dir):
    def build():
        li = table(spark, sf_dir, "lineitem")
        prep, lr, pred = fit_and_predict(li, LINE_FEATURES, "l_extendedprice")
        return prep, lr
    return memo(spark, sf_dir, "line5", build)


def _line_predictions(spark, sf_dir):
    prep, lr = _line_model(spark, sf_dir)
    return predictions(table(spark, sf_dir, "lineitem"), prep, lr, "l_extendedprice")


@query("lr_calibration", "\nUNION ALL\n".join(
    f"SELECT '{f.name}' AS feature, CAST({f.name} AS VARCHAR) AS level, count(*) AS n, "
    f"round(avg(l_extendedprice), 0) AS avg_prediction FROM lineitem GROUP BY {f.name}" for f in LINE_FEATURES))
def lr_calibration(spark, sf_dir):
    """M6/M7: five features; the mean prediction of every level is its mean label."""
    pred = _line_predictions(spark, sf_dir)
    long = pred.select(*[F.col(cat_col(f.name)).alias(f.name) for f in LINE_FEATURES], "prediction").unpivot(
        ids=["prediction"], values=[f.name for f in LINE_FEATURES],
        variableColumnName="feature", valueColumnName="level")
    return long.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"),
                                                F.round(F.avg("prediction"), 0).alias("avg_prediction"))


ONE_FEATURE = [Feature("l_linenumber", "score")]


def _one_feature_model(spark, sf_dir):
    def build():
        li = table(spark, sf_dir, "lineitem")
        prep, lr, _ = fit_and_predict(li, ONE_FEATURE, "l_extendedprice")
        return prep, lr
    return memo(spark, sf_dir, "line1", build)


def _one_feature_predictions(spark, sf_dir):
    prep, lr = _one_feature_model(spark, sf_dir)
    return predictions(table(spark, sf_dir, "lineitem"), prep, lr, "l_extendedprice")


@query("lr_group_means", _calibration_sql("lineitem", "l_extendedprice", [("l_linenumber", "score")]))
def lr_group_means(spark, sf_dir):
    """M6/M7: one categorical feature -> the prediction is the level mean."""
    return level_calibration(_one_feature_predictions(spark, sf_dir), ONE_FEATURE)


@query("lr_numeric", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2,
       count(*) AS n
FROM lineitem""")
def lr_numeric(spark, sf_dir):
    """M6: one numeric feature; slope/intercept/r2 equal the SQL regression."""
    li = table(spark, sf_dir, "lineitem")
    asm = VectorAssembler(inputCols=["l_quantity"], outputCol="features")
    data = asm.transform(li.select("l_quantity", F.col("l_extendedprice").alias("label")))
    model = fit_linear(data)
    m = regression_metrics(model.transform(data))
    return m.select(
        F.round(F.lit(float(model.coefficients[0])), 4).alias("slope"),
        F.round(F.lit(float(model.intercept)), 2).alias("intercept"),
        F.round("r2", 6).alias("r2"), "n")


_EVAL_SQL = """
WITH m AS (SELECT l_linenumber, avg(l_extendedprice) AS mu FROM lineitem GROUP BY l_linenumber),
r AS (SELECT l.l_returnflag, l.l_extendedprice AS y, m.mu AS p
      FROM lineitem l JOIN m ON l.l_linenumber = m.l_linenumber)
SELECT {keys}count(*) AS n, round(sqrt(sum((y - p) * (y - p)) / count(*)), 4) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2
FROM r {group}"""


@query("eval_metrics", _EVAL_SQL.format(keys="", group=""))
def eval_metrics(spark, sf_dir):
    """RMSE and R2 in one pass over the predictions."""
    m = regression_metrics(_one_feature_predictions(spark, sf_dir))
    return m.select("n", F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"))


@query("eval_metrics_by_group", _EVAL_SQL.format(keys="l_returnflag, ", group="GROUP BY l_returnflag"))
def eval_metrics_by_group(spark, sf_dir):
    """M9/M10 per group, still one pass."""
    m = regression_metrics(_one_feature_predictions(spark, sf_dir), group_cols=["l_returnflag"])
    return m.select("l_returnflag", "n", F.round("rmse", 4).alias("rmse"),
                    F.round("r2", 6).alias("r2"))


# ---------------------------------------------------------------- index / one-hot

_LABEL_SQL = """
SELECT feature, value, n, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) - 1 AS idx
FROM ({inner}) t"""


def _label_counts_sql(tbl: str, cols: list[str], where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {expr} AS value, count(*) AS n FROM {tbl}{w} "
        f"GROUP BY 2 HAVING {expr} IS NOT NULL"
        for c, expr in cols)


def _cat(c):
    return (c, f"CAST({c} AS VARCHAR)")


def _score(c):
    return (c, f"CAST(CAST(round_even(CAST({c} AS DOUBLE), 0) AS BIGINT) AS VARCHAR)")


LABEL_COLS = [_cat("l_discount"), _cat("l_tax"), _score("l_linenumber"),
              _cat("l_returnflag"), _cat("l_linestatus")]


@query("string_index_labels", _LABEL_SQL.format(inner=_label_counts_sql("lineitem", LABEL_COLS)))
def string_index_labels(spark, sf_dir):
    """M1: relational label table, ranked without a single-task window."""
    li = table(spark, sf_dir, "lineitem")
    feats = [Feature("l_discount", "category"), Feature("l_tax", "category"),
             Feature("l_linenumber", "score"), Feature("l_returnflag", "category"),
             Feature("l_linestatus", "category")]
    return label_table(li, feats).select("feature", "value", "n", "idx")


_TRAIN = "pmod(cast(conv(substr(md5(cast(l_orderkey as string)), 1, 8), 16, 10) as bigint), 100) < 80"
_TRAIN_DUCK = "('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8))::BIGINT % 100 < 80"


def _apply_sql(feature: str, value_expr: str, fit_where: str, data: str = "lineitem") -> str:
    labels = _LABEL_SQL.format(inner=_label_counts_sql(data, [(feature, value_expr)], fit_where))
    return f"""
WITH lab AS ({labels}),
nl AS (SELECT count(*) AS k FROM lab),
d AS (SELECT {value_expr} AS value FROM {data})
SELECT '{feature}' AS feature, d.value AS value, CAST(coalesce(lab.idx, nl.k) AS BIGINT) AS idx,
       count(*) AS n
FROM d LEFT JOIN lab ON d.value = lab.value CROSS JOIN nl
GROUP BY d.value, coalesce(lab.idx, nl.k)"""


def _apply_query(feature: Feature, source_expr, fit_filter):
    def run(spark, sf_dir):
        li = table(spark, sf_dir, "lineitem").withColumn(feature.name, source_expr())
        prep = fit_preprocessor(li.where(fit_filter()), [feature])
        out = prep.transform(li)
        return (out.groupBy(F.col(feature.name + "__cat").alias("value"),
                            F.col(index_col(feature.name)).cast("bigint").alias("idx"))
                .agg(F.count(F.lit(1)).alias("n"))
                .select(F.lit(feature.name).alias("feature"), "value", "idx", "n"))
    return run


query("string_index_apply", _apply_sql(
    "l_returnflag", "CAST(nullif(l_returnflag, 'N') AS VARCHAR)", _TRAIN_DUCK))(
    _apply_query(Feature("l_returnflag", "category"),
                 lambda: F.expr("nullif(l_returnflag, 'N')"), lambda: F.expr(_TRAIN)))

query("string_index_unseen", _apply_sql(
    "l_quantity", "CAST(CAST(round_even(CAST(l_quantity AS DOUBLE), 0) AS BIGINT) AS VARCHAR)",
    "l_quantity <= 25"))(
    _apply_query(Feature("l_quantity", "score"),
                 lambda: F.col("l_quantity"), lambda: F.col("l_quantity") <= 25))


@query("string_index_join", _apply_sql(
    "l_quantity", "CAST(CAST(round_even(CAST(l_quantity AS DOUBLE), 0) AS BIGINT) AS VARCHAR)",
    "l_quantity <= 25"))
def string_index_join(spark, sf_dir):
    """M1 + M2, relational path for large domains: the label table (ranked
    with distributed positions) joined to every row; unseen -> numLabels."""
    li = table(spark, sf_dir, "lineitem")
    f = Feature("l_quantity", "score")
    labels = label_table(li.where(F.col("l_quantity") <= 25), [f])
    out = apply_label_table(li, labels, f)
    return (out.groupBy(F.expr(f.coerce_sql()).alias("value"),
                        F.col(index_col(f.name)).cast("bigint").alias("idx"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(f.name).alias("feature"), "value", "idx", "n"))


@query("one_hot_apply", f"""
WITH lab AS ({_LABEL_SQL.format(inner=_label_counts_sql("orders", [_cat("o_orderpriority")]))}),
nl AS (SELECT count(*) AS k FROM lab)
SELECT o.o_orderkey, CAST(lab.idx AS INTEGER) AS hot_slot, CAST(nl.k + 1 AS INTEGER) AS width,
       CAST(1.0 AS DOUBLE) AS n_hot
FROM orders o JOIN lab ON CAST(o.o_orderpriority AS VARCHAR) = lab.value CROSS JOIN nl""")
def one_hot_apply(spark, sf_dir):
    """M3: one-hot block per row: the hot slot, block width, ones count."""
    orders = table(spark, sf_dir, "orders")
    feats = [Feature("o_orderpriority", "category")]
    prep = fit_preprocessor(orders, feats)
    arr = vector_to_array(F.col(vector_col("o_orderpriority")))
    out = prep.transform(orders).select("o_orderkey", arr.alias("a"))
    return out.select(
        "o_orderkey",
        (F.array_position("a", F.lit(1.0)) - 1).cast("int").alias("hot_slot"),
        F.size("a").alias("width"),
        F.aggregate("a", F.lit(0.0), lambda acc, x: acc + x).alias("n_hot"))


@query("assemble_width", f"""
SELECT count(*) AS n_rows, {{w}} AS width, {{w}} AS min_width FROM lineitem""".replace(
    "{w}", "(SELECT CAST(sum(k + 1) AS INTEGER) FROM (SELECT count(DISTINCT v) AS k, f FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS f, {e} AS v FROM lineitem" for c, e in LABEL_COLS)
    + ") GROUP BY f))"))
def assemble_width(spark, sf_dir):
    """M4: assembled vector width = sum over features of (numLabels + 1)."""
    li = table(spark, sf_dir, "lineitem")
    feats = [Feature("l_discount", "category"), Feature("l_tax", "category"),
             Feature("l_linenumber", "score"), Feature("l_returnflag", "category"),
             Feature("l_linestatus", "category")]
    prep = fit_preprocessor(li, feats)
    width = F.size(vector_to_array(F.col("features")))
    out = prep.transform(li).agg(F.count(F.lit(1)).alias("n_rows"),
                                 F.max(width).alias("width"), F.min(width).alias("min_width"))
    expected = vector_width(prep)
    return out.withColumn("width", F.when(F.col("width") == expected, F.col("width")))


@query("tracking_params", """
SELECT stage, name, value FROM (VALUES
 ('LinearRegression', 'aggregationDepth', '2'),
 ('LinearRegression', 'elasticNetParam', '0.0'),
 ('LinearRegression', 'epsilon', '1.35'),
 ('LinearRegression', 'featuresCol', 'features'),
 ('LinearRegression', 'fitIntercept', 'true'),
 ('LinearRegression', 'labelCol', 'label'),
 ('LinearRegression', 'loss', 'squaredError'),
 ('LinearRegression', 'maxBlockSizeInMB', '0.0'),
 ('LinearRegression', 'maxIter', '100'),
 ('LinearRegression', 'predictionCol', 'prediction'),
 ('LinearRegression', 'regParam', '0.0'),
 ('LinearRegression', 'solver', 'auto'),
 ('LinearRegression', 'standardization', 'true'),
 ('LinearRegression', 'tol', '1e-06')) AS t(stage, name, value)
UNION ALL SELECT 'StringIndexer', 'numLabels.l_linenumber', CAST(count(DISTINCT l_linenumber) AS VARCHAR) FROM lineitem
UNION ALL SELECT 'metric', 'test_r2.throughOrigin', 'false'
UNION ALL SELECT 'metric', 'test_r2.metricName', 'r2'
UNION ALL SELECT 'metric', 'test_rmse.metricName', 'rmse'""")
def tracking_params(spark, sf_dir):
    """Parameters of the fitted model, its label counts and the metric
    definitions as rows (autolog equivalent)."""
    prep, lr = _one_feature_model(spark, sf_dir)
    labels = [("StringIndexer", f"numLabels.{f}", str(n)) for f, n in num_labels(prep).items()]
    info = metric_definitions(spark).select(F.lit("metric").alias("stage"), F.explode(F.map_filter(
        F.create_map(F.concat("key", F.lit(".metricName")), "metricName",
                     F.concat("key", F.lit(".throughOrigin")), F.col("throughOrigin").cast("string")),
        lambda k, v: v.isNotNull())).alias("name", "value"))
    return param_rows(spark, lr).unionByName(
        spark.createDataFrame(labels, "stage string, name string, value string")).unionByName(info)


_FOLD = "('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8))::BIGINT % 5"


@query("cv_r2", f"""
WITH t AS (SELECT l_linenumber AS g, l_extendedprice AS y, {_FOLD} AS f FROM lineitem),
s AS (SELECT g, f, sum(y) AS sy, count(*) AS n FROM t GROUP BY g, f),
m AS (SELECT a.g, a.f, (SELECT sum(sy) / sum(n) FROM s b WHERE b.g = a.g AND b.f <> a.f) AS mu FROM s a),
r AS (SELECT t.f, 1 - sum((y - mu) * (y - mu)) / (var_pop(y) * count(*)) AS r2
      FROM t JOIN m ON t.g = m.g AND t.f = m.f GROUP BY t.f)
SELECT CAST(count(*) AS INTEGER) AS folds, round(avg(r2), 6) AS avg_r2 FROM r""")
def cv_r2(spark, sf_dir):
    """Declared ``cv: 5, scoring: r2``: cross-validated R2 over folds by key hash."""
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    li = table(spark, sf_dir, "lineitem")
    prep, _ = _one_feature_model(spark, sf_dir)
    data = prep.transform(li).select("features", F.col("l_extendedprice").alias("label"),
                                     (stable_hash32("l_orderkey") % 5).cast("int").alias("fold"))
    cv = CrossValidator(estimator=linear_regression(), estimatorParamMaps=ParamGridBuilder().build(),
                        evaluator=RegressionEvaluator(metricName="r2"), numFolds=5, foldCol="fold")
    model = cv.fit(data)
    return spark.createDataFrame([(5, round(float(model.avgMetrics[0]), 6))], "folds int, avg_r2 double")


# ---------------------------------------------------------------- persistence + pipeline

PART_FEATURES = [Feature("p_brand", "category")]


@query("model_reload", _calibration_sql("part", "p_retailprice", [("p_brand", "category")]))
def model_reload(spark, sf_dir):
    """Fit, save (twice, overwrite), load, score from the loaded pair."""
    from scorewell.sources.models import load_linear, load_pipeline, save_model
    part = table(spark, sf_dir, "part")
    prep, lr, _ = fit_and_predict(part, PART_FEATURES, "p_retailprice")
    base = scratch_path(spark, "model_reload")
    for _ in range(2):
        save_model(prep, f"{base}/preprocessor")
        save_model(lr, f"{base}/model")
    prep2, lr2 = load_pipeline(f"{base}/preprocessor"), load_linear(f"{base}/model")
    return level_calibration(predictions(part, prep2, lr2, "p_retailprice"), PART_FEATURES)


_HASH_TRAIN = "('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8))::BIGINT < 0.8 * 4294967296"


@query("train_register_run", f"""
WITH t AS (SELECT l_linenumber, l_extendedprice AS y, {_HASH_TRAIN} AS is_train
           FROM lineitem WHERE l_extendedprice IS NOT NULL),
m AS (SELECT l_linenumber, avg(y) AS mu FROM t WHERE is_train GROUP BY l_linenumber),
e AS (SELECT t.y, m.mu AS p FROM t JOIN m ON t.l_linenumber = m.l_linenumber WHERE NOT t.is_train)
SELECT count(*) AS n_test, round(sqrt(sum((y - p) * (y - p)) / count(*)), 1) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
       1 AS latest_version, 'lineitem_price' AS model_name
FROM e""")
def train_register_run(spark, sf_dir):
    """Ingest -> preprocess -> key-hash split -> train -> evaluate on the
    held-out part -> log -> register; the summary row of the run."""
    import os
    from scorewell.plans.training import TrainParams, run_pipeline
    res = run_pipeline(spark, TrainParams(
        sources=[scratch_path(spark, "absent_source"), os.path.join(sf_dir, "lineitem.parquet")],
        root=scratch_path(spark, "train_register_run"), features=ONE_FEATURE,
        target="l_extendedprice", split="hash:l_orderkey", experiment="lineitem",
        model_name="lineitem_price"))
    return spark.createDataFrame(
        [(int(res["n_test"]), float(res["rmse"]), float(res["r2"]), int(res["latest_version"]),
          "lineitem_price")],
        "n_test bigint, rmse double, r2 double, latest_version int, model_name string",
    ).select("n_test", F.round("rmse", 1).alias("rmse"), F.round("r2", 6).alias("r2"),
             "latest_version", "model_name")
