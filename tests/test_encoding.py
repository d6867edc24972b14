"""Index / one-hot / assembly: label order, unseen handling, invariance."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_CHECK
from scorewell.operators.encoding import (Feature, apply_label_table, fit_preprocessor,
                                          index_col, indexer_of, label_table, num_labels,
                                          vector_col, vector_width)
from scorewell.operators.ranking import ordered_position
from scorewell.session import table

FEATS = [Feature("l_discount", "category"), Feature("l_tax", "category"),
         Feature("l_linenumber", "score"), Feature("l_returnflag", "category"),
         Feature("l_linestatus", "category")]


def test_feature_without_labels_is_an_error(spark):
    df = spark.createDataFrame([("A",), ("B",)], "c string")
    with pytest.raises(ValueError):
        fit_preprocessor(df, [Feature("c", "score")])


def test_label_table_equals_model_labels(spark):
    li = table(spark, SF_CHECK, "lineitem")
    prep = fit_preprocessor(li, FEATS)
    rows = label_table(li, FEATS).collect()
    for f, labels in zip(FEATS, indexer_of(prep).labelsArray):
        mine = sorted((r["idx"], r["value"]) for r in rows if r["feature"] == f.name)
        assert [v for _, v in mine] == list(labels)


def test_ties_sorted_by_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("10",), ("9",), ("a",), ("b",)], "c string")
    prep = fit_preprocessor(df, [Feature("c", "category")])
    assert list(indexer_of(prep).labelsArray[0]) == ["a", "b", "10", "9"]


def test_ordered_position_matches_row_number(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") % 7).cast("string").alias("g"), ((F.col("id") * 7919) % 5003).alias("k"))
    got = ordered_position(df, "g", [F.col("k").desc()], num_partitions=5)
    w = Window.partitionBy("g").orderBy(F.col("k").desc())
    want = df.withColumn("pos", F.row_number().over(w) - 1)
    assert sorted(got.collect()) == sorted(want.collect())


def test_ordered_position_hot_group(spark):
    # one group holds almost everything; positions stay dense and unique
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 100 == 0, "cold").otherwise("hot").alias("g"), F.col("id").alias("k"))
    got = ordered_position(df, "g", [F.col("k").asc()], num_partitions=8)
    hot = got.where("g = 'hot'").agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first()
    assert tuple(hot) == (0, 19799, 19800)


def test_unseen_and_null_go_to_last_index(spark):
    train = spark.createDataFrame([("1",), ("2",), ("2",)], "s string")
    prep = fit_preprocessor(train, [Feature("s", "score")])
    test = spark.createDataFrame([("2",), ("7",), (None,), ("x",), ("1.4",)], "s string")
    got = [r[0] for r in prep.transform(test).select(index_col("s")).collect()]
    assert got == [0.0, 2.0, 2.0, 2.0, 1.0]


def test_one_hot_width_keeps_unseen_slot(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "s string")
    prep = fit_preprocessor(train, [Feature("s", "category")])
    test = spark.createDataFrame([("a",), ("zzz",)], "s string")
    arrs = [r[0] for r in prep.transform(test).select(
        vector_to_array(F.col(vector_col("s")))).collect()]
    assert arrs == [[1.0, 0.0, 0.0, 0.0], [0.0, 0.0, 0.0, 1.0]]
    assert vector_width(prep) == 4
    assert num_labels(prep) == {"s": 3}


def test_apply_label_table_equals_model(spark):
    li = table(spark, SF_CHECK, "lineitem")
    fit_rows = li.where(F.col("l_quantity") <= 25)
    f = Feature("l_quantity", "score")
    prep = fit_preprocessor(fit_rows, [f])
    labels = label_table(fit_rows, [f])
    a = prep.transform(li).select("l_orderkey", "l_linenumber", index_col("l_quantity"))
    b = apply_label_table(li, labels, f).select("l_orderkey", "l_linenumber", index_col("l_quantity"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_labels_invariant_to_partitioning(spark):
    li = table(spark, SF_CHECK, "lineitem")
    a = indexer_of(fit_preprocessor(li.repartition(3), FEATS)).labelsArray
    b = indexer_of(fit_preprocessor(li.repartition(11, "l_tax"), FEATS)).labelsArray
    assert [list(x) for x in a] == [list(x) for x in b]


def test_per_column_stages_equal_multi_column(spark):
    """Reference layout (one indexer + one encoder per column, 2N+1 stages)
    gives the same assembled vectors as the multi-column stages."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
    from scorewell.operators.encoding import canonical_text
    li = table(spark, SF_CHECK, "lineitem")
    text = canonical_text(li, FEATS).withColumn("rid", F.monotonically_increasing_id())
    text = text.persist()
    stages, vecs = [], []
    for f in FEATS:
        stages.append(StringIndexer(inputCol=f.name, outputCol=f.name + "_i", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCol=f.name + "_i", outputCol=f.name + "_v",
                                    handleInvalid="keep"))
        vecs.append(f.name + "_v")
    stages.append(VectorAssembler(inputCols=vecs, outputCol="ref_features"))
    ref = Pipeline(stages=stages).fit(text).transform(text)
    ours = fit_preprocessor(text, [Feature(f.name, "category") for f in FEATS]).transform(text)
    a = ref.select("rid", vector_to_array("ref_features").alias("v"))
    b = ours.select("rid", vector_to_array("features").alias("v"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    text.unpersist()


def test_ordered_position_null_group(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2), ("a", 5), (None, 2)], "g string, k int")
    got = sorted((r["g"] or "", r["k"], r["pos"]) for r in
                 ordered_position(df, "g", [F.col("k").asc()], num_partitions=3).collect())
    assert got == [("", 1, 0), ("", 2, 1), ("", 3, 2), ("a", 2, 0), ("a", 5, 1)]


def test_apply_label_table_shuffle_path_with_hot_key(spark):
    # a third of the rows share one value (hot key), the rest spread out
    df = spark.range(0, 30000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .otherwise((F.col("id") % 997).cast("string")).alias("c"))
    f = Feature("c", "category")
    labels = label_table(df.where(F.col("id") < 20000), [f])
    broadcast = apply_label_table(df, labels, f).select("id", index_col("c"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle join
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        rows = apply_label_table(df, labels, f).select("id", index_col("c")).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    shuffled = spark.createDataFrame(rows, broadcast.schema)
    assert broadcast.exceptAll(shuffled).count() == 0 and shuffled.exceptAll(broadcast).count() == 0
    hot_idx = labels.where("value = 'hot'").first()["idx"]
    assert hot_idx == 0  # the most frequent label gets index 0
