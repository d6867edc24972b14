"""Mergeable evaluation state and splits of exact size."""

import random

import pytest
from pyspark.sql import functions as F

from scorewell.operators.exact_split import exact_split, order_bound
from scorewell.operators.moments import append_moments, error_moments, merged_moments, metrics_of, read_moments
from scorewell.operators.regression import regression_metrics


def predictions(spark, rows=400, shift=0.0, seed=1):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "b", None]), i % 5, shift + rng.random(), shift + rng.random()) for i in range(rows)]
    data += [("a", 1, None, 1.0), ("a", 1, 1.0, None), ("only nulls", 0, None, None)]
    return spark.createDataFrame(data, "g string, k int, label double, prediction double")


@pytest.mark.parametrize("by", [[], ["g"]])
def test_merged_batches_equal_one_evaluation(spark, tmp_path, by):
    df = predictions(spark)
    for k in range(5):
        append_moments(error_moments(df.where(F.col("k") == k), by=by), str(tmp_path), str(k))
    append_moments(error_moments(df.where("k = 2"), by=by), str(tmp_path), "2")  # a batch that is run again
    got = {tuple(r[c] for c in by): r for r in metrics_of(merged_moments(read_moments(spark, str(tmp_path)), by)).collect()}
    want = {tuple(r[c] for c in by): r for r in regression_metrics(df, group_cols=by).collect() if r.n}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert got[k].n == w.n
        assert (got[k].rmse, got[k].r2) == (pytest.approx(w.rmse, rel=1e-12), pytest.approx(w.r2, rel=1e-9))


def test_merging_goes_on_and_keeps_digits(spark):
    near = predictions(spark, shift=0.0)
    far = near.withColumn("label", F.col("label") + 1e9).withColumn("prediction", F.col("prediction") + 1e9)
    parts = [error_moments(far.where(F.col("k") == k)) for k in range(5)]
    once = merged_moments(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    twice = metrics_of(merged_moments(once.unionByName(parts[3]).unionByName(parts[4]))).first()
    want = regression_metrics(near).first()
    assert twice.n == want.n and twice.r2 == pytest.approx(want.r2, rel=1e-5)


def test_edges_of_moments(spark):
    none = predictions(spark).where("label > 99")
    assert metrics_of(merged_moments(error_moments(none))).collect() == []
    same = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "label double, prediction double")
    got = metrics_of(merged_moments(error_moments(same))).first()
    assert (got.n, got.rmse, got.r2) == (2, 1.0, None)


def parts(df, keys, size):
    return [sorted(map(str, map(tuple, p.collect()))) for p in exact_split(df, keys, size)]


@pytest.mark.parametrize("size", [0.0, 0.1, 0.2, 0.5, 0.77, 1.0])
def test_exact_size_on_any_layout(spark, size):
    rows = [(i, "x" * (i % 7), None if i % 11 == 0 else i * 0.5) for i in range(1003)]
    df = spark.createDataFrame(rows, "id long, t string, v double")
    train, test = parts(df.repartition(7), ["id"], size)
    assert len(test) == int(size * 1003 + 0.5) and sorted(train + test) == sorted(map(str, rows))
    assert (train, test) == tuple(parts(df.coalesce(1).orderBy(F.desc("id")), ["id"], size))


def test_copies_and_nulls_are_split_exactly(spark):
    rows = [(1, "a")] * 40 + [(None, None)] * 30 + [(2, "b")] * 20 + [(i, "c") for i in range(3, 13)]
    df = spark.createDataFrame(rows, "id long, t string").repartition(5)
    for size in (0.05, 0.33, 0.5, 0.9):
        train, test = parts(df, ["id", "t"], size)
        assert len(test) == int(size * 100 + 0.5) and sorted(train + test) == sorted(map(str, rows))
    assert parts(df.limit(0), ["id"], 0.5) == [[], []]
    with pytest.raises(ValueError):
        exact_split(df, ["id"], 1.5)


def test_bound_is_the_order_statistic(spark):
    df = spark.range(500).select(F.col("id"), F.xxhash64("id").alias("h"))
    hashes = sorted(r.h for r in df.collect())
    for rank in (1, 2, 250, 500):
        assert order_bound(df, ["id"], rank) == (hashes[rank - 1], 1)
