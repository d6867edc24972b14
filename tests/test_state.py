"""Profiles from stored sketches, records kept whole, models of any flavor."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorewell.operators import catalog as C
from scorewell.operators.encoding import Feature
from scorewell.operators.flavors import (LOADERS, manifest_of, resolve_loaded, save_python_model, score_resolved)
from scorewell.operators.sketches import current_states, file_states, merged_profile, quantile, update_profile
from scorewell.sources.records import validate_records
from scorewell.sources.variants import validate_variants


def numbers(spark, lo, hi):
    return spark.range(lo, hi).select(
        "id", (F.col("id") % 7).cast("int").alias("seven"), F.when(F.col("id") % 4 > 0, F.col("id") * 0.5).alias("half"),
        F.lit(None).cast("string").alias("none"), F.col("id").cast("string").alias("odd name`"))


def test_only_new_files_are_scanned(spark, tmp_path):
    data, states = str(tmp_path / "data"), str(tmp_path / "states")
    numbers(spark, 0, 3000).repartition(3).write.mode("append").parquet(data)
    assert update_profile(spark, data, states) == 3 and update_profile(spark, data, states) == 0
    numbers(spark, 2000, 5000).repartition(2).write.mode("append").parquet(data)
    assert update_profile(spark, data, states) == 2
    file_states(spark.read.parquet(data)).write.mode("append").parquet(states)  # a job that was run again
    got = {r.col_name: r for r in merged_profile(current_states(spark, data, states)).withColumn(
        "median", quantile(0.5)).collect()}
    assert list(got) and {r.n_files for r in got.values()} == {5} and {r.n_rows for r in got.values()} == {6000}
    assert [got[c].n_null for c in ("id", "half", "none")] == [0, 1500, 6000]
    assert got["seven"].n_distinct == 7 and got["none"].n_distinct == 0 and got["none"].median is None
    for c, n in (("id", 5000), ("half", 3750), ("odd name`", 5000)):
        assert got[c].n_distinct == pytest.approx(n, rel=0.04)
    assert abs(got["id"].median - 2500) < 120 and abs(got["half"].median - 1250) < 60
    assert got["half"].data_type == "double" and got["odd name`"].median is None


def test_profile_of_the_union_equals_the_merge(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    numbers(spark, 0, 4000).coalesce(1).write.parquet(a)
    numbers(spark, 3000, 9000).coalesce(1).write.parquet(b)
    parts = file_states(spark.read.parquet(a)).unionByName(file_states(spark.read.parquet(b)))
    whole = file_states(spark.read.parquet(a, b))
    counts = ["col_name", "n_files", "n_rows", "n_null", "n_distinct"]
    rows = [sorted(map(tuple, merged_profile(x).select(*counts).collect())) for x in (parts, whole)]
    assert rows[0] == rows[1]
    again = merged_profile(parts).select("position", "col_name", "data_type", F.lit("m").alias("file"), "n_rows", "n_null",
                                         "distinct_sketch", "quantile_sketch")
    twice = merged_profile(again.unionByName(again)).where("col_name = 'id'").first()
    assert twice.n_distinct == dict((r[0], r[4]) for r in rows[0])["id"] and twice.n_rows == 20000


def test_files_that_are_gone_no_longer_count(spark, tmp_path):
    data, states = str(tmp_path / "data"), str(tmp_path / "states")
    numbers(spark, 0, 100).coalesce(1).write.parquet(data)
    update_profile(spark, data, states)
    numbers(spark, 500, 560).coalesce(1).write.mode("overwrite").parquet(data)
    assert update_profile(spark, data, states) == 1
    got = merged_profile(current_states(spark, data, states)).where("col_name = 'id'").first()
    assert (got.n_files, got.n_rows, got.n_distinct) == (1, 60, 60)
    numbers(spark, 0, 0).write.mode("overwrite").parquet(data)
    assert update_profile(spark, data, states) == 0
    assert merged_profile(current_states(spark, data, states)).collect() == []


def test_not_a_number_has_no_place_among_quantiles(spark, tmp_path):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (3.0,), (2.0,), (None,)], "v double")
    df.coalesce(1).write.parquet(str(tmp_path / "v"))
    got = merged_profile(file_states(spark.read.parquet(str(tmp_path / "v")))).withColumn("m", quantile(0.5)).first()
    assert (got.n_null, got.n_distinct, got.m) == (1, 4, 2.0)


RECORDS = ['{"a": 1, "b": {"c": "2.5", "d": [1, 2]}, "x": "y", "z": null}', '{"a": "7e2", "b": {"c": -3}}',
           '{"a": 1}', '{"a": 1, "b": {"c": null}}', '{"a": 1, "b": 4}', '{"a": {"k": 1}, "b": {"c": 1}}',
           '{"a": "1f", "b": {"c": 1}}', '{"a": "NaN", "b": {"c": 1}}', '{"a": true, "b": {"c": 1}}', '[1]', '"t"',
           '{"a": 1', "", None, '{"a": 1, "a": 2, "b": {"c": 1}}', '{"a": " 12 ", "b": {"c": 0}, "": 1, "é $": "ü"}']


def test_variant_records(spark):
    df = spark.createDataFrame(list(enumerate(RECORDS)), "id int, rec string")
    out = validate_variants(df, "rec", ["a", "b.c"], keep=["id"])
    assert out.columns == ["id", "a", "b.c", "others", "error", "valid"]
    got = {r.id: r for r in out.collect()}
    assert [(got[i].a, got[i]["b.c"]) for i in (0, 1, 15)] == [(1.0, 2.5), (700.0, -3.0), (12.0, 0.0)]
    assert [got[i].error for i in range(len(RECORDS))] == [
        None, None, "missing b.c", "missing b.c", "missing b.c", "not a number: a", "not a number: a",
        "not a finite number: a", "not a number: a", *["not a JSON object"] * 4, "missing a", "not a JSON object", None]
    assert all(r.valid == (r.error is None) for r in got.values())
    assert got[0].others == {"x": '"y"', "z": "null"} and got[2].others == {} and got[9].others is None
    assert got[15].others == {"": "1", "é $": '"ü"'}


def test_variant_records_agree_with_text_fields(spark):
    flat = [r for r in RECORDS if r is None or (r.startswith("{") and r.endswith("}") and r.count('"a"') == 1)]
    df = spark.createDataFrame(list(enumerate(flat)), "id int, rec string")
    one = validate_variants(df, "rec", ["a"], keep=["id"]).select("id", "a", "error", "valid")
    assert sorted(map(str, one.collect())) == sorted(map(str, validate_records(df, "rec", ["a"], ["id"]).collect()))


def test_records_are_parsed_once(spark):
    df = spark.createDataFrame([(1, RECORDS[0])], "id int, rec string")
    plan = validate_variants(df, "rec", ["a", "b.c"], ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json") + plan.count("parseJson") == 1


def twice():
    """A model of twice the level, as a share; a class made here is pickled whole."""
    class Twice:
        def predict(self, pdf: pd.DataFrame):
            return pdf["level"].astype(float) * 0.02
    return Twice()


def test_flavors_by_mode(spark, tmp_path):
    root, df = str(tmp_path), spark.createDataFrame([(i, i % 10) for i in range(50)], "id int, level int")
    save_python_model(spark, twice(), [Feature("level", "score")], f"{root}/deep/one/artifacts", "one")
    C.save_manifest(spark, f"{root}/two/artifacts", manifest_of(C.SKLEARN_FLAVOR, "two"))
    C.save_manifest(spark, f"{root}/three/artifacts", manifest_of("models.unknown", "three"))
    (tmp_path / "four" / "artifacts").mkdir(parents=True)
    (tmp_path / "four" / "artifacts" / "model-x.pkl").write_bytes(b"not a pickle")
    C.save_manifest(spark, f"{root}/four/artifacts", manifest_of(C.SKLEARN_FLAVOR, "four"))
    loader, scored = score_resolved(df, root, load_spark=False, keep=["id"])
    assert loader == C.SKLEARN_FLAVOR
    assert {r.id: r.probability for r in scored.collect()} == {i: pytest.approx(i % 10 * 0.02) for i in range(50)}
    loader, scored = score_resolved(df, root, load_spark=True, keep=["id"])
    assert loader == "fallback" and {(r.probability, r.status) for r in scored.collect()} == {(0.5, "fallback")}


def test_other_loaders_may_be_named(spark, tmp_path):
    C.save_manifest(spark, f"{tmp_path}/one/artifacts", manifest_of("models.constant", "one"))
    catalog = C.manifest_catalog(spark, str(tmp_path), dir_name="artifacts")
    constant = {**LOADERS, "models.constant": lambda s, folder: lambda df, keep: df.select(*keep, F.lit(folder).alias("from"))}
    row, scorer = resolve_loaded(spark, catalog, True, constant)
    assert row.run_id == "one"
    assert json.dumps(scorer(spark.range(1), ["id"]).first().asDict()).endswith('one/artifacts"}')
    assert resolve_loaded(spark, catalog, True) == (None, None)
