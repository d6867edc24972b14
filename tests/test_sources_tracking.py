"""Sources/sinks, row operators, tracking tables and the manifest catalog."""

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMALL
from scorewell.operators import catalog as C
from scorewell.operators import rows as R
from scorewell.operators import tracking as TR
from scorewell.operators.encoding import Feature
from scorewell.plans.serving import score_from_registry
from scorewell.plans.training import TrainParams, run_pipeline
from scorewell.session import scratch_path, table
from scorewell.sources import files as SRC
from scorewell.sources.records import validate_records


def test_csv_roundtrip_infers_types(spark):
    out = scratch_path(spark, "t_csv")
    SRC.write_csv(table(spark, SF_SMALL, "orders").select("o_orderkey", "o_totalprice",
                                                          "o_orderstatus"), out)
    back = SRC.read_csv(spark, out)
    assert dict(back.dtypes) == {"o_orderkey": "int", "o_totalprice": "double",
                                 "o_orderstatus": "string"}


def test_ingest_idempotent_and_single_file(spark):
    out = scratch_path(spark, "t_ingest")
    o = table(spark, SF_SMALL, "orders")
    first = SRC.ingest(spark, o.where("o_orderstatus = 'F'"), out).count()
    again = SRC.ingest(spark, o, out).count()
    assert first == again < o.count()
    # a single file (not a folder) counts as data
    assert SRC.path_has_data(spark, os.path.join(SF_SMALL, "orders.parquet"))
    assert not SRC.path_has_data(spark, scratch_path(spark, "t_none"))


def test_first_readable_and_none(spark):
    miss = scratch_path(spark, "t_miss")
    path, df = SRC.first_readable(spark, [miss, os.path.join(SF_SMALL, "region.parquet")])
    assert path.endswith("region.parquet") and df.count() == 5
    with pytest.raises(FileNotFoundError):
        SRC.first_readable(spark, [miss])


def test_validate_records(spark):
    df = spark.createDataFrame([('{"a": 1, "b": "2.5"}',), ('{"a": 1}',), ('{"a": "x", "b": 3}',),
                                ("not json",), ('{"a": "NaN", "b": 1}',), ('{"a": 1, "b": "-inf"}',)],
                               "rec string")
    got = validate_records(df, "rec", ["a", "b"]).collect()
    assert [r["valid"] for r in got] == [True, False, False, False, False, False]
    assert [r["error"] for r in got] == [None, "missing b", "not a number: a", "missing a",
                                         "not a finite number: a", "not a finite number: b"]
    assert got[0]["b"] == 2.5


def test_hash_split_stable_under_repartition(spark):
    o = table(spark, SF_CHECK, "orders")
    a, _ = R.hash_split(o, "o_orderkey", 0.2)
    b, _ = R.hash_split(o.repartition(7), "o_orderkey", 0.2)
    assert a.select("o_orderkey").exceptAll(b.select("o_orderkey")).count() == 0
    nulls = o.withColumn("k", F.expr("nullif(o_orderkey % 3, 1)"))
    for fraction in (0.004, 0.5, 0.0, 1.0):
        c, d = R.hash_split(nulls, ["k", "o_orderkey"], fraction)
        assert c.count() + d.count() == o.count()
        flagged = R.with_split_flag(nulls, ["k", "o_orderkey"], fraction).where("split = 'test'")
        assert d.count() == flagged.count()
        assert abs(d.count() / o.count() - fraction) < 0.03
    null_key, _ = R.hash_split(nulls.where("k is null"), "k", 0.2)
    assert null_key.count() in (0, nulls.where("k is null").count())
    tr, te = R.random_split(o, 0.2, 42)
    assert tr.count() + te.count() == o.count()
    assert tr.join(te, "o_orderkey").count() == 0


def test_column_profile(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (3, None)], "x int, y string")
    rows = {r["col_name"]: r for r in R.column_profile(df).collect()}
    assert (rows["x"]["n_null"], rows["x"]["n_distinct"], rows["x"]["data_type"]) == (1, 2, "int")
    assert (rows["y"]["n_null"], rows["y"]["n_distinct"]) == (1, 1)


def test_best_run_and_registry(spark):
    runs = spark.createDataFrame([
        ("e", "r1", "a", "2024-01-01 00:00:00", "p1"), ("e", "r2", "b", "2024-01-02 00:00:00", "p2"),
        ("e", "r3", "c", "2024-01-03 00:00:00", "p3"), ("f", "r4", "d", "2024-01-01 00:00:00", "p4")],
        "experiment string, run_id string, run_name string, start_time string, artifact_path string",
    ).withColumn("start_time", F.to_timestamp("start_time"))
    metrics = spark.createDataFrame([("r1", "test_r2", 0.5), ("r2", "test_r2", 0.9),
                                     ("r3", "test_r2", 0.9)], "run_id string, key string, value double")
    assert TR.best_run(runs, metrics, "e").first()["run_id"] == "r3"  # tie -> newest
    assert TR.best_run(runs, metrics, "nope").count() == 0
    per = {r["experiment"]: r["run_id"] for r in TR.best_run_per_experiment(runs, metrics).collect()}
    assert per == {"e": "r3", "f": "r4"}  # f has no metric: still its only run
    v1 = TR.register_versions(runs.where("run_id in ('r1','r2')"), F.lit("m"))
    v2 = TR.register_versions(runs.where("run_id = 'r3'"), F.lit("m"), existing=v1)
    assert sorted((r["run_id"], r["version"]) for r in v1.unionByName(v2).collect()) == [
        ("r1", 1), ("r2", 2), ("r3", 3)]
    latest = TR.latest_versions(v1.unionByName(v2)).first()
    assert (latest["version"], latest["path"]) == (3, "p3")


def test_manifest_catalog_rank_and_readiness(spark, tmp_path):
    root = tmp_path / "mlruns"
    specs = [("a", "mlflow.spark", 100), ("b", "mlflow.sklearn", 200), ("c", "custom.loader", 300),
             ("d", None, 400)]
    for name, loader, mtime in specs:
        d = root / name / "artifacts"
        d.mkdir(parents=True)
        body = "flavors:\n  python_function:\n"
        if loader:
            body += f"    loader_module: {loader}\n"
        body += f"model_size_bytes: {mtime}\nrun_id: {name}\n"
        (d / "MLmodel").write_text(body)
        os.utime(d / "MLmodel", (mtime, mtime))
    stray = root / "e" / "notes"
    stray.mkdir(parents=True)
    (stray / "MLmodel").write_text("run_id: e\n")
    assert C.manifest_catalog(spark, str(root)).count() == 5
    cat = C.manifest_catalog(spark, str(root), dir_name="artifacts")
    assert cat.count() == 4
    spark_order = [r["run_id"] for r in C.rank_artifacts(cat, True).orderBy("position").collect()]
    assert spark_order == ["a", "d", "c"]  # sklearn dropped; others newest first
    skl_order = [r["run_id"] for r in C.rank_artifacts(cat, False).orderBy("position").collect()]
    assert skl_order == ["b", "d", "c"]
    ready = C.readiness(cat, F.lit(True)).first()
    assert ready["spark_artifacts_present"] and ready["model_type"] == "spark"


def test_train_register_run(spark):
    root = scratch_path(spark, "t_pipeline")
    p = TrainParams(sources=[scratch_path(spark, "t_absent"),
                             os.path.join(SF_SMALL, "lineitem.parquet")],
                    root=root, features=[Feature("l_returnflag", "category"), "l_linenumber"],
                    target="l_extendedprice", experiment="t", model_name="tm")
    first = run_pipeline(spark, p)
    second = run_pipeline(spark, p)
    assert (first["latest_version"], second["latest_version"]) == (1, 2)
    assert first["n_test"] == second["n_test"] and first["r2"] == pytest.approx(second["r2"])
    other = run_pipeline(spark, dataclasses.replace(p, model_name="other"))
    assert other["latest_version"] == 1 and other["latest_path"]
    assert spark.read.parquet(f"{root}/runs").count() == 3
    train, test = (spark.read.parquet(f"{root}/processed/{first['run_id']}/{x}") for x in ("train", "test"))
    assert train.columns == ["features", "label"]
    assert train.count() + test.count() == table(spark, SF_SMALL, "lineitem").count()
    assert {r.key for r in spark.read.parquet(f"{root}/metric_info").collect()} == {"test_r2", "test_rmse"}
    assert spark.read.parquet(f"{root}/run_params").where("stage = 'StringIndexer'").count() > 0
    source, rows = score_from_registry(spark, root, table(spark, SF_SMALL, "lineitem"), "tm")
    assert source == "registry" and rows.where("status = 'success'").count() == train.count() + test.count()


def test_load_first_falls_through(spark):
    cands = spark.createDataFrame(
        [(0, "registry", "r0", "/nope/0", 0), (2, "artifact", "r2", "/ok/2", 1),
         (2, "artifact", "r1", "/ok/1", 0)],
        "source_rank int, source string, run_id string, path string, position bigint")

    def loader(path):
        if path.startswith("/nope"):
            raise OSError(path)
        return f"model@{path}"
    row, model = C.load_first(cands, loader)
    assert row["run_id"] == "r1" and model == "model@/ok/1"
    assert C.load_first(cands.where("source_rank = 0"), loader) == (None, None)
    # more failing candidates than one page: the later good one is still found
    many = spark.range(0, 45).selectExpr(
        "2 AS source_rank", "'artifact' AS source", "CAST(id AS STRING) AS run_id",
        "CASE WHEN id = 44 THEN '/ok/44' ELSE concat('/nope/', id) END AS path", "id AS position")
    row, model = C.load_first(many, loader)
    assert row["run_id"] == "44" and model == "model@/ok/44"


def test_split_valid(spark):
    from scorewell.sources.records import split_valid
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": "x"}',)], "rec string")
    valid, rejects = split_valid(validate_records(df, "rec", ["a"]))
    assert valid.columns == ["a"] and valid.count() == 1
    assert rejects.first()["error"] == "not a number: a"


def test_column_profile_approx_close(spark):
    li = table(spark, SF_CHECK, "lineitem")
    exact = {r["col_name"]: r["n_distinct"] for r in R.column_profile(li).collect()}
    approx = {r["col_name"]: r["n_distinct"] for r in R.column_profile(li, exact=False).collect()}
    for c, n in exact.items():
        assert abs(approx[c] - n) <= max(2, 0.05 * n), (c, n, approx[c])


def test_first_readable_with_schema_skips_inference(spark):
    out = scratch_path(spark, "t_csv_schema")
    SRC.write_csv(table(spark, SF_SMALL, "orders").select("o_orderkey", "o_totalprice"), out)
    path, df = SRC.first_readable(spark, [scratch_path(spark, "t_no"), out], fmt="csv",
                                  schema="o_orderkey bigint, o_totalprice double", header="true")
    assert path == out and dict(df.dtypes) == {"o_orderkey": "bigint", "o_totalprice": "double"}
    assert df.count() == table(spark, SF_SMALL, "orders").count()
