"""Nested text documents, atomic claims and streams that follow the registry."""

import threading

import pytest
from pyspark.sql import functions as F

from scorewell.functions.nested import nested_field, nested_rows, read_nested
from scorewell.operators.claims import claim_version, claimed_versions
from scorewell.operators.encoding import Feature
from scorewell.plans.flagship import fit_and_predict
from scorewell.plans.training import TrainParams
from scorewell.sources.models import save_model
from scorewell.streaming.serving import start_registry_scoring


def rows(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(nested_rows(F.col("t")).alias("r")).first().r
    return [tuple(r) for r in got]


def test_levels_lists_and_scalars(spark):
    text = """# parameters
data:
  path: "a: b"   # quoted
  'odd key': x
  size: 0.2 # a share
model:
    cv: 5

    tags:
    - one
    - name: two
      deep:
        leaf: 'it''s'
    -   three
    empty:
  back: null
---
drive: file:C:/x/y#z
flow: [1, 2]
long: 'first
  second

  third'
plain: some words
  go on
last: ~"""
    assert rows(spark, text) == [
        ("data.path", "a: b"), ("data.odd key", "x"), ("data.size", "0.2"), ("model.cv", "5"), ("model.tags[0]", "one"),
        ("model.tags[1].name", "two"), ("model.tags[1].deep.leaf", "it's"), ("model.tags[2]", "three"),
        ("model.back", None), ("drive", "file:C:/x/y#z"), ("flow", "[1, 2]"), ("long", "first second  third"),
        ("plain", "some words go on"), ("last", None)]


def test_edges(spark):
    assert rows(spark, None) == rows(spark, "") == rows(spark, "\n# only\n---\n") == []
    assert rows(spark, "- a\n- b: 1\n  c: 2\n- - x") == [("[0]", "a"), ("[1].b", "1"), ("[1].c", "2"), ("[2]", "- x")]
    assert rows(spark, "k: v\r\nl:\r\n  m: \"q \\\"r\\\"\"") == [("k", "v"), ("l.m", 'q "r"')]
    df = spark.createDataFrame([("a:\n  b: 1",), ("a: 2",), (None,)], "t string")
    got = df.select(nested_field(nested_rows(F.col("t")), "a.b", F.lit("none")).alias("v")).collect()
    assert [r.v for r in got] == ["1", "none", "none"]


def test_files_at_any_depth(spark, tmp_path):
    for folder, n in (("x", 1), ("x/y/artifacts", 2)):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / folder / "MLmodel").write_text(f"flavors:\n  python_function:\n    n: {n}\n")
    got = read_nested(spark, str(tmp_path), "MLmodel")
    assert sorted((r.file.split("/")[-2], r.path, r.value) for r in got.collect()) == [
        ("artifacts", "flavors.python_function.n", "2"), ("x", "flavors.python_function.n", "1")]


def test_parameters_from_a_file(spark, tmp_path):
    (tmp_path / "params.yaml").write_text(
        "data:\n  raw_path: /in/x.parquet\n  test_size: 0.25\n  random_state: 7\n"
        "train:\n  target: y\n  split: 'hash:id'\n  features:\n  - a\n  - name: b\n    kind: category\n")
    p = TrainParams.from_file(spark, str(tmp_path / "params.yaml"), root="/out", experiment="e")
    assert (list(p.sources), p.test_size, p.seed, p.target, p.split) == (["/in/x.parquet"], 0.25, 7, "y", "hash:id")
    assert list(p.features) == [Feature("a"), Feature("b", "category")] and (p.root, p.experiment) == ("/out", "e")
    with pytest.raises(ValueError, match="target"):
        (tmp_path / "bad.yaml").write_text("data:\n  raw_path: x\n")
        TrainParams.from_file(spark, str(tmp_path / "bad.yaml"), root="/out")


def test_two_writers_share_a_name(spark, tmp_path):
    root, failed = str(tmp_path), []

    def writer(who):
        try:
            for i in range(20):
                claim_version(spark, root, f"{who}{i}", f"/m/{who}{i}", "a/b model")
        except Exception as e:  # seen by the assertion below
            failed.append(e)
    threads = [threading.Thread(target=writer, args=(w,)) for w in "pq"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    got = claimed_versions(spark, root).collect()
    assert sorted(r.version for r in got) == list(range(1, 41))
    assert len({r.run_id for r in got}) == 40 and {r.name for r in got} == {"a/b model"}
    assert claim_version(spark, root, "r", "/m/r", "other", after=5)["version"] == 6


def test_stream_follows_the_registry(spark, tmp_path):
    root, src = str(tmp_path / "reg"), str(tmp_path / "src")
    data = spark.createDataFrame([(i, str(i % 3), float(i % 3)) for i in range(60)], "id long, f string, y double")
    feats = [Feature("f", "category")]
    for name, label in (("one", F.col("y") / 10), ("two", F.col("y") / 10 + 0.5)):
        prep, lr, _ = fit_and_predict(data.withColumn("y", label), feats, "y")
        save_model(prep, f"{root}/artifacts/{name}/preprocessor")
        save_model(lr, f"{root}/artifacts/{name}/model")
    part = data.select("id", "f")
    part.where("id < 20").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(part.schema).parquet(src)
    q = start_registry_scoring(stream, root, "m", f"{tmp_path}/out", f"{tmp_path}/ck", ["id", "f"], available_now=False)
    try:
        q.processAllAvailable()  # nothing is registered: fallback
        claim_version(spark, root, "one", f"{root}/artifacts/one/model", "m")
        part.where("id >= 20 and id < 40").coalesce(1).write.mode("append").parquet(src)
        q.processAllAvailable()
        claim_version(spark, root, "two", f"{root}/artifacts/two/model", "m")
        claim_version(spark, root, "gone", f"{root}/artifacts/gone/model", "m")  # broken: passed over
        part.where("id >= 40").coalesce(1).write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert len(got) == 60
    for r in got:
        want = [("fallback", None, 0.5), ("registry", 1, int(r.f) / 10), ("registry", 2, int(r.f) / 10 + 0.5)][r.id // 20]
        assert (r.model_source, r.model_version) == want[:2] and r.probability == pytest.approx(want[2], abs=1e-4)
