"""Training pipeline (P6): ingest -> preprocess -> split -> train ->
evaluate -> log -> register, each step a DataFrame function.

The steps run in one session and stop at the first failure (an exception).
Everything written goes under ``root`` on shared storage; every run writes
model folders of its own (never a second save into an existing folder).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.functions.nested import nested_rows
from scorewell.operators.claims import claim_version
from scorewell.operators.encoding import Feature, as_features, fit_preprocessor
from scorewell.operators.regression import fit_linear, regression_metrics
from scorewell.operators.rows import drop_null_rows, hash_split, random_split
from scorewell.operators.tracking import (INFO, METRICS, RUNS, VERSIONS, best_run, log_runs,
                                          metric_definitions, param_rows, read_table)
from scorewell.sources.files import ingest_first_source, path_has_data, write_parquet
from scorewell.sources.models import save_model


@dataclass
class TrainParams:
    sources: Sequence[str]
    root: str
    features: Sequence[Feature | str]
    target: str
    source_format: str = "parquet"
    source_options: dict = field(default_factory=dict)
    source_schema: object = None  # StructType or DDL text; skips CSV inference
    test_size: float = 0.2
    seed: int = 42
    split: str = "hash"    # "hash" (of the whole row), "hash:<key column>" or "random" (layout dependent)
    fit_on: str = "all"    # "all" (reference: labels from every row) or "train"
    experiment: str = "default"
    run_name: str = "linear_regression"
    model_name: str = "model"

    @classmethod
    def from_file(cls, spark: SparkSession, path: str, **given) -> "TrainParams":
        """Parameters from a nested text file; ``given`` ones go before it.

        Read are ``data.raw_path`` (or ``data.sources``), ``data.test_size``,
        ``data.random_state`` and under ``train`` any other field by its name;
        a feature is a name, or a name and a kind.
        """
        read = spark.read.text(path, wholetext=True).select(F.explode(nested_rows(F.col("value"))).alias("r"))
        values = {r.path: r.value for r in read.select("r.path", "r.value").collect() if r.value is not None}
        lists: dict[str, dict[str, str]] = {}
        for p, v in values.items():
            if m := re.fullmatch(r"((?:data|train)\.\w+)\[(\d+)\](\.\w+)?", p):
                lists.setdefault(m[1], {})[f"{m[2]}{m[3] or ''}"] = v
        out: dict = {}
        if "data.raw_path" in values:
            out["sources"] = [values["data.raw_path"]]
        if "data.sources" in lists:
            out["sources"] = list(lists["data.sources"].values())
        features = lists.get("train.features", {})
        out["features"] = [
            Feature(features.get(f"{i}.name", features.get(str(i))), features.get(f"{i}.kind", "score"))
            for i in dict.fromkeys(k.split(".")[0] for k in features)]
        for name, source, kind in (("test_size", "data.test_size", float), ("seed", "data.random_state", int)):
            if source in values:
                out[name] = kind(values[source])
        texts = [f.name for f in fields(cls) if f.type == "str"]
        out |= {n: values[f"train.{n}"] for n in texts if f"train.{n}" in values}
        out |= given
        missing = [n for n in ("sources", "root", "features", "target") if not out.get(n)]
        if missing:
            raise ValueError(f"{path} does not say: {missing}")
        return cls(**out)


def _split_keys(df: DataFrame, p: TrainParams) -> list[str]:
    if p.split == "hash":
        return df.columns
    if p.split.startswith("hash:"):
        return [p.split[5:]]
    raise ValueError(p.split)


def _split(df: DataFrame, p: TrainParams) -> tuple[DataFrame, DataFrame]:
    if p.split == "random":
        return random_split(df, p.test_size, p.seed)
    return hash_split(df, _split_keys(df, p), p.test_size)


def run_pipeline(spark: SparkSession, p: TrainParams) -> dict:
    """The four reference steps as one job chain; returns a summary.

    As in the reference, the preprocessor is fitted on every clean row
    (``fit_on="all"``); ``fit_on="train"`` fits it on the training part only.
    The processed ``(features, label)`` parts are written under ``root`` as
    Parquet and read back, the best run of the experiment is registered, and
    each registration is a new version of the model name.
    """
    raw = ingest_first_source(spark, p.sources, f"{p.root}/raw", p.source_format,
                              schema=p.source_schema, **p.source_options)
    feats = as_features(p.features)
    clean = drop_null_rows(raw, [p.target])
    parts = _split(clean, p)
    prep = fit_preprocessor(clean if p.fit_on == "all" else parts[0], feats)
    run_id = uuid.uuid4().hex
    run_dir = f"{p.root}/artifacts/{run_id}"
    save_model(prep, f"{run_dir}/preprocessor")
    for name, part in zip(("train", "test"), parts):
        write_parquet(prep.transform(part).select(
            "features", F.col(p.target).cast("double").alias("label")), f"{p.root}/processed/{run_id}/{name}")
    train, test = (spark.read.parquet(f"{p.root}/processed/{run_id}/{name}") for name in ("train", "test"))
    lr = fit_linear(train)
    save_model(lr, f"{run_dir}/model")
    metrics = regression_metrics(lr.transform(test)).first()

    runs = spark.createDataFrame(
        [(p.experiment, run_id, p.run_name, f"{run_dir}/model")],
        "experiment string, run_id string, run_name string, artifact_path string",
    ).withColumn("start_time", F.current_timestamp())
    mrows = spark.createDataFrame(
        [(run_id, "test_r2", metrics["r2"]), (run_id, "test_rmse", metrics["rmse"])],
        "run_id string, key string, value double")
    params = param_rows(spark, lr, run_id)
    for stage in prep.stages:
        params = params.unionByName(param_rows(spark, stage, run_id))
    log_runs(p.root, runs, mrows, params)
    metric_definitions(spark).write.mode("overwrite").parquet(f"{p.root}/{INFO}")

    best = best_run(read_table(spark, p.root, RUNS), read_table(spark, p.root, METRICS), p.experiment)
    version = register_run(spark, p.root, best.first(), p.model_name)
    return {"run_id": run_id, "r2": metrics["r2"], "rmse": metrics["rmse"],
            "n_test": metrics["n"], "preprocessor": f"{run_dir}/preprocessor",
            "model": f"{run_dir}/model", "latest_version": version["version"],
            "latest_path": version["path"]}


def register_run(spark: SparkSession, root: str, run, model_name: str) -> dict:
    """T4 for one run: the next version of ``model_name``, claimed atomically,
    so several writers may register one name at a time."""
    last = 0
    if path_has_data(spark, f"{root}/{VERSIONS}"):
        last = read_table(spark, root, VERSIONS).where(F.col("name") == model_name).agg(
            F.coalesce(F.max("version"), F.lit(0))).first()[0]
    row = claim_version(spark, root, run["run_id"], run["artifact_path"], model_name, after=last)
    spark.createDataFrame([row], "name string, version int, run_id string, path string").write.mode(
        "append").parquet(f"{root}/{VERSIONS}")
    return row
