"""Models of any flavor, loaded from their artifact folders.

A manifest names the module that loads its model.  ``LOADERS`` maps such names
to functions (spark, folder) -> scorer, a scorer being (table, kept columns) ->
scored rows.  ``score_resolved`` walks the ranked manifests of the mode and
scores with the first one that loads.

A Python model is saved with its features in one file beside the manifest and
shipped to the executors as a file of the session (``addFile``): each worker
loads it once, rows cross in Arrow batches, and no size of the model is
refused.  Unpickling runs code, so artifact folders must be trusted ones.

Edge cases: a flavor without a loader, a missing file and one that does not
load are passed over; if none loads the rows get the fallback; the flavor that
the mode rules out is never tried.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark import SparkFiles, cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from scorewell.operators.catalog import (SKLEARN_FLAVOR, SPARK_FLAVOR, manifest_catalog,
                                         rank_artifacts, save_manifest)
from scorewell.operators.encoding import Feature, as_features
from scorewell.operators.scoring import score, score_fallback, score_with
from scorewell.sources.models import load_linear, load_pipeline, save_model

Scorer = Callable[[DataFrame, Sequence[str]], DataFrame]
Loader = Callable[[SparkSession, str], Scorer]

MODEL_FILE = "model-{}.pkl"


def manifest_of(loader_module: str, run_id: str, size: int = 0) -> str:
    return (f"flavors:\n  python_function:\n    loader_module: {loader_module}\n"
            f"model_size_bytes: {size}\nrun_id: {run_id}\n")


def save_python_model(spark: SparkSession, model, features: Sequence[Feature | str], folder: str,
                      run_id: str, loader_module: str = SKLEARN_FLAVOR) -> str:
    """Save a model with its features, then its manifest: a folder whose
    manifest is there is complete."""
    payload = cloudpickle.dumps((model, as_features(features)))
    _write(spark, f"{folder}/{MODEL_FILE.format(uuid.uuid4().hex)}", payload)
    return save_manifest(spark, folder, manifest_of(loader_module, run_id, len(payload)))


def save_spark_model(spark: SparkSession, preprocessor, model, folder: str, run_id: str) -> str:
    save_model(preprocessor, f"{folder}/preprocessor")
    save_model(model, f"{folder}/model")
    return save_manifest(spark, folder, manifest_of(SPARK_FLAVOR, run_id))


def _write(spark: SparkSession, file: str, payload: bytes) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(payload))
    finally:
        out.close()


def _newest(spark: SparkSession, folder: str, pattern: str) -> Row | None:
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
             .select("path", "modificationTime"))
    return files.orderBy(F.desc("modificationTime"), "path").first()


_LOADED: dict[str, tuple] = {}


def _unpickled(name: str) -> tuple:
    """(model, features) of a shipped file, once for each Python worker."""
    if name not in _LOADED:
        with open(SparkFiles.get(name), "rb") as f:
            _LOADED[name] = pickle.load(f)
    return _LOADED[name]


def load_python_model(spark: SparkSession, folder: str) -> Scorer:
    found = _newest(spark, folder, MODEL_FILE.format("*"))
    if found is None:
        raise FileNotFoundError(f"no model file in {folder}")
    spark.sparkContext.addFile(found.path)
    name = found.path.rsplit("/", 1)[-1]
    _, features = _unpickled(name)  # the driver reads it as well, so a broken file is passed over here

    def scorer(df: DataFrame, keep: Sequence[str]) -> DataFrame:
        return score_with(df, lambda: _unpickled(name)[0], features, keep)
    return scorer


def load_spark_model(spark: SparkSession, folder: str) -> Scorer:
    prep, model = load_pipeline(f"{folder}/preprocessor"), load_linear(f"{folder}/model")
    return lambda df, keep: score(df, prep, model, keep)


LOADERS: dict[str, Loader] = {SPARK_FLAVOR: load_spark_model, SKLEARN_FLAVOR: load_python_model}


def resolve_loaded(spark: SparkSession, catalog: DataFrame, load_spark: bool = True,
                   loaders: Mapping[str, Loader] = LOADERS) -> tuple[Row | None, Scorer | None]:
    """The first artifact of the mode's order that loads, with its scorer."""
    for row in rank_artifacts(catalog, load_spark).orderBy("position").toLocalIterator():
        try:
            return row, loaders[row.loader_module](spark, row.artifact_dir)
        except Exception:  # no loader, or a broken artifact: the next one
            continue
    return None, None


def score_resolved(df: DataFrame, root: str, load_spark: bool = True, keep: Sequence[str] = (),
                   loaders: Mapping[str, Loader] = LOADERS) -> tuple[str, DataFrame]:
    """(loader of the model that scored or "fallback", scored rows): manifests
    under ``root`` -> ranking by mode -> load -> score."""
    spark = df.sparkSession
    row, scorer = resolve_loaded(spark, manifest_catalog(spark, root, dir_name="artifacts"), load_spark, loaders)
    return (row.loader_module, scorer(df, keep)) if scorer else ("fallback", score_fallback(df, keep))
