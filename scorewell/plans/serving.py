"""Resolve, load, then score (T8 + P1): the serving path over tables.

Candidates in order: the latest registered version of the model name, then
the artifacts of all logged runs, newest first.  The first whose
preprocessor and model both load scores the table; if none does, the rows
get the fallback.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.operators.catalog import load_first
from scorewell.operators.scoring import score
from scorewell.operators.tracking import RUNS, VERSIONS, latest_versions, read_table
from scorewell.sources.files import path_has_data
from scorewell.sources.models import load_linear, load_pipeline


def candidates(spark: SparkSession, root: str, model_name: str) -> DataFrame:
    """``(source_rank, source, run_id, path, position)`` from the tables under ``root``."""
    runs = read_table(spark, root, RUNS).select(
        F.lit(1).alias("source_rank"), F.lit("run").alias("source"), "run_id",
        F.col("artifact_path").alias("path"), (-F.unix_micros("start_time")).alias("position"))
    if not path_has_data(spark, f"{root}/{VERSIONS}"):
        return runs
    latest = latest_versions(read_table(spark, root, VERSIONS)).where(F.col("name") == model_name)
    return latest.select(F.lit(0).alias("source_rank"), F.lit("registry").alias("source"), "run_id",
                         "path", F.lit(0).cast("bigint").alias("position")).unionByName(runs)


def load_pair(path: str):
    """(preprocessor, model) of a run; the preprocessor lies beside the model."""
    return load_pipeline(path.rsplit("/", 1)[0] + "/preprocessor"), load_linear(path)


def score_from_registry(spark: SparkSession, root: str, df: DataFrame, model_name: str,
                        keep: Sequence[str] = (), compiled: bool = False) -> tuple[str, DataFrame]:
    """(source of the model that scored, scored rows)."""
    row, pair = load_first(candidates(spark, root, model_name), load_pair)
    prep, model = pair or (None, None)
    return (row["source"] if row else "fallback"), score(df, prep, model, keep, compiled)
