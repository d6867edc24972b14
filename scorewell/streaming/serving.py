"""Stream scoring that follows the registry (P4 + T8).

Each micro-batch looks up the model name, so a version registered while the
stream runs scores from the next batch on.  A model is loaded when it changes,
not per batch.  Candidates are the claimed versions of the name, newest
first, then the logged runs, newest first; one that does not load is passed
over.  When scoring itself fails the loaded model is given up and resolved
again, a bounded number of times.  If nothing loads, rows get the fallback.

Batches are written under ``batch=<id>`` with overwrite, so a batch replayed
after a failure replaces its own rows.  Every row names the source and the
version that scored it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.operators.catalog import load_first
from scorewell.operators.claims import CLAIMS, claimed_versions
from scorewell.operators.scoring import score
from scorewell.operators.tracking import RUNS, read_table
from scorewell.plans.serving import load_pair
from scorewell.sources.files import path_has_data

CANDIDATES = "source_rank int, source string, version int, run_id string, path string, position long"


def served_candidates(spark: SparkSession, root: str, model_name: str) -> DataFrame:
    """Models in the order in which they are tried."""
    out = spark.createDataFrame([], CANDIDATES)
    if path_has_data(spark, f"{root}/{CLAIMS}"):
        mine = claimed_versions(spark, root).where(F.col("name") == model_name)
        out = out.unionByName(mine.select(
            F.lit(0).alias("source_rank"), F.lit("registry").alias("source"), "version", "run_id", "path",
            (-F.col("version")).cast("long").alias("position")))
    if path_has_data(spark, f"{root}/{RUNS}"):
        out = out.unionByName(read_table(spark, root, RUNS).select(
            F.lit(1).alias("source_rank"), F.lit("run").alias("source"), F.lit(None).cast("int").alias("version"),
            "run_id", F.col("artifact_path").alias("path"), (-F.unix_micros("start_time")).alias("position")))
    return out


class Served:
    """The model that a stream holds between batches."""

    def __init__(self, spark: SparkSession, root: str, model_name: str, loader: Callable = load_pair):
        self.spark, self.root, self.model_name, self.loader = spark, root, model_name, loader
        self.path, self.pair = None, (None, None)

    def _load(self, path: str):
        return self.pair if path == self.path else self.loader(path)

    def resolve(self) -> tuple[str, int | None]:
        """(source, version) of the first candidate that loads; it is held from then on."""
        row, pair = load_first(served_candidates(self.spark, self.root, self.model_name), self._load)
        self.path, self.pair = (row["path"], pair) if row else (None, (None, None))
        return (row["source"], row["version"]) if row else ("fallback", None)

    def drop(self) -> None:
        self.path, self.pair = None, (None, None)


def start_registry_scoring(stream: DataFrame, root: str, model_name: str, out_path: str, checkpoint: str,
                           keep: Sequence[str] = (), attempts: int = 3, available_now: bool = True,
                           processing_time: str = "1 second", loader: Callable = load_pair):
    """Start the stream; rows carry ``model_source`` and ``model_version``."""
    served = Served(stream.sparkSession, root, model_name, loader)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(attempts):
            source, version = served.resolve()
            try:
                scored = score(batch, *served.pair, keep=keep)
                scored.select("*", F.lit(source).alias("model_source"), F.lit(version).cast("int").alias(
                    "model_version")).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
                return
            except Exception:  # a model that loads but does not score: load it anew
                served.drop()
                if attempt == attempts - 1:
                    raise

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
