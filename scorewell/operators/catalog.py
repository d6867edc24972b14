"""Artifact manifests as a table.

Manifests are small YAML-like text files next to saved models.  They are
scanned with the ``binaryFile`` source (recursive listing done by Spark,
modification time included) and read by ``functions.nested`` -- JVM-side, one
row per manifest, no driver loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.functions.nested import nested_field, nested_rows
from scorewell.operators.ranking import ordered_position

# Flavor names as written in manifests.
SPARK_FLAVOR = "mlflow.spark"
SKLEARN_FLAVOR = "mlflow.sklearn"


def manifest_text(loader_module: Column, python_version: Column, size: Column,
                  run_id: Column, created: Column) -> Column:
    """Manifest body in the layout the scanner reads."""
    return F.format_string(
        "flavors:\n  python_function:\n    loader_module: %s\n    python_version: %s\n"
        "model_size_bytes: %s\nrun_id: %s\nutc_time_created: '%s'\n",
        loader_module, python_version, size.cast("string"), run_id, created)


def write_manifests(df: DataFrame, root: str, dir_col: str = "run_id",
                    text_col: str = "manifest") -> str:
    """One manifest file per artifact folder ``<root>/<dir_col>=<value>/``."""
    df.select(dir_col, text_col).write.mode("overwrite").partitionBy(dir_col).text(root)
    return root


def save_manifest(spark: SparkSession, folder: str, text: str, name: str = "MLmodel") -> str:
    """Write one manifest beside a saved model; an earlier one is replaced."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return folder


def manifest_catalog(spark: SparkSession, root: str, file_glob: str = "MLmodel",
                     dir_name: str | None = None) -> DataFrame:
    """``(artifact_dir, path, mtime, loader_module, python_version,
    model_size_bytes, run_id, utc_time_created)`` for every manifest.

    Manifests are found at any depth under ``root``; ``dir_name`` (e.g.
    ``"artifacts"``) keeps only those whose folder has that name.  ``mtime``
    is the manifest file's modification time.  A field that is absent reads
    as null (a failed loader lookup gives no loader either).
    """
    files = (spark.read.format("binaryFile")
             .option("recursiveFileLookup", "true")
             .option("pathGlobFilter", file_glob)
             .load(root))
    if dir_name is not None:
        files = files.where(F.col("path").endswith(f"/{dir_name}/" + file_glob))
    read = files.select("path", "modificationTime", nested_rows(F.col("content").cast("string")).alias("rows"))

    def field(path: str) -> Column:
        return nested_field(F.col("rows"), path)
    return read.select(
        F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("artifact_dir"),
        "path",
        F.col("modificationTime").alias("mtime"),
        field("flavors.python_function.loader_module").alias("loader_module"),
        field("flavors.python_function.python_version").alias("python_version"),
        field("model_size_bytes").try_cast("bigint").alias("model_size_bytes"),
        field("run_id").alias("run_id"),
        F.try_to_timestamp(field("utc_time_created"), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("utc_time_created"),
    )


def flavor_rank(loader: Column, load_spark: bool) -> Column:
    """Spark mode ranks spark 0, other 1, sklearn 2; otherwise mirrored."""
    first, last = (SPARK_FLAVOR, SKLEARN_FLAVOR) if load_spark else (SKLEARN_FLAVOR, SPARK_FLAVOR)
    lm = F.coalesce(loader, F.lit(""))
    return F.when(lm == first, 0).when(lm == last, 2).otherwise(1)


def rank_artifacts(catalog: DataFrame, load_spark: bool = True,
                   time_col: str = "mtime") -> DataFrame:
    """Candidates in load order, the disallowed flavor removed.

    Order: flavor rank, newest first, path.  ``position`` is a distributed
    dense position (the catalog can be large).
    """
    banned = SKLEARN_FLAVOR if load_spark else SPARK_FLAVOR
    c = (catalog.where(F.coalesce(F.col("loader_module"), F.lit("")) != banned)
         .withColumn("flavor_rank", flavor_rank(F.col("loader_module"), load_spark))
         .withColumn("_all", F.lit(0)))
    ranked = ordered_position(
        c, "_all", [F.col("flavor_rank").asc(), F.col(time_col).desc(), F.col("path").asc()],
        name="position")
    return ranked.drop("_all")


def model_candidates(registry_latest: DataFrame, model_dirs: DataFrame, ranked: DataFrame,
                     model_name: str) -> DataFrame:
    """T8 candidates in load order: registry latest -> newest model folder
    -> ranked artifacts, as ``(source_rank, source, run_id, path, position)``."""
    reg = registry_latest.where(F.col("name") == model_name).select(
        F.lit(0).alias("source_rank"), F.lit("registry").alias("source"),
        F.col("run_id"), F.col("path"), F.lit(0).cast("bigint").alias("position"))
    newest = model_dirs.orderBy(F.col("mtime").desc(), F.col("path").asc()).limit(1).select(
        F.lit(1).alias("source_rank"), F.lit("model_dir").alias("source"),
        F.col("run_id"), F.col("path"), F.lit(0).cast("bigint").alias("position"))
    art = ranked.select(F.lit(2).alias("source_rank"), F.lit("artifact").alias("source"),
                        "run_id", F.col("artifact_dir").alias("path"), "position")
    return reg.unionByName(newest).unionByName(art)


def resolve_model(registry_latest: DataFrame, model_dirs: DataFrame, ranked: DataFrame,
                  model_name: str) -> DataFrame:
    """The first candidate (top-1 of ``model_candidates``)."""
    return model_candidates(registry_latest, model_dirs, ranked, model_name).orderBy(
        "source_rank", "position").limit(1)


def load_first(candidates: DataFrame, loader):
    """Try candidates in order, return ``(row, model)`` of the first that
    loads, or ``(None, None)`` when none does.

    Candidates are sorted once and reach the driver a partition at a time;
    loading a model is a driver action anyway.
    """
    for row in candidates.orderBy("source_rank", "position", "path").toLocalIterator():
        try:
            return row, loader(row["path"])
        except Exception:  # a broken artifact: fall through to the next one
            continue
    return None, None


def readiness(catalog: DataFrame, preprocessor_present: Column | None = None) -> DataFrame:
    """One-row readiness summary of a manifest catalog."""
    pre = preprocessor_present if preprocessor_present is not None else F.lit(False)
    agg = catalog.agg(
        F.count(F.lit(1)).alias("n_artifacts"),
        F.coalesce(F.bool_or(F.col("loader_module") == SPARK_FLAVOR), F.lit(False))
         .alias("spark_artifacts_present"))
    return agg.select(
        "n_artifacts", "spark_artifacts_present", pre.alias("preprocessor_present"),
        F.when(F.col("spark_artifacts_present") & pre, F.lit("spark")).alias("model_type"),
        (F.col("spark_artifacts_present") & pre).alias("model_loaded"))
