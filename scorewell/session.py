"""Session-level helpers: shared scratch space and table loading.

The library never creates a SparkSession; callers own it.  Anything that
must be written (lineage cuts, round-trip sinks, stream checkpoints) goes
under the folder the cluster names in ``spark.checkpoint.dir`` so that it
survives the loss of an executor and is visible to every node.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # Spark Connect has no SparkContext
        return False


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder (HDFS,
    object store, NFS).  Only a ``local[*]`` session without it, as in tests,
    gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for lineage cuts")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="scorewell-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    root = checkpoint_dir(spark).rstrip("/")
    return f"{root}/scorewell/{name}/{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder under ``scratch_path`` that nothing reads any more."""
    if "/scorewell/" not in path:
        raise ValueError(f"{path} is no scratch folder")
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


@contextmanager
def settings(spark: SparkSession, **values: object) -> Iterator[None]:
    """Spark SQL settings that hold within the block; names with _ for the dot.

    For steps that are written in the block: a result that is only read later
    takes the settings of that time."""
    names = {k.replace("_", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_removed(spark: SparkSession):
    """A block in which the shuffle files of each write go when it ends, not
    when the driver happens to collect its garbage."""
    return settings(spark, spark_sql_classic_shuffleDependency_fileCleanup_enabled="true")


def small_batches(spark: SparkSession, **more: object):
    """A block in which tasks hand Python about 4 MB at a time, not 10,000 rows."""
    return settings(spark, spark_sql_execution_arrow_maxBytesPerBatch="4m", **more)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably (checkpoint to the shared folder).

    Used where a plan is read twice and a recompute would be costly or
    where a long lineage should not be replayed after an executor loss.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``scorewell`` importable in executor Python workers.

    Needed only where Python runs in tasks (``mapInPandas`` with a model
    object of ours).  The package is zipped once per application and handed
    to ``addPyFile``, which distributes it like ``--py-files``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, base))
    # staged in the shared folder, so executors fetch it from there
    target = scratch_path(spark, "pyfiles") + "/scorewell.zip"
    jvm = sc._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(target)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables (a plain Parquet scan)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Suggested settings for a run over ``input_bytes`` on ``cores`` cores.

    Scan splits and shuffle partitions of about ``target_partition_bytes``
    keep each task's working set well inside executor memory (spilling is
    the exception, not the rule); AQE coalesces small shuffle partitions and
    splits skewed ones at run time.
    """
    shuffle = max(cores * 3, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "scorewell") -> SparkSession:
    """Session for tests and the local bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark
