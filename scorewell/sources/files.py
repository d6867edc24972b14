"""File sources and sinks.

Existence checks use the Hadoop FileSystem of the path, so they work the
same for local folders, HDFS and object stores, and for a single file as
well as a folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_csv(spark: SparkSession, path: str, infer_schema: bool = True,
             header: bool = True, schema=None) -> DataFrame:
    """CSV file or folder with a header.

    Inference costs one extra pass over the input; pass ``schema`` to skip it
    on large inputs.
    """
    reader = spark.read.option("header", header)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer_schema).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan (filters and projections reach the reader)."""
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> str:
    """S3: Parquet sink, overwrite by default."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_has_data(spark: SparkSession, path: str) -> bool:
    """True when ``path`` is a non-empty file or a folder with any entry."""
    fs, hpath = _fs_and_path(spark, path)
    if not fs.exists(hpath):
        return False
    status = fs.getFileStatus(hpath)
    if status.isFile():
        return status.getLen() > 0
    # names with a leading _ or . are not data: a failed write leaves _temporary
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(hpath))


def ingest(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Idempotent ingest.

    If ``path`` already holds data the write is skipped and the stored table
    is returned; otherwise ``df`` is written (overwrite) and read back.
    """
    if not path_has_data(spark, path):
        write_parquet(df, path)
    return spark.read.parquet(path)


def first_readable(spark: SparkSession, candidates: Sequence[str], fmt: str = "parquet",
                   schema=None, **options) -> tuple[str, DataFrame]:
    """The first candidate path that exists and opens; error if none.

    Opening resolves the schema only: no scan for Parquet or when ``schema``
    is given; CSV with ``inferSchema`` costs one inference pass, so pass a
    schema for large text inputs.  Nothing is written when no candidate works.
    """
    errors = []
    for path in candidates:
        if not path_has_data(spark, path):
            errors.append(f"{path}: missing or empty")
            continue
        try:
            reader = spark.read.options(**options).format(fmt)
            if schema is not None:
                reader = reader.schema(schema)
            df = reader.load(path)
            df.schema  # noqa: B018 - resolves the source now
            return path, df
        except Exception as exc:  # a broken candidate: try the next one
            errors.append(f"{path}: {exc}")
    raise FileNotFoundError("no readable source: " + "; ".join(errors))


def ingest_first_source(spark: SparkSession, candidates: Sequence[str], path: str,
                        fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """S4 + S5: skip when ``path`` has data, else ingest the first readable source."""
    if path_has_data(spark, path):
        return spark.read.parquet(path)
    _, df = first_readable(spark, candidates, fmt, schema=schema, **options)
    return ingest(spark, df, path)
