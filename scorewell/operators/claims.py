"""Atomic claims of model versions (T4), for any number of writers.

A version of a name belongs to whoever creates its claim file first.  The
creation is exclusive (the store refuses a second one), so two trainers never
hold the same version, and a loser takes the next.  The claim holds the
registry row itself, so a writer that dies afterwards leaves no gap: the
registry is what the claims say.
"""

from __future__ import annotations

import json
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CLAIMS = "version_claims"
ROW = "name string, version int, run_id string, path string"


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist; False when it does."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    try:
        if fs.getScheme() == "file":  # its create() looks first and then writes; a hard link is refused by the system
            own = jvm.org.apache.hadoop.fs.Path(f"{path}.{jvm.java.util.UUID.randomUUID()}.part")
            out = fs.create(own, False)
            out.write(bytearray(text.encode()))
            out.close()
            files, local = jvm.java.nio.file.Files, jvm.java.io.File
            part = local(own.toUri().getPath()).toPath()
            try:
                files.createLink(local(target.toUri().getPath()).toPath(), part)
            finally:
                fs.delete(own, False)
        else:
            out = fs.create(target, False)
            out.write(bytearray(text.encode()))
            out.close()
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
            return False
        raise


def _taken(spark: SparkSession, folder: str) -> int:
    """Highest version claimed in a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return max([int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()], default=0)


def claim_version(spark: SparkSession, root: str, run_id: str, path: str, name: str, after: int = 0) -> dict:
    """The registry row of the next free version of ``name`` above ``after``."""
    folder = f"{root}/{CLAIMS}/{quote(name, safe='')}"
    version = max(after, _taken(spark, folder)) + 1
    while True:
        row = {"name": name, "version": version, "run_id": run_id, "path": path}
        if _create(spark, f"{folder}/{version}.json", json.dumps(row)):
            return row
        version += 1


def claimed_versions(spark: SparkSession, root: str) -> DataFrame:
    """The registry as its claims tell it: name, version, run_id, path."""
    return spark.read.schema(ROW).option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.json").json(f"{root}/{CLAIMS}")
