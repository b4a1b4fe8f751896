"""Where the engine keeps data that must outlive a task, and small driver helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

_STAGED: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the session names in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder.rstrip("/")


def own_folder(spark: SparkSession) -> None:
    """Give a session on one machine a folder of that machine, where it names none. A cluster must name its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and re.match(r"local(\[|$)", context.master):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tableflow-"))


def fresh_path(spark: SparkSession, label: str, folder: str | None = None) -> str:
    """A path in ``folder`` (the shared one if not given) that no other run uses."""
    path = f"{folder.rstrip('/') if folder else shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialise(df: DataFrame, label: str = "table", folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Use it before paging a source that may change between two reads (a live database
    table): every later pass then sees the same rows, also after an executor is lost.
    """
    path = fresh_path(df.sparkSession, label, folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system that holds ``path``, and the path in its terms."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def remove_staged(spark: SparkSession) -> int:
    """Delete what this application staged and count it; results not yet written can no longer be read."""
    paths = _STAGED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        system, found = file_system(spark, path)
        system.delete(found, True)
    return len(paths)
