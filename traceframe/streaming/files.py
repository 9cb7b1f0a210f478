"""Small control files beside tables, through the file system that Spark itself uses."""

from __future__ import annotations

import json

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _path(spark, path)
    return files.exists(at)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table has been written there to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if there is no folder."""
    files, at = _path(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def put_new(spark: SparkSession, path: str, value) -> bool:
    """Write ``value`` as JSON unless the file is there; whether it was written.

    The file appears under its name only when it is whole, so nobody reads half of it.
    """
    files, at = _path(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{spark._jvm.java.util.UUID.randomUUID().toString()}")
    out = files.create(part, True)
    try:
        out.write(bytearray(json.dumps(value).encode()))
    finally:
        out.close()
    # Renaming does not replace a file that is there, other than on some local file systems.
    done = not files.exists(at) and files.rename(part, at)
    if not done:
        files.delete(part, False)
    return done


def get(spark: SparkSession, path: str):
    """The value of a control file; None if there is none."""
    if not exists(spark, path):
        return None
    try:
        return json.loads("\n".join(r.value for r in spark.read.text(path).collect()))
    except PySparkException:  # gone meanwhile
        return None


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    files, at = _path(spark, path)
    if files.exists(at):
        files.delete(at, True)
