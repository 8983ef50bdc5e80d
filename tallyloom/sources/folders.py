"""Names in folders of any file system that Spark reaches."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, hidden files left out; nothing if there is no such folder."""
    system, path = _path(spark, folder)
    if not system.exists(path):
        return []
    found = [status.getPath().getName() for status in system.listStatus(path)]
    return sorted(name for name in found if not name.startswith((".", "_")))


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _path(spark, path)
    return system.exists(at)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; of all that claim one path, one alone is told true."""
    system, at = _path(spark, path)
    try:
        system.create(at, False).close()
    except Py4JJavaError as failure:
        if "FileAlreadyExists" in str(failure.java_exception.getClass().getName()) or system.exists(at):
            return False
        raise
    return True
