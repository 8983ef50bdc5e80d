"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# A cluster takes these as they are; AQE merges the many initial partitions of a small shuffle and
# splits the skewed ones of a large one, so one setting serves both ends.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.ui.enabled": "false",
    # Plans are built with two fifths of the calls when Python call sites are not recorded.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(app: str, cpus: int | str = "*", **extra: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**SETTINGS, "spark.sql.shuffle.partitions": "8", **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
