"""Intermediate tables of one operator call, and the dealing out of rows without hot tasks."""

from __future__ import annotations

import gc
from collections.abc import Iterable
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.scratch import scratch_path


# Rows of an Arrow batch. Texts may be long: Spark's default of 10,000 rows would bound no memory.
BATCH_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Sets the rows of Arrow batches, unless the session has set a number of its own."""
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, led by as many underscores as it takes to be none of ``columns`` in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Workspace:
    """Writes intermediate tables to the shared folder and removes those no longer needed.

    A written table cuts the lineage, so a lost executor costs the running step only.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        small_batches(spark)
        self._paths: dict[int, str] = {}

    def pin(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        self.release()
        table = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(table)] = path
        return table

    def release(self) -> None:
        """Let Spark delete the shuffle files of finished writes.

        It does so when the driver collects the garbage that names them, and a driver with little to do does not for
        long: the files of all steps would pile up on the executors' disks.
        """
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *tables: DataFrame) -> None:
        """Delete pinned tables that no result of the operator reads any more."""
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self._paths.pop(id(table)))
            path.getFileSystem(conf).delete(path, True)


def slices_of(rows: int) -> int:
    """Slices to cut ``rows`` into, so that neither a slice nor the list of slices is long."""
    return max(1, -(-rows // max(1000, isqrt(rows))))


def slice_of(hex_digest: Column, rows: int) -> Column:
    """Slice number of an evenly spread hex string, rising with it."""
    top = F.conv(F.substring(hex_digest, 1, 7), 16, 10).cast("long")
    return F.floor(top * slices_of(rows) / F.lit(1 << 28)).cast("long")


def running_total(
    df: DataFrame, group: list[str], part: str, order: list[Column], value: Column, name: str
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all earlier rows of the group.

    ``part`` cuts a group into slices that follow the order and are small enough for one task, so
    no group, however hot, is sorted by one task; only one sum per slice is added up along it.
    Groups may be null and match themselves.
    """
    before = (Window.unboundedPreceding, -1)
    keys = [F.col(g) for g in group]
    inside = Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(*before)
    rows = df.withColumn("_value", value).withColumn(
        "_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0))
    )
    along = Window.partitionBy(*keys).orderBy(part).rowsBetween(*before)
    sums = df.groupBy(*keys, part).agg(F.sum(value).alias("_size")).select(
        *[F.col(g).alias(f"_{g}") for g in group], F.col(part).alias("_part"),
        F.coalesce(F.sum("_size").over(along), F.lit(0)).alias("_before"),
    )
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group] + [F.col(part) == F.col("_part")]
    helpers = [f"_{g}" for g in group] + ["_part", "_before", "_inside", "_value"]
    return rows.join(sums, same).withColumn(name, F.col("_before") + F.col("_inside")).drop(*helpers)
