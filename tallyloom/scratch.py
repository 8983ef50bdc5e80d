"""Intermediate tables in the folder shared by all executors.

A result that several later steps read is written once as Parquet and read back. This cuts the
lineage, gives the optimizer true file sizes, and survives the loss of any executor.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """The checkpoint folder the session names; a local session without one gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    return pin_counted(df, label)[0]


def pin_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``pin``, with the number of rows, which the write counts on its way."""
    spark = df.sparkSession
    path, seen = scratch_path(spark, label), Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["rows"]
