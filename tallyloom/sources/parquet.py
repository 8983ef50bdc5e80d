"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None,
) -> DataFrame:
    """Scan a Parquet table in place; its row groups decide the number of tasks."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def create_if_missing(spark: SparkSession, path: str, schema: StructType | str) -> None:
    """An empty table at ``path`` unless one is there."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
