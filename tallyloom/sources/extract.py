"""Configured sources as a dictionary of DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.delimited import SEQ, read_text_cells

SOURCE_TYPES = ("csv", "database")


def check_sources(sources: list[Mapping]) -> None:
    """Name an unsupported source before any job starts."""
    for source in sources:
        if source["type"] not in SOURCE_TYPES:
            raise ValueError(f"no such kind of source: {source['type']}")


def read_source(spark: SparkSession, source: Mapping) -> DataFrame:
    """A CSV file or folder, or the result of a query over the catalog and the stored tables."""
    if source["type"] == "csv":
        return read_text_cells(
            spark, source["path"], source.get("delimiter", ","), source.get("header", True),
            source.get("multiline", False),
        )
    result = spark.sql(source["query"])
    if SEQ in result.columns:
        return result
    return result.withColumn(SEQ, F.struct(
        F.lit("").alias("file"), F.lit(0).cast("bigint").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ))


def extract(spark: SparkSession, sources: list[Mapping]) -> dict[str, DataFrame]:
    check_sources(sources)
    return {source["name"]: read_source(spark, source) for source in sources}
