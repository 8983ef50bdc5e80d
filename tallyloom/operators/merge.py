"""Upsert and append of a staged batch.

Rows replace one another in arrival order, on the primary key or on any unique column. The result
of that sequence has a closed form: a staged row stays if it is the last one for its key and the
last one for each of its unique values, and a stored row stays if no staged row shares its key or a
unique value. Only the first row of each window is asked for, so Spark cuts every key to one row per
task before the shuffle, and ``max`` combines likewise: a key or value that fills a third of the
batch is no burden.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.integrity import ConstraintViolation
from tallyloom.schemas import TableSpec


def survivors(staged: DataFrame, key: str, unique: tuple[str, ...], seq: str) -> DataFrame:
    """The staged rows still there after the whole batch; ``seq`` orders the arrivals, without ties."""
    latest = Window.partitionBy(key).orderBy(F.desc(seq))
    kept = staged.withColumn("_nth", F.row_number().over(latest)).filter("_nth = 1").drop("_nth")
    for column in unique:
        # An arrival number is unique, so joining on it spreads evenly whatever the values are.
        owners = staged.filter(F.col(column).isNotNull()).groupBy(column).agg(F.max(seq).alias(seq))
        owners = owners.select(seq, F.lit(True).alias("_owner"))
        kept = kept.join(owners, seq, "left").filter(F.col(column).isNull() | F.col("_owner")).drop("_owner")
    return kept.select(*staged.columns)


def untouched(target: DataFrame, staged: DataFrame, key: str, unique: tuple[str, ...]) -> DataFrame:
    """Stored rows that no staged row replaces. A small batch is broadcast, the table only scanned."""
    kept = target
    for column in (key, *unique):
        kept = kept.join(staged.select(column).distinct(), column, "left_anti")
    return kept.select(*target.columns)


def with_defaults(rows: DataFrame, spec: TableSpec, now: dt.datetime) -> DataFrame:
    """The table's columns and types, time stamps filled with the load time."""
    filled = rows.withColumns({c: F.lit(now) for c in spec.default_now}) if spec.default_now else rows
    return filled.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields])


def upsert(
    target: DataFrame, staged: DataFrame, spec: TableSpec, seq: str, now: dt.datetime
) -> DataFrame:
    """The whole table after the batch."""
    arrived = survivors(staged, spec.primary_key, spec.unique, seq)
    kept = untouched(target, staged, spec.primary_key, spec.unique)
    return kept.unionByName(with_defaults(arrived, spec, now))


def require_new_keys(target: DataFrame, staged: DataFrame, spec: TableSpec) -> None:
    """An append may repeat no key or unique value, neither stored ones nor its own."""
    for column in spec.keys:
        values = staged.select(column).filter(F.col(column).isNotNull())
        if not values.groupBy(column).count().filter("count > 1").isEmpty():
            raise ConstraintViolation(f"constraint failed: {spec.name}.{column} repeats in the batch")
        if not values.join(target.select(column), column, "left_semi").isEmpty():
            raise ConstraintViolation(f"constraint failed: {spec.name}.{column} is stored already")
