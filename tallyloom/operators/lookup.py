"""Joining sales to a dimension without shuffling more than needed."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension side, in measured bytes, that is sent to every executor.
BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 64


def measured_bytes(*sides: DataFrame) -> list[int]:
    """Sizes of dimension sides from their row counts and text lengths, by one small job for all."""
    def measure(at: int, side: DataFrame) -> DataFrame:
        text = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in side.dtypes if kind == "string"]
        width = sum(text, F.lit(_ROW_OVERHEAD + 16 * len(side.columns)))
        return side.agg(F.lit(at).alias("side"), F.sum(width.cast("bigint")).alias("bytes"))

    found = reduce(DataFrame.union, [measure(at, side) for at, side in enumerate(sides)]).collect()
    return [row["bytes"] or 0 for row in sorted(found, key=lambda row: row["side"])]


def sent_if_small(*sides: DataFrame) -> list[DataFrame]:
    """The sides, those measured to be within the bound marked to be sent to every executor."""
    return [
        F.broadcast(side) if size <= BROADCAST_BYTES else side for side, size in zip(sides, measured_bytes(*sides))
    ]


def fits_broadcast(side: DataFrame) -> bool:
    return measured_bytes(side)[0] <= BROADCAST_BYTES


def attach(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    labels: list[str],
    shrink: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Inner join of ``facts`` to the ``labels`` of a dimension.

    Without ``shrink`` the join is left to the optimizer, which broadcasts a side it estimates to
    be below ``spark.sql.autoBroadcastJoinThreshold`` and else shuffles both, AQE splitting the
    partitions of hot keys. With ``shrink`` the facts can be folded per key, which leaves a hot key
    few rows but costs a shuffle: the side is measured, and folding done only beyond the bound.
    """
    side = dimension.select(key, *labels)
    if shrink is None:
        return facts.join(side, key)
    if fits_broadcast(side):
        return facts.join(F.broadcast(side), key)
    return shrink(facts).join(side, key)
