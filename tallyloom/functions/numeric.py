"""Rounding, bands and ratios."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_cents(value: Column) -> Column:
    """Two decimals, half to even on the scaled double: 0.125 gives 0.12, 2.675 gives 2.68."""
    return F.rint(value.cast("double") * 100) / 100


def band(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval holding ``value``; null at or below the first edge."""
    chosen = F.when(value <= F.lit(edges[0]), F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        chosen = chosen.when(value <= F.lit(upper), F.lit(label))
    return chosen


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, null when the whole is zero or missing."""
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def no_nan(value: Column) -> Column:
    """NaN becomes null, so that comparisons with it are never true."""
    return F.nanvl(value, F.lit(None).cast("double"))
