"""Calendar columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(date: Column) -> Column:
    """First day of the month: a four-byte grouping key, formatted after the aggregation."""
    return F.trunc(date, "month")


def month_label(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def is_weekend(date: Column) -> Column:
    """Saturday or Sunday; false for a missing date."""
    return F.coalesce(F.weekday(date).isin(5, 6), F.lit(False))


def date_key(date: Column) -> Column:
    """The date as the integer yyyymmdd."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)
