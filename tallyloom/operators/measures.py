"""Sales measures that can be summed up in any number of steps.

``fold`` gives the same totals whether it is applied to single sales, to sales already folded per
customer, or to any mix of both, so a report may shrink the data before each shuffle. Money is
counted in whole cents: exact like a decimal sum, but one machine word wide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.calendar import is_weekend, month_start

_COMBINE = {
    "lines": F.sum,
    "transactions": F.sum,
    "units": F.sum,
    "revenue": F.sum,
    "priced": F.sum,
    "lowest": F.min,
    "highest": F.max,
    "weekend": F.sum,
    "weekday": F.sum,
    "first_date": F.min,
    "last_date": F.max,
}


def sale_measures(sales: DataFrame, *keys: str, sale_id_unique: bool) -> DataFrame:
    """One row per sale: ``month``, the key columns and the measures.

    With ``sale_id_unique`` (a loaded sales table, whose key the loader enforces) distinct sales
    are counted by summing ones. Without it ``sale_id`` stays a key column to be counted distinct.
    """
    date = F.col("sale_date")
    cents = F.rint(F.col("amount").cast("double") * 100).cast("bigint")
    keep_id = [] if sale_id_unique else ["sale_id"]
    return sales.select(
        month_start(date).alias("month"),
        *keys,
        *keep_id,
        F.lit(1).cast("bigint").alias("lines"),
        F.col("sale_id").isNotNull().cast("bigint").alias("transactions"),
        F.col("quantity").alias("units"),
        cents.alias("revenue"),
        cents.isNotNull().cast("bigint").alias("priced"),
        cents.alias("lowest"),
        cents.alias("highest"),
        F.when(is_weekend(date), cents).otherwise(F.lit(0)).alias("weekend"),
        F.when(date.isNotNull() & ~is_weekend(date), cents).otherwise(F.lit(0)).alias("weekday"),
        date.alias("first_date"),
        date.alias("last_date"),
    )


def combined(*names: str) -> list[Column]:
    return [_COMBINE[name](name).alias(name) for name in names]


def fold(facts: DataFrame) -> DataFrame:
    """One row per combination of the key columns, measures combined."""
    keys = [c for c in facts.columns if c not in _COMBINE]
    return facts.groupBy(*keys).agg(*combined(*[c for c in facts.columns if c in _COMBINE]))


def totals(facts: DataFrame, group: list[str], sale_id_unique: bool, transactions: str, customers: str, *measures: Column) -> DataFrame:
    """Distinct sales and customers and other measures of every group.

    Where sales have to be counted distinct too, they are folded to one row each per group first, the sums with
    them, and then counted; customers are counted on a way of their own. So no row is multiplied, as it would be
    by two distinct counts of one aggregate, and a hot group is spread by its sales. Groups may be null.
    """
    if sale_id_unique:
        return facts.groupBy(*group).agg(
            F.sum("transactions").alias(transactions), F.count_distinct("customer_id").alias(customers), *measures
        )
    sales = fold(facts.select(*group, "sale_id", *[c for c in facts.columns if c in _COMBINE])).groupBy(*group).agg(F.count("sale_id").alias(transactions), *measures)
    buyers = facts.select(*[F.col(g).alias(f"_{g}") for g in group], "customer_id").distinct()
    buyers = buyers.groupBy(*[f"_{g}" for g in group]).agg(F.count("customer_id").alias(customers))
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]
    return sales.join(buyers, same).drop(*[f"_{g}" for g in group])


def transaction_count(sale_id_unique: bool) -> Column:
    return F.sum("transactions") if sale_id_unique else F.count_distinct("sale_id")


def money(cents: str) -> Column:
    """Whole cents as an amount."""
    return F.col(cents).cast("double") / 100


def mean_amount() -> Column:
    """Average of the known amounts, from their exact sum."""
    return F.try_divide(F.sum("revenue").cast("double") / 100, F.sum("priced").cast("double"))
