"""Keys, required values and references of the stored tables, checked by jobs before publishing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.schemas import Reference, TableSpec


class ConstraintViolation(ValueError):
    """Rows that the table's keys or required columns do not allow."""


def _repeated(df: DataFrame, column: str) -> DataFrame:
    """Rows beyond the first per non-null value, counted after a map-side sum per value."""
    per_value = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    return per_value.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations"))


def constraint_violations(
    df: DataFrame, spec: TableSpec, with_keys: bool = True
) -> DataFrame:
    """(table_name, rule, column_name, violations) for every constraint of the table.

    ``with_keys=False`` leaves out the uniqueness checks, the only ones that shuffle.
    """
    def labelled(counts: DataFrame, rule: str, column: str) -> DataFrame:
        return counts.select(
            F.lit(spec.name).alias("table_name"), F.lit(rule).alias("rule"),
            F.lit(column).alias("column_name"), F.col("violations"),
        )

    required = [c for c in (spec.primary_key, *spec.not_null) if c is not None]
    if not required:
        return df.sparkSession.createDataFrame(
            [], "table_name string, rule string, column_name string, violations bigint"
        )
    nulls = df.agg(F.array(*[
        F.struct(F.lit(spec.name).alias("table_name"), F.lit("not_null").alias("rule"),
                 F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("violations"))
        for c in required
    ]).alias("cells")).select(F.inline("cells"))
    parts = [nulls]
    if with_keys:
        parts += [labelled(_repeated(df, c), "unique", c) for c in spec.keys]
    return reduce(DataFrame.unionByName, parts)


def require(violations: DataFrame) -> None:
    """Raise when any counted violation is not zero."""
    broken = violations.filter("violations > 0").collect()
    if broken:
        text = ", ".join(f"{r['rule']} {r['table_name']}.{r['column_name']}: {r['violations']} rows" for r in broken)
        raise ConstraintViolation(f"constraint failed: {text}")


def orphans(child: DataFrame, references: Sequence[Reference], parents: Mapping[str, DataFrame]) -> DataFrame:
    """(column_name, value, child_rows) of references that no parent row answers; null refers to nothing.

    One pass over the child for all its references, and one anti join: values of all columns are stacked, as text,
    and summed up before the shuffle, so a hot value is one row in the join.
    """
    def stacked(column: str, value: str) -> Column:
        return F.struct(F.lit(column).alias("column_name"), F.col(value).cast("string").alias("value"))

    referred = child.select(F.explode(F.array(*[stacked(r.column, r.column) for r in references])).alias("r")).select("r.*")
    referred = referred.filter("value IS NOT NULL").groupBy("column_name", "value").agg(F.count("*").alias("child_rows"))
    answers = [
        parents[r.table].select(stacked(r.column, r.key).alias("r")).select("r.*") for r in references
    ]
    return referred.join(reduce(DataFrame.union, answers), ["column_name", "value"], "left_anti")


def orphan_counts(spec: TableSpec, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, parent_table, orphan_values, orphan_rows) per reference."""
    lost = orphans(tables[spec.name], spec.references, tables).groupBy("column_name").agg(
        F.count("*").alias("orphan_values"), F.sum("child_rows").alias("orphan_rows")
    )
    told = lost.sparkSession.createDataFrame(
        [(spec.name, r.column, r.table) for r in spec.references],
        "table_name string, column_name string, parent_table string",
    )
    zero = F.lit(0).cast("bigint")
    return told.join(lost, "column_name", "left").select(
        "table_name", "column_name", "parent_table", F.coalesce("orphan_values", zero).alias("orphan_values"),
        F.coalesce("orphan_rows", zero).alias("orphan_rows"),
    )
