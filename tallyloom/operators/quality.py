"""Data-quality rules, compiled into one aggregate per table.

Nulls, ranges and custom rules are counted in a single pass without a shuffle, which may be the one that
writes the table; the unique columns add one aggregate by their values. Only the counts reach the driver, where the
verdicts are made.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.numeric import no_nan

# The rules of each table, the texts of the checks and of the report.
RULES: dict[str, dict] = {
    "sales": {
        "required": ["sale_id", "product_id", "customer_id", "quantity", "amount", "sale_date"],
        "not_null": ["sale_id", "product_id", "customer_id", "sale_date"],
        "ranges": {"quantity": (0, 1000), "amount": (0, 1000000)},
        "unique": ["sale_id"],
    },
    "products": {
        "required": ["product_id", "product_name", "category", "price"],
        "not_null": ["product_id", "product_name"],
        "ranges": {"price": (0, 10000)},
        "unique": ["product_id"],
    },
    "customers": {
        "required": ["customer_id", "customer_name", "email", "region"],
        "not_null": ["customer_id", "customer_name"],
        "ranges": {},
        "unique": ["customer_id", "email"],
    },
}
ZERO_AMOUNT = "{} records have quantity but zero amount"
FUTURE_DATE = "{} records have future sale dates"
BAD_PRICE = "{} products have zero or negative prices"
BAD_EMAIL = "{} customers have invalid email formats"
NOT_A_DATE = "{} should be datetime type"
NOT_A_NUMBER = "{} should be numeric type"
REPORT_HEADLINE = "Quality Check Summary: {}/{} checks passed"
REPORT_PASSED = "✓ {}: PASSED"
REPORT_FAILED = "✗ {}: FAILED"
REPORT_DETAILS = "  Details: {}"

COUNTERS = "check_type string, column_name string, metric string, n bigint"


@dataclass
class CheckResult:
    passed: bool
    details: dict = field(default_factory=dict)


def _number(df: DataFrame, name: str) -> Column:
    """NaN is neither below nor above anything."""
    kind = df.schema[name].dataType
    return no_nan(F.col(name).cast("double")) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(name)


def _custom(df: DataFrame, table: str, as_of: dt.datetime) -> list[tuple[str, str, Column]]:
    """(column, text, condition) of the table's own rules, for the columns it has."""
    rules = {
        "sales": [
            (["quantity", "amount"], ZERO_AMOUNT, (F.col("quantity") > 0) & (F.col("amount") == 0)),
            (["sale_date"], FUTURE_DATE, F.col("sale_date").cast("timestamp") > F.lit(as_of)),
        ],
        "products": [(["price"], BAD_PRICE, F.col("price") <= 0)],
        "customers": [
            (["email"], BAD_EMAIL, ~F.coalesce(F.col("email").contains("@"), F.lit(False)))
        ],
    }
    present = set(df.columns)
    return [(c[-1], text, rule) for c, text, rule in rules.get(table, []) if present.issuperset(c)]


def counted(df: DataFrame, table: str, as_of: dt.datetime) -> dict[tuple[str, str, str], Column]:
    """Aggregates that one pass over ``table`` can make: nulls, ranges and custom rules, by check, column, metric.

    They may be observed while the table is written, see ``observation``.
    """
    rules, present = RULES.get(table, {"not_null": [], "ranges": {}}), set(df.columns)
    found = {("not_null_columns", c, "nulls"): F.col(c).isNull() for c in rules["not_null"] if c in present}
    for name, (low, high) in rules["ranges"].items():
        if name in present:
            found["numeric_ranges", name, "below_min"] = _number(df, name) < low
            found["numeric_ranges", name, "above_max"] = _number(df, name) > high
    found |= {("custom_checks", name, text): rule for name, text, rule in _custom(df, table, as_of)}
    return {key: F.count_if(rule) for key, rule in found.items()}


def observation(counts: Mapping[tuple[str, str, str], Column]) -> list[Column]:
    """The same aggregates under names an ``Observation`` can have; ``observed`` reads them back."""
    return [count.alias(f"check_{at}") for at, count in enumerate(counts.values())]


def observed(counts: Mapping[tuple[str, str, str], Column], seen: Mapping[str, int]) -> dict[tuple[str, str, str], int]:
    return {key: seen[f"check_{at}"] for at, key in enumerate(counts)}


def duplicates(df: DataFrame, table: str) -> DataFrame:
    """(check_type, column_name, metric, n): rows beyond the first of each value of the unique columns, null a value.

    All columns in one pass, summed up before the shuffle; a whole number that is alone stays one.
    """
    unique = [c for c in RULES.get(table, {"unique": []})["unique"] if c in df.columns]
    if not unique:
        return df.sparkSession.createDataFrame([], COUNTERS)
    if len(unique) == 1 and isinstance(df.schema[unique[0]].dataType, T.IntegralType):
        values = df.groupBy(unique[0]).count().withColumn("column_name", F.lit(unique[0]))
    else:
        cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in unique]
        values = df.select(F.explode(F.array(*cells)).alias("v")).select("v.*").groupBy("column_name", "value").count()

    def extra(name: str) -> Column:
        return F.sum(F.when(F.col("column_name") == name, F.col("count") - 1))

    found = [
        F.struct(F.lit("unique_columns").alias("check_type"), F.lit(c).alias("column_name"),
                 F.lit("duplicates").alias("metric"), F.coalesce(extra(c), F.lit(0).cast("bigint")).alias("n"))
        for c in unique
    ]
    return values.agg(F.array(*found).alias("cells")).select(F.inline("cells"))


def counters(df: DataFrame, table: str, as_of: dt.datetime) -> DataFrame:
    """Every count the checks of ``table`` need: (check_type, column_name, metric, n)."""
    counts = counted(df, table, as_of)
    names = ("check_type", "column_name", "metric")
    cells = [
        F.struct(*[F.lit(part).alias(name) for name, part in zip(names, key)], count.alias("n"))
        for key, count in counts.items()
    ]
    if not cells:
        return duplicates(df, table)
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells")).unionByName(duplicates(df, table))


def type_issues(df: DataFrame, table: str) -> list[str]:
    """Columns of the sales table whose type is not what the rules expect."""
    if table != "sales":
        return []
    kinds = {f.name: f.dataType for f in df.schema.fields}
    dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
    issues = []
    if "sale_date" in kinds and not isinstance(kinds["sale_date"], dates):
        issues.append(NOT_A_DATE.format("sale_date"))
    for name in ("quantity", "amount", "price_per_unit"):
        if name in kinds and not isinstance(kinds[name], T.NumericType):
            issues.append(NOT_A_NUMBER.format(name))
    return issues


def validate(
    df: DataFrame, table: str, as_of: dt.datetime, seen: Mapping[tuple[str, str, str], int] | None = None
) -> dict[str, CheckResult]:
    """The six checks of a known table, in order; nothing for an unknown one.

    With the counts that were ``seen`` as the table was written only its unique columns are read again.
    """
    if table not in RULES:
        return {}
    counts = [(*key, n) for key, n in seen.items()] if seen is not None else []
    counts += (counters(df, table, as_of) if seen is None else duplicates(df, table)).collect()
    found: dict[str, dict] = {"not_null_columns": {}, "numeric_ranges": {}, "unique_columns": {}, "custom_checks": {}}
    for check, column, metric, n in counts:
        found[check].setdefault(column, {})[metric] = n
    ranges = {c: m for c, m in found["numeric_ranges"].items() if any(m.values())}
    missing = [c for c in RULES[table]["required"] if c not in df.columns]
    nulls = {c: m["nulls"] for c, m in found["not_null_columns"].items() if m["nulls"]}
    extra = {c: m["duplicates"] for c, m in found["unique_columns"].items() if m["duplicates"]}
    types = type_issues(df, table)
    issues = [text.format(n) for m in found["custom_checks"].values() for text, n in m.items() if n]
    return {
        "required_columns": CheckResult(not missing, {"missing_columns": missing}),
        "not_null_columns": CheckResult(not nulls, {"null_counts": nulls}),
        "numeric_ranges": CheckResult(not ranges, {"out_of_range": ranges}),
        "unique_columns": CheckResult(not extra, {"duplicate_counts": extra}),
        "data_types": CheckResult(not types, {"issues": types}),
        "custom_checks": CheckResult(not issues, {"issues": issues}),
    }


LOG_ROWS = "table_name string, check_type string, check_result boolean, details string"


def log_rows(spark: SparkSession, table: str, results: dict[str, CheckResult]) -> DataFrame:
    """One row per check, details as JSON."""
    rows = [(table, check, r.passed, json.dumps(r.details)) for check, r in results.items()]
    return spark.createDataFrame(rows, LOG_ROWS)


def report_text(results: dict[str, CheckResult]) -> str:
    """A headline and one line per check, with details where it failed."""
    lines = [REPORT_HEADLINE.format(sum(r.passed for r in results.values()), len(results))]
    for check, result in results.items():
        lines.append((REPORT_PASSED if result.passed else REPORT_FAILED).format(check))
        if not result.passed:
            lines.append(REPORT_DETAILS.format(result.details))
    return "\n".join(lines)


def summary(logs: DataFrame) -> DataFrame:
    """Passed and total checks per table."""
    return logs.groupBy("table_name").agg(
        F.count_if("check_result").alias("passed_checks"), F.count("*").alias("total_checks")
    )


def gate(logs: DataFrame, threshold: float) -> DataFrame:
    """One row: passed and total checks, their ratio, and whether it reaches the threshold."""
    counts = logs.agg(F.count_if("check_result").alias("passed_checks"), F.count("*").alias("total_checks"))
    ratio = F.try_divide(F.col("passed_checks").cast("double"), F.col("total_checks").cast("double"))
    return counts.withColumn("pass_ratio", ratio).withColumn(
        "accepted", F.coalesce(F.col("pass_ratio") >= F.lit(threshold), F.lit(True))
    )
