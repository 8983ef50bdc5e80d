import datetime as dt
import json

import pytest
from clock import NOW
from pyspark.sql import functions as F

from tallyloom.operators import integrity, quality
from tallyloom.operators.transforms import transform
from tallyloom.schemas import CUSTOMERS, SALES

SALES_DDL = "sale_id bigint, product_id bigint, customer_id bigint, quantity bigint, amount double, sale_date string"


def test_good_sales_pass_once_dates_are_dates(sales):
    assert not quality.validate(sales, "sales", NOW)["data_types"].passed
    results = quality.validate(sales.withColumn("sale_date", F.to_date("sale_date")), "sales", NOW)
    assert list(results) == ["required_columns", "not_null_columns", "numeric_ranges", "unique_columns",
                             "data_types", "custom_checks"]
    assert all(r.passed for r in results.values())
    assert quality.report_text(results).splitlines()[:2] == [
        "Quality Check Summary: 6/6 checks passed", "✓ required_columns: PASSED"]


def test_bad_sales(spark):
    bad = spark.createDataFrame(
        [(1, 101, 201, -1, 100.0, "2024-01-01"), (1, 102, 202, 2, 0.0, "2024-01-02"),
         (None, 103, 203, 3, 300.0, "2030-01-03")], SALES_DDL)
    results = quality.validate(bad, "sales", NOW)
    assert results["not_null_columns"].details == {"null_counts": {"sale_id": 1}}
    assert results["unique_columns"].details == {"duplicate_counts": {"sale_id": 1}}
    assert results["numeric_ranges"].details == {"out_of_range": {"quantity": {"below_min": 1, "above_max": 0}}}
    assert results["data_types"].details == {"issues": ["sale_date should be datetime type"]}
    assert results["custom_checks"].details == {"issues": [
        "1 records have quantity but zero amount", "1 records have future sale dates"]}
    assert results["required_columns"].passed
    text = quality.report_text(results)
    assert text.startswith("Quality Check Summary: 1/6 checks passed")
    assert "✗ not_null_columns: FAILED\n  Details: {'null_counts': {'sale_id': 1}}" in text


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "sale_id bigint")
    results = quality.validate(df, "sales", NOW)
    assert results["unique_columns"].details == {"duplicate_counts": {"sale_id": 2}}
    assert results["required_columns"].details["missing_columns"] == [
        "product_id", "customer_id", "quantity", "amount", "sale_date"]


def test_nan_is_never_out_of_range(spark):
    df = spark.createDataFrame([(float("nan"),), (-1.0,), (5.0,)], "price double")
    assert quality.validate(df, "products", NOW)["numeric_ranges"].details == {
        "out_of_range": {"price": {"below_min": 1, "above_max": 0}}}


def test_null_email_is_invalid(spark):
    df = spark.createDataFrame([("a@b",), ("c",), (None,)], "email string")
    assert quality.validate(df, "customers", NOW)["custom_checks"].details == {
        "issues": ["2 customers have invalid email formats"]}


def test_unknown_table_and_empty_table(spark, products):
    assert quality.validate(products, "returns", NOW) == {}
    empty = transform("products", products.limit(0), NOW)
    assert all(r.passed for r in quality.validate(empty, "products", NOW).values())


def test_log_summary_and_gate(spark, sales):
    results = quality.validate(sales, "sales", NOW)
    logs = quality.log_rows(spark, "sales", results)
    details = {r.check_type: json.loads(r.details) for r in logs.collect()}
    assert details["data_types"] == {"issues": ["sale_date should be datetime type"]}
    assert quality.summary(logs).first()[1:] == (5, 6)
    assert quality.gate(logs, 0.8).first().accepted
    assert not quality.gate(logs, 0.9).first().accepted


def test_one_pass_and_one_aggregate_per_unique_column(sales, capsys):
    quality.counters(sales, "sales", NOW).explain()
    plan = capsys.readouterr().out
    assert plan.count("Scan") == 2


def test_constraints(spark):
    df = spark.createDataFrame(
        [(1, "a", "e"), (1, "b", "e"), (None, None, None), (None, "c", None)],
        "customer_id bigint, customer_name string, email string")
    found = {(r.rule, r.column_name): r.violations for r in integrity.constraint_violations(df, CUSTOMERS).collect()}
    assert found == {("not_null", "customer_id"): 2, ("not_null", "customer_name"): 1,
                     ("unique", "customer_id"): 1, ("unique", "email"): 1}
    with pytest.raises(integrity.ConstraintViolation, match="not_null customers.customer_id: 2 rows"):
        integrity.require(integrity.constraint_violations(df, CUSTOMERS))


def test_orphans(spark, sales, products, customers):
    extra = sales.unionByName(spark.createDataFrame([(9, 999, None, 1, 1.0, "2024-01-01")] * 2, SALES_DDL))
    counts = integrity.orphan_counts(SALES, {"sales": extra, "products": products, "customers": customers})
    assert {(r.column_name, r.orphan_values, r.orphan_rows) for r in counts.collect()} == {
        ("product_id", 1, 2), ("customer_id", 0, 0)}


def test_future_date_boundary(spark):
    df = spark.createDataFrame([(dt.date(2025, 6, 1),), (dt.date(2025, 6, 2),)], "sale_date date")
    assert quality.validate(df, "sales", NOW)["custom_checks"].details == {
        "issues": ["1 records have future sale dates"]}


def test_a_lone_whole_number_is_counted_as_it_is(spark):
    from tallyloom.operators import quality

    rows = spark.createDataFrame([(1,), (1,), (None,), (None,), (None,), (2,)], "sale_id bigint")
    counts = quality.duplicates(rows, "sales")
    assert [tuple(r) for r in counts.collect()] == [("unique_columns", "sale_id", "duplicates", 3)]
    assert "cast(sale_id" not in counts._jdf.queryExecution().optimizedPlan().toString()
    assert quality.duplicates(rows.limit(0), "sales").first()["n"] == 0
