import datetime as dt

import pytest
from clock import NOW
from pyspark.errors import PySparkException

from tallyloom.operators.transforms import TRANSFORMS, transform


def test_sales(sales):
    rows = transform("sales", sales, NOW).orderBy("sale_id").collect()
    assert [r.price_per_unit for r in rows] == [50.0] * 3
    assert [(r.year, r.month, r.quarter, r.day_of_week, r.is_weekend) for r in rows][0] == (2024, 1, 1, 0, False)
    assert rows[0].sale_date == dt.date(2024, 1, 1)
    assert {r.transformed_at for r in rows} == {NOW}


def test_unit_price_comes_before_rounding_and_filling(spark):
    kind = "sale_id bigint, quantity bigint, amount double, sale_date string"
    df = spark.createDataFrame(
        [(1, 0, 5.0, "2024-01-01"), (2, None, 5.0, "2024-01-01"), (3, 2, None, "2024-01-01"),
         (4, 3, 1.004, None), (5, 1, float("nan"), "2024-01-01")], kind)
    got = [(r.quantity, r.amount, r.price_per_unit, r.is_weekend)
           for r in transform("sales", df, NOW).orderBy("sale_id").collect()]
    assert got == [(0, 5.0, None, False), (0, 5.0, None, False), (2, 0.0, None, False),
                   (3, 1.0, 0.33, False), (1, 0.0, None, False)]


def test_malformed_date_fails(spark):
    df = spark.createDataFrame([(1, 1, 1.0, "2024-13-01")], "sale_id int, quantity int, amount double, sale_date string")
    with pytest.raises(PySparkException):
        transform("sales", df, NOW).collect()


def test_products(products, spark):
    rows = transform("products", products, NOW).orderBy("product_id").collect()
    assert [(r.product_name, r.category, r.price_tier) for r in rows][0] == ("Widget A", "ELECTRONICS", "Budget")
    odd = spark.createDataFrame([(1, None, None, None), (2, " x", " ", -1.0)], products.schema)
    got = [(r.product_name, r.category, r.price_tier) for r in transform("products", odd, NOW).orderBy("product_id").collect()]
    assert got == [(None, "UNCATEGORIZED", None), ("X", "", None)]


def test_customers(customers, spark):
    rows = transform("customers", customers, NOW).orderBy("customer_id").collect()
    assert [(r.email_domain, r.customer_segment) for r in rows] == [
        ("gmail.com", "Personal"), ("company.com", "Corporate"), ("yahoo.com", "Personal")]
    odd = spark.createDataFrame([(1, "x", None, None)], customers.schema)
    row = transform("customers", odd, NOW).first()
    assert (row.region, row.email, row.customer_segment) == ("UNKNOWN", None, "Other")


def test_other_sources_pass_unchanged(products):
    assert "returns" not in TRANSFORMS
    assert transform("returns", products, NOW) is products


def test_no_python_in_the_plans(sales, products, customers, capsys):
    for name, table in (("sales", sales), ("products", products), ("customers", customers)):
        transform(name, table, NOW).explain()
    plan = capsys.readouterr().out
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
