import datetime as dt

import pytest
from clock import NOW
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.operators import star
from tallyloom.operators.transforms import transform

DAY = dt.date(2024, 6, 1)


def cleaned(sales, products, customers):
    return (transform("sales", sales, NOW), transform("products", products, NOW),
            transform("customers", customers, NOW))


def test_denormalized_fact(sales, products, customers):
    fact = star.denormalized_fact(*[t.drop("transformed_at") for t in cleaned(sales, products, customers)])
    rows = fact.orderBy("sale_id").collect()
    assert len(rows) == 3
    assert (rows[0].category, rows[0].price_tier, rows[0].region, rows[0].customer_segment) == (
        "ELECTRONICS", "Budget", "NORTH", "Personal")
    assert [r.revenue_category for r in rows] == ["Small", "Small", "Medium"]
    assert rows[0].date_key == 20240101


def test_null_keys_match_and_repeated_keys_fan_out(spark):
    sales = spark.createDataFrame([(1, None, 7, 5.0, DAY), (2, 1, 8, 5.0, DAY)],
                                  "sale_id int, product_id int, customer_id int, amount double, sale_date date")
    products = spark.createDataFrame([(None, "N", "Budget"), (1, "A", None), (1, "B", None)],
                                     "product_id int, category string, price_tier string")
    customers = spark.createDataFrame([(7, "R", "Other")], "customer_id int, region string, customer_segment string")
    got = {(r.sale_id, r.category, r.region) for r in star.denormalized_fact(sales, products, customers).collect()}
    assert got == {(1, "N", "R"), (2, "A", None), (2, "B", None)}


def test_fact_without_a_date_fails(spark, products, customers):
    sales = spark.createDataFrame([(1, 101, 201, 5.0, None)],
                                  "sale_id int, product_id int, customer_id int, amount double, sale_date date")
    with pytest.raises(PySparkException, match="without a date"):
        star.denormalized_fact(sales, transform("products", products, NOW),
                               transform("customers", customers, NOW)).collect()


def test_dimensions(spark, sales, products, customers):
    dims = star.dimensions(*cleaned(sales, products, customers), DAY)
    assert list(dims) == ["dim_date", "dim_product", "dim_customer"]
    date = dims["dim_date"].orderBy("date_key").first()
    assert (date.date_key, date.year, date.month, date.day, date.day_of_week, date.is_weekend, date.is_holiday) == (
        20240101, 2024, 1, 1, 0, False, None)
    keys = [(r.product_key, r.product_id, r.effective_date, r.end_date, r.is_current)
            for r in dims["dim_product"].orderBy("product_key").collect()]
    assert keys == [(i, 100 + i, DAY, None, True) for i in (1, 2, 3)]
    assert [r.customer_key for r in dims["dim_customer"].orderBy("customer_id").collect()] == [1, 2, 3]


def test_holidays(spark, sales):
    marked = star.date_dimension(sales, spark.createDataFrame([(dt.date(2024, 1, 1),)] * 2, "full_date date"))
    assert {(r.date_key, r.is_holiday) for r in marked.collect()} == {
        (20240101, True), (20240102, False), (20240103, False)}


def test_versions_over_three_loads(spark):
    kind = "product_id bigint, product_name string, category string, price decimal(10,2)"

    def load(dim, rows, day):
        incoming = spark.createDataFrame(rows, "product_id bigint, product_name string, category string, price string")
        incoming = incoming.withColumn("price", F.col("price").cast("decimal(10,2)"))
        return star.scd2_merge(dim, incoming, "product_key", "product_id", star.PRODUCT_TRACKED, day)

    first = star.product_dimension(
        spark.createDataFrame([], kind).unionByName(
            spark.sql("SELECT 1L product_id, 'a' product_name, 'x' category, CAST(1 AS DECIMAL(10,2)) price "
                      "UNION ALL SELECT 2L, 'b', NULL, NULL")), dt.date(2024, 1, 1))
    second = load(first, [(1, "a", "x", "2"), (2, "b", None, None), (3, "c", "z", "3")], dt.date(2024, 2, 1))
    third = load(second, [(1, "a", "x", "2"), (2, "b", "y", None)], dt.date(2024, 3, 1))
    got = [(r.product_key, r.product_id, r.category, r.price and int(r.price), r.effective_date.month,
            r.end_date and r.end_date.month, r.is_current) for r in third.orderBy("product_key").collect()]
    assert got == [
        (1, 1, "x", 1, 1, 2, False), (2, 2, None, None, 1, 3, False), (3, 1, "x", 2, 2, None, True),
        (4, 3, "z", 3, 2, None, True), (5, 2, "y", None, 3, None, True)]
    for rows in ([(1, "a", "x", "2")] * 2, [(None, "a", "x", "2")]):
        with pytest.raises(ValueError, match="one product_id each"):
            load(second, rows, dt.date(2024, 3, 1))


def test_keyed_fact_current_and_point_in_time(spark, sales, customers):
    products = spark.createDataFrame(
        [(1, 101, dt.date(2023, 1, 1), dt.date(2024, 1, 1), False), (2, 101, dt.date(2024, 1, 1), None, True),
         (3, 102, dt.date(2023, 1, 1), dt.date(2024, 1, 3), False), (4, 102, dt.date(2024, 1, 3), None, True)],
        "product_key bigint, product_id bigint, effective_date date, end_date date, is_current boolean")
    buyers = star.customer_dimension(customers, dt.date(2023, 1, 1))
    dated = sales.withColumn("sale_date", F.to_date("sale_date"))

    def keys(**how):
        fact = star.keyed_fact(dated, products, buyers, NOW, **how)
        assert "product_id" not in fact.columns and "sale_id" not in fact.columns
        return [(r.sales_key, r.product_key, r.customer_key, r.date_key) for r in fact.orderBy("sales_key").collect()]

    assert keys() == [(1, 2, 1, 20240101), (2, 4, 2, 20240102), (3, None, 3, 20240103)]
    assert keys(point_in_time=True, after=5) == [(6, 2, 1, 20240101), (7, 3, 2, 20240102), (8, None, 3, 20240103)]


def test_a_thousand_versions_meet_each_date_once(spark, capsys):
    """Every version is valid for three days, some not at all; dates before the first and after a gap have none."""
    start = dt.date(2020, 1, 1)
    rows = [(k, 101, start + dt.timedelta(3 * k), start + dt.timedelta(3 * k + 3), False) for k in range(1000)]
    rows += [(2000, 101, start + dt.timedelta(6), start + dt.timedelta(6), False), (3000, 102, start, start + dt.timedelta(2), False)]
    dim = spark.createDataFrame(rows, "product_key bigint, product_id bigint, effective_date date, end_date date, is_current boolean")
    buyers = spark.createDataFrame([(7, 201, start, None, True)], "customer_key bigint, customer_id bigint, effective_date date, end_date date, is_current boolean")
    days = [-1, 0, 2, 3, 6, 7, 8, 1500, 2999, 3000] * 40
    sales = [(i, 101, 201, 1, 1.0, start + dt.timedelta(d)) for i, d in enumerate(days)]
    sales += [(1000, 102, 201, 1, 1.0, start + dt.timedelta(1)), (1001, 102, 201, 1, 1.0, start + dt.timedelta(2)), (1002, None, None, 1, 1.0, start)]
    table = spark.createDataFrame(sales, "sale_id bigint, product_id bigint, customer_id bigint, quantity bigint, amount double, sale_date date")
    fact = star.keyed_fact(table, dim, buyers, NOW, point_in_time=True)
    got = [r.product_key for r in fact.orderBy("sales_key").collect()]
    assert got == [None if d < 0 or d >= 3000 else d // 3 for d in days] + [3000, None, None]
    fact.explain()
    plan = capsys.readouterr().out
    assert "effective_date" not in "".join(line for line in plan.splitlines() if "Join" in line)


def test_unchanged_rows_are_told_by_their_stored_digest(spark, capsys):
    products = spark.createDataFrame([(i, f"p{i}", None if i % 3 else "c", i * 1.5) for i in range(50)],
                                     "product_id bigint, product_name string, category string, price double")
    typed = products.withColumn("price", F.col("price").cast("decimal(10,2)"))
    dim = star.product_dimension(typed, DAY)
    stored = dim.withColumn(star.DIGEST, star.row_digest(dim, dim, star.PRODUCT_TRACKED))
    dearer = products.withColumn("price", F.when(F.col("product_id") == 7, 99.0).otherwise(F.col("price")))
    later = DAY + dt.timedelta(1)
    for known in (dim, stored):
        merged = star.scd2_merge(known, dearer, "product_key", "product_id", star.PRODUCT_TRACKED, later)
        assert merged.columns == dim.columns
        rows = merged.filter("product_id = 7").orderBy("product_key").collect()
        assert [(r.product_key, float(r.price), r.end_date, r.is_current) for r in rows] == [
            (8, 10.5, later, False), (51, 99.0, None, True)]
        assert merged.count() == 51 and merged.filter("is_current").count() == 50
