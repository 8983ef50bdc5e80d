import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import lookup
from tallyloom.plans import live, reports

D = dt.date


@pytest.fixture(scope="module")
def tables(spark):
    """Unique sale ids; a third of the sales are one product's, a third one customer's; some nulls."""
    rng = random.Random(11)
    sales = [
        (i, 1 if i % 3 == 0 else rng.randint(1, 30), 5 if i % 3 == 1 else rng.randint(1, 40),
         rng.choice([None, 1, 2]), rng.choice([None, rng.randint(0, 99999)]),
         rng.choice([None, D(2024, rng.randint(1, 3), rng.randint(1, 28))]))
        for i in range(1500)
    ]
    sales = spark.createDataFrame(
        sales, "sale_id bigint, product_id bigint, customer_id bigint, quantity bigint, cents bigint, sale_date date"
    ).withColumn("amount", (F.col("cents") / 100).cast("decimal(10,2)")).drop("cents")
    products = spark.createDataFrame(
        [(i, f"p{i}", [None, "A", "B", "C"][i % 4]) for i in range(1, 41)],
        "product_id bigint, product_name string, category string",
    ).withColumn("price", F.lit(1).cast("decimal(10,2)"))
    customers = spark.createDataFrame(
        [(i, f"c{i}", f"e{i}@x", [None, "N", "S"][i % 3]) for i in range(1, 38)],
        "customer_id bigint, customer_name string, email string, region string")
    return sales.cache(), products.cache(), customers.cache()


def build(tables, unique):
    sales, products, customers = tables
    return {
        "sales_summary": reports.sales_summary(sales, products, customers, sale_id_unique=unique),
        "product_performance": reports.product_performance(sales, products, sale_id_unique=unique),
        "sales_metrics": reports.sales_metrics(sales, products, sale_id_unique=unique),
        "dynamic_report": reports.dynamic_report(sales, products, customers, sale_id_unique=unique),
        "monthly_category_top10": reports.monthly_category_top10(sales, products),
    }


@pytest.mark.parametrize("bound", [0, 64 << 20])
def test_every_plan_gives_the_same_reports(tables, monkeypatch, bound):
    """Unique ids counted by sum or distinct; dimensions broadcast, or folded facts shuffled."""
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", bound)
    counted = build(tables, unique=False)
    for name, report in build(tables, unique=True).items():
        assert sorted(map(str, report.collect())) == sorted(map(str, counted[name].collect())), name


def test_sizes_are_measured(tables):
    _, products, _ = tables
    assert 40 * 64 < lookup.measured_bytes(products.select("product_id", "category"))[0] < 40 * 200
    assert lookup.measured_bytes(products.limit(0)) == [0]


def test_unsold_products_rank_last(tables):
    report = reports.product_performance(*tables[:2]).filter("total_revenue IS NULL").collect()
    assert report and {
        (r.total_sales, r.unique_customers, r.performance_category, r.category_revenue_share) for r in report
    } == {(0, 0, "Average", None)}
    everything = reports.product_performance(*tables[:2]).collect()
    sold = sum(r.total_revenue is not None for r in everything)
    assert {r.overall_rank for r in report} == {sold + 1}
    assert all(r.category for r in everything)


def test_quality_report_of_empty_tables_counts_zero(tables):
    empty = [t.limit(0) for t in tables]
    rows = reports.data_quality_report(*empty).collect()
    assert [(r.table_name, r.total_records, r.total_issues) for r in rows] == [
        ("Sales Table", 0, 0), ("Product Table", 0, 0), ("Customer Table", 0, 0)]
    assert rows[1].issue_details == "Null IDs: 0, Null Names: 0, Invalid Prices: 0, Duplicate IDs: 0"


def test_quality_report_leaves_null_emails_alone(spark, tables):
    customers = spark.createDataFrame([(1, "a", "a@b", "r"), (2, "b", "c", "r"), (2, None, None, "r")], tables[2].schema)
    row = reports.data_quality_report(tables[0], tables[1], customers).collect()[2]
    assert row.issue_details == "Null IDs: 0, Null Names: 1, Invalid Emails: 1, Duplicate IDs: 1"
    assert row.total_issues == 3


@pytest.mark.parametrize("name", live.REPORTS)
def test_live_views_give_the_rows_of_the_reports(spark, tables, name):
    for table, label in zip(tables, ("s", "p", "c")):
        table.createOrReplaceTempView(label)
    built = {
        "sales_summary": lambda: reports.sales_summary(*tables, sale_id_unique=True),
        "product_performance": lambda: reports.product_performance(*tables[:2], sale_id_unique=True),
        "sales_metrics": lambda: reports.sales_metrics(*tables[:2], sale_id_unique=True),
        "dynamic_report": lambda: reports.dynamic_report(*tables, sale_id_unique=True),
        "data_quality_report": lambda: reports.data_quality_report(*tables),
        "monthly_category_top10": lambda: reports.monthly_category_top10(*tables[:2]),
    }[name]()
    lazy = spark.sql(live.REPORTS[name]("s", "p", "c"))
    assert lazy.dtypes == built.dtypes
    # In order, but for the quality report, whose rows have none.
    assert lazy.collect() == built.collect()


def test_top10_stops_at_ten(tables):
    rows = reports.monthly_category_top10(*tables[:2]).collect()
    assert len(rows) == 10 and rows[0].month == "2024-03"


def test_a_small_dimension_costs_no_shuffle_of_the_facts(tables, capsys):
    reports.monthly_category_top10(*tables[:2]).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and plan.count("hashpartitioning") == 1
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("build", [
    lambda t, unique: reports.sales_summary(*t, sale_id_unique=unique),
    lambda t, unique: reports.product_performance(*t[:2], sale_id_unique=unique),
    lambda t, unique: reports.sales_metrics(*t[:2], sale_id_unique=unique),
])
def test_repeated_sales_count_once_without_expand(tables, build, capsys):
    """Rows of one sale in several products and groups; money and units add up as before."""
    sales, products, customers = tables
    again = sales.withColumn("product_id", F.col("product_id") % 30 + 1)
    twice = sales.unionByName(again).unionByName(sales)
    built = build((twice, products, customers), False)
    built.explain()
    assert "Expand" not in capsys.readouterr().out
    counts = [c for c in built.columns if c in ("total_transactions", "total_sales", "total_orders")]
    keys = [c for c in ("month_year", "category", "region", "product_id") if c in built.columns]
    lines = twice.join(products, "product_id").join(customers, "customer_id") if "region" in keys else twice.join(products, "product_id")
    lines = lines.withColumn("month_year", F.date_format("sale_date", "yyyy-MM")).filter("category IS NOT NULL" if "region" not in keys else "true")
    wanted = {tuple(r)[:-3]: tuple(r)[-3:] for r in lines.groupBy(*keys).agg(
        F.count_distinct("sale_id"), F.count_distinct("customer_id"), F.sum("quantity")).collect()}
    units = [c for c in built.columns if c in ("total_units_sold", "total_quantity")]
    got = {tuple(r[k] for k in keys): (r[counts[0]], r.unique_customers, r[units[0]]) for r in built.collect() if r[counts[0]]}
    assert got == wanted


def test_row_order(tables):
    def falls(values):
        known = [v for v in values if v is not None]
        return known == sorted(known, reverse=True) and values[: len(known)] == known  # null last

    summary = reports.sales_summary(*tables, sale_id_unique=True).collect()
    assert falls([r.month_year for r in summary])
    for _, month in itertools.groupby(summary, key=lambda r: r.month_year):
        assert falls([r.total_revenue for r in month])
    assert falls([r.total_revenue for r in reports.product_performance(*tables[:2], sale_id_unique=True).collect()])
    long = [(r.report_type, r.dimension or "", r.time_period or "", r.metric_name) for r in reports.dynamic_report(*tables, sale_id_unique=True).collect()]
    assert long == sorted(long)


def test_top10_does_not_fold_before_a_shuffled_join(spark, sales, products, monkeypatch):
    from pyspark.sql import functions as F
    from tallyloom.operators import lookup
    from tallyloom.plans import reports

    monkeypatch.setattr(lookup, "BROADCAST_BYTES", 0)
    dated = sales.withColumn("sale_date", F.to_date("sale_date"))
    top = reports.monthly_category_top10(dated, products)
    assert top._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
    got = [(r.month, r.category, r.transactions, r.total_revenue) for r in top.collect()]
    assert got == [("2024-01", "Electronics", 2, 250.0), ("2024-01", "Home", 1, 50.0)]
