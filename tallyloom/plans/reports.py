"""The report tables (gold layer).

Every report takes the cleaned ``sales``, ``products`` and ``customers`` tables. Pass
``sale_id_unique=True`` for a sales table whose primary key the loader has enforced: distinct
sales then need no shuffle of the sale ids. The default counts them distinct, which is right for
any input.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.calendar import month_label
from tallyloom.functions.numeric import percent_of
from tallyloom.operators.lookup import attach
from tallyloom.operators.measures import fold, mean_amount, money, sale_measures, totals, transaction_count
from tallyloom.operators.ordering import add_ranks
from tallyloom.scratch import pin


def _money(name: str) -> Column:
    return money(name).alias(name)


def _shrink(sale_id_unique: bool):
    """Folding pays only when the sale id is not among the keys."""
    return fold if sale_id_unique else None


def sales_summary(
    sales: DataFrame, products: DataFrame, customers: DataFrame, *, sale_id_unique: bool = False
) -> DataFrame:
    """Transactions, customers, units and revenue per month, category and region."""
    shrink = _shrink(sale_id_unique)
    facts = sale_measures(sales, "product_id", "customer_id", sale_id_unique=sale_id_unique)
    facts = attach(facts, products, "product_id", ["category"], shrink).drop("product_id")
    facts = attach(facts, customers, "customer_id", ["region"], shrink)
    summed = totals(
        facts, ["month", "category", "region"], sale_id_unique, "total_transactions", "unique_customers",
        F.sum("units").alias("total_units_sold"),
        F.sum("revenue").alias("total_revenue"),
        mean_amount().alias("avg_transaction_value"),
        F.min("lowest").alias("min_transaction_value"),
        F.max("highest").alias("max_transaction_value"),
        F.sum("weekend").alias("weekend_revenue"),
        F.sum("weekday").alias("weekday_revenue"),
    )
    return summed.orderBy(F.desc("month"), F.desc("total_revenue"), "category", "region").select(
        month_label(F.col("month")).alias("month_year"),
        "category",
        "region",
        "total_transactions",
        "unique_customers",
        "total_units_sold",
        _money("total_revenue"),
        "avg_transaction_value",
        _money("min_transaction_value"),
        _money("max_transaction_value"),
        _money("weekend_revenue"),
        _money("weekday_revenue"),
    )


def product_performance(
    sales: DataFrame, products: DataFrame, *, sale_id_unique: bool = False
) -> DataFrame:
    """Sales of every product, sold or not, with its share and ranks by revenue.

    Sales are summed per product before the join, so the join meets one row per product.
    """
    facts = sale_measures(sales, "product_id", "customer_id", sale_id_unique=sale_id_unique)
    sold = totals(
        facts, ["product_id"], sale_id_unique, "total_sales", "unique_customers",
        F.sum("units").alias("total_quantity"),
        F.sum("revenue").alias("total_revenue"),
        mean_amount().alias("avg_sale_amount"),
        F.min("first_date").alias("first_sale_date"),
        F.max("last_date").alias("last_sale_date"),
    )
    listed = products.select("product_id", "product_name", "category", "price")
    per_product = pin(
        listed.filter(F.col("category").isNotNull())
        .join(sold, "product_id", "left")
        .fillna(0, ["total_sales", "unique_customers"]),
        "product-sales",
    )
    per_category = per_product.groupBy("category").agg(
        F.sum("total_revenue").alias("_total"), F.count("total_revenue").alias("_sold")
    )
    revenue, mean = money("total_revenue"), F.try_divide(money("_total"), F.col("_sold"))
    ranked = add_ranks(
        per_product, "total_revenue", {"category_rank": "category", "overall_rank": None}
    ).join(per_category, "category")
    return ranked.orderBy(F.desc_nulls_last("total_revenue"), "product_id").select(
        "product_id",
        "product_name",
        "category",
        F.col("price").cast("double").alias("price"),
        "total_sales",
        "total_quantity",
        _money("total_revenue"),
        "avg_sale_amount",
        "unique_customers",
        "first_sale_date",
        "last_sale_date",
        F.round(percent_of(revenue, money("_total")), 2).alias("category_revenue_share"),
        F.when(revenue > mean, "Above Average")
        .when(revenue < mean, "Below Average")
        .otherwise("Average")
        .alias("performance_category"),
        "category_rank",
        "overall_rank",
    )


def sales_metrics(
    sales: DataFrame, products: DataFrame, *, sale_id_unique: bool = False
) -> DataFrame:
    """Monthly orders and revenue per category, with the category's overall rank.

    Products without a category take part in the rank as one category, but are not reported, and a
    month's shares are of what is reported.
    """
    shrink = _shrink(sale_id_unique)
    facts = sale_measures(sales, "product_id", "customer_id", sale_id_unique=sale_id_unique)
    facts = attach(facts, products, "product_id", ["category"], shrink)
    metrics = pin(
        totals(
            facts, ["category", "month"], sale_id_unique, "total_orders", "unique_customers",
            F.sum("units").alias("total_quantity"),
            F.sum("revenue").alias("total_revenue"),
            mean_amount().alias("avg_order_value"),
        ),
        "category-months",
    )
    categories = metrics.groupBy("category").agg(
        F.sum("total_revenue").alias("_category_revenue")
    )
    ranks = add_ranks(categories, "_category_revenue", {"category_rank": None})
    ranks = ranks.drop("_category_revenue")
    months = metrics.filter(F.col("category").isNotNull()).groupBy("month").agg(F.sum("total_revenue").alias("_month_revenue"))
    months = months.withColumnRenamed("month", "_month")
    joined = metrics.join(ranks, "category").join(
        months, F.col("month").eqNullSafe(F.col("_month"))
    )
    share = F.try_divide(money("total_revenue"), money("_month_revenue"))
    return joined.orderBy(F.desc("month"), "category_rank", "category").select(
        "category",
        month_label(F.col("month")).alias("month_year"),
        "total_orders",
        "total_quantity",
        _money("total_revenue"),
        "avg_order_value",
        "unique_customers",
        "category_rank",
        (share * 100).alias("revenue_share"),
    )


def dynamic_report(
    sales: DataFrame, products: DataFrame, customers: DataFrame, *, sale_id_unique: bool = False
) -> DataFrame:
    """Monthly orders and revenue by region and by category, one metric per row."""
    shrink = _shrink(sale_id_unique)

    def monthly(report: str, dimension: DataFrame, key: str, label: str) -> DataFrame:
        facts = sale_measures(sales, key, sale_id_unique=sale_id_unique)
        summed = attach(facts, dimension, key, [label], shrink).groupBy(label, "month").agg(
            transaction_count(sale_id_unique).cast("double").alias("total_orders"),
            (F.sum("revenue").cast("double") / 100).alias("total_revenue"),
        )
        return summed.select(
            F.lit(report).alias("report_type"),
            F.col(label).alias("dimension"),
            month_label(F.col("month")).alias("time_period"),
            "total_orders",
            "total_revenue",
        )

    wide = monthly("sales_by_region", customers, "customer_id", "region").unionByName(
        monthly("sales_by_category", products, "product_id", "category")
    )
    ids = ["report_type", "dimension", "time_period"]
    long = wide.unpivot(ids, ["total_orders", "total_revenue"], "metric_name", "metric_value")
    return long.select(*ids, "metric_value", "metric_name").orderBy(*ids, "metric_name")


def monthly_category_top10(sales: DataFrame, products: DataFrame) -> DataFrame:
    """The ten latest and best-selling month and category pairs."""
    facts = sale_measures(sales, "product_id", sale_id_unique=True)
    # Not folded by product and month: that has nearly as many groups as sales, and would hold them in each task.
    summed = (
        attach(facts, products, "product_id", ["category"], lambda rows: rows)
        .groupBy("month", "category")
        .agg(F.sum("lines").alias("transactions"), F.sum("revenue").alias("total_revenue"))
    )
    top = summed.orderBy(F.desc("month"), F.desc_nulls_last("total_revenue"), "category").limit(10)
    return top.select(
        month_label(F.col("month")).alias("month"), "category", "transactions", _money("total_revenue")
    )


def table_preview(table: DataFrame, key: str, rows: int = 10) -> DataFrame:
    """The first rows of a table by its key."""
    return table.orderBy(key).limit(rows)


def data_quality_report(
    sales: DataFrame, products: DataFrame, customers: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Rows, issues and a text of issue counts for each of the three tables."""
    today = F.lit(as_of) if as_of else F.current_date()

    def missing(name: str) -> Column:
        return F.col(name).isNull()

    def repeated(key: str) -> Column:
        return F.count("*") - F.count_distinct(key)

    checks = {
        "Sales Table": (sales, {
            "Null IDs": F.count_if(missing("sale_id")),
            "Null Products": F.count_if(missing("product_id")),
            "Null Customers": F.count_if(missing("customer_id")),
            "Invalid Amounts": F.count_if(F.col("amount") <= 0),
            "Invalid Quantities": F.count_if(F.col("quantity") <= 0),
            "Future Dates": F.count_if(F.col("sale_date") > today),
        }),
        "Product Table": (products, {
            "Null IDs": F.count_if(missing("product_id")),
            "Null Names": F.count_if(missing("product_name")),
            "Invalid Prices": F.count_if(F.col("price") <= 0),
            "Duplicate IDs": repeated("product_id"),
        }),
        "Customer Table": (customers, {
            "Null IDs": F.count_if(missing("customer_id")),
            "Null Names": F.count_if(missing("customer_name")),
            "Invalid Emails": F.count_if(~F.col("email").like("%@%")),
            "Duplicate IDs": repeated("customer_id"),
        }),
    }

    def summary(name: str, table: DataFrame, counts: dict[str, Column]) -> DataFrame:
        counted = table.agg(
            F.count("*").alias("total_records"), *[n.alias(label) for label, n in counts.items()]
        )
        text = [F.concat(F.lit(f"{label}: "), F.col(label).cast("string")) for label in counts]
        return counted.select(
            F.lit(name).alias("table_name"),
            "total_records",
            sum((F.col(label) for label in counts), F.lit(0)).cast("bigint").alias("total_issues"),
            F.concat_ws(", ", *text).alias("issue_details"),
        )

    first, *others = [summary(name, table, counts) for name, (table, counts) in checks.items()]
    for other in others:
        first = first.unionByName(other)
    return first
