"""Reports as stored views: SQL over the names of the stored tables, run when a view is read.

They give the rows of ``tallyloom.plans.reports`` for loaded tables, whose sale ids are unique. A view cannot measure
a dimension or write an intermediate table; broadcasts are left to the optimizer, and ranks are counted by the
bits of the revenue, so no window holds a whole table.
"""

from __future__ import annotations

from tallyloom.operators.ordering import ranked_sql

# One row per sale, money in whole cents.
_LINES = """
lines AS (
    SELECT trunc(sale_date, 'month') AS month, sale_id, product_id, customer_id, quantity, sale_date,
        CAST(rint(CAST(amount AS DOUBLE) * 100) AS BIGINT) AS cents, coalesce(weekday(sale_date) IN (5, 6), false) AS weekend
    FROM {sales}
)"""


def _amount(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


def sales_summary(sales: str, products: str, customers: str) -> str:
    return f"""
WITH {_LINES.format(sales=sales)},
totals AS (
    SELECT month, category, region, count(sale_id) AS total_transactions, count(DISTINCT customer_id) AS unique_customers,
        sum(quantity) AS total_units_sold, sum(cents) AS revenue,
        try_divide({_amount('sum(cents)')}, CAST(count(cents) AS DOUBLE)) AS avg_transaction_value,
        min(cents) AS lowest, max(cents) AS highest,
        sum(CASE WHEN weekend THEN cents ELSE 0 END) AS on_weekends,
        sum(CASE WHEN sale_date IS NOT NULL AND NOT weekend THEN cents ELSE 0 END) AS on_weekdays
    FROM lines JOIN {products} USING (product_id) JOIN {customers} USING (customer_id)
    GROUP BY month, category, region
)
SELECT date_format(month, 'yyyy-MM') AS month_year, category, region, total_transactions, unique_customers,
    total_units_sold, {_amount('revenue')} AS total_revenue, avg_transaction_value,
    {_amount('lowest')} AS min_transaction_value, {_amount('highest')} AS max_transaction_value,
    {_amount('on_weekends')} AS weekend_revenue, {_amount('on_weekdays')} AS weekday_revenue
FROM totals ORDER BY month DESC, revenue DESC, category, region"""


def product_performance(sales: str, products: str, customers: str) -> str:
    ranked = ranked_sql("per_product", "revenue", {"category_rank": "category", "overall_rank": None})
    return f"""
WITH {_LINES.format(sales=sales)},
sold AS (
    SELECT product_id, count(sale_id) AS total_sales, sum(quantity) AS total_quantity, sum(cents) AS revenue,
        try_divide({_amount('sum(cents)')}, CAST(count(cents) AS DOUBLE)) AS avg_sale_amount,
        count(DISTINCT customer_id) AS unique_customers, min(sale_date) AS first_sale_date, max(sale_date) AS last_sale_date
    FROM lines GROUP BY product_id
),
per_product AS (
    SELECT p.product_id, product_name, category, price, coalesce(total_sales, 0) AS total_sales, total_quantity,
        revenue, avg_sale_amount, coalesce(unique_customers, 0) AS unique_customers, first_sale_date, last_sale_date
    FROM {products} p LEFT JOIN sold ON p.product_id = sold.product_id WHERE category IS NOT NULL
),
per_category AS (
    SELECT category AS name, sum(revenue) AS total, count(revenue) AS products_sold FROM per_product GROUP BY category
),
told AS (
    SELECT ranked.*, {_amount('revenue')} AS total_revenue, {_amount('total')} AS category_total,
        try_divide({_amount('total')}, products_sold) AS category_mean
    FROM ({ranked}) ranked JOIN per_category ON category = name
)
SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price, total_sales, total_quantity, total_revenue,
    avg_sale_amount, unique_customers, first_sale_date, last_sale_date,
    round(try_divide(total_revenue * 100.0D, category_total), 2) AS category_revenue_share,
    CASE WHEN total_revenue > category_mean THEN 'Above Average' WHEN total_revenue < category_mean THEN 'Below Average'
        ELSE 'Average' END AS performance_category,
    category_rank, overall_rank
FROM told ORDER BY total_revenue DESC NULLS LAST, product_id"""


def sales_metrics(sales: str, products: str, customers: str) -> str:
    ranked = ranked_sql("per_category", "revenue", {"category_rank": None})
    return f"""
WITH {_LINES.format(sales=sales)},
metrics AS (
    SELECT category, month, count(sale_id) AS total_orders, sum(quantity) AS total_quantity, sum(cents) AS revenue,
        try_divide({_amount('sum(cents)')}, CAST(count(cents) AS DOUBLE)) AS avg_order_value,
        count(DISTINCT customer_id) AS unique_customers
    FROM lines JOIN {products} USING (product_id) GROUP BY category, month
),
per_category AS (SELECT category, sum(revenue) AS revenue FROM metrics GROUP BY category),
ranks AS ({ranked}),
per_month AS (SELECT month AS m, sum(revenue) AS total FROM metrics WHERE category IS NOT NULL GROUP BY month)
SELECT metrics.category, date_format(month, 'yyyy-MM') AS month_year, total_orders, total_quantity,
    {_amount('metrics.revenue')} AS total_revenue, avg_order_value, unique_customers, category_rank,
    try_divide({_amount('metrics.revenue')}, {_amount('total')}) * 100 AS revenue_share
FROM metrics JOIN ranks ON metrics.category = ranks.category JOIN per_month ON month <=> m
ORDER BY month DESC, category_rank, metrics.category"""


def dynamic_report(sales: str, products: str, customers: str) -> str:
    def monthly(report: str, label: str, dimension: str, key: str) -> str:
        return f"""
    SELECT '{report}' AS report_type, {label} AS dimension, date_format(month, 'yyyy-MM') AS time_period,
        CAST(count(sale_id) AS DOUBLE) AS total_orders, {_amount('sum(cents)')} AS total_revenue
    FROM lines JOIN {dimension} USING ({key}) GROUP BY {label}, month"""

    return f"""
WITH {_LINES.format(sales=sales)},
wide AS ({monthly('sales_by_region', 'region', customers, 'customer_id')}
    UNION ALL {monthly('sales_by_category', 'category', products, 'product_id')}
)
SELECT report_type, dimension, time_period, metric_value, metric_name
FROM wide LATERAL VIEW stack(2, 'total_orders', total_orders, 'total_revenue', total_revenue) AS metric_name, metric_value
ORDER BY report_type, dimension, time_period, metric_name"""


def data_quality_report(sales: str, products: str, customers: str) -> str:
    checks = {
        "Sales Table": (sales, {
            "Null IDs": "count_if(sale_id IS NULL)", "Null Products": "count_if(product_id IS NULL)",
            "Null Customers": "count_if(customer_id IS NULL)", "Invalid Amounts": "count_if(amount <= 0)",
            "Invalid Quantities": "count_if(quantity <= 0)", "Future Dates": "count_if(sale_date > current_date())",
        }),
        "Product Table": (products, {
            "Null IDs": "count_if(product_id IS NULL)", "Null Names": "count_if(product_name IS NULL)",
            "Invalid Prices": "count_if(price <= 0)", "Duplicate IDs": "count(*) - count(DISTINCT product_id)",
        }),
        "Customer Table": (customers, {
            "Null IDs": "count_if(customer_id IS NULL)", "Null Names": "count_if(customer_name IS NULL)",
            "Invalid Emails": "count_if(email NOT LIKE '%@%')", "Duplicate IDs": "count(*) - count(DISTINCT customer_id)",
        }),
    }
    parts = []
    for name, (table, counts) in checks.items():
        counted = ", ".join(f"{count} AS c{at}" for at, count in enumerate(counts.values()))
        told = ", ".join(f"concat('{label}: ', c{at})" for at, label in enumerate(counts))
        issues = " + ".join(f"c{at}" for at in range(len(counts)))
        parts.append(f"""
SELECT '{name}' AS table_name, total_records, {issues} AS total_issues, concat_ws(', ', {told}) AS issue_details
FROM (SELECT count(*) AS total_records, {counted} FROM {table})""")
    return " UNION ALL ".join(parts)


def monthly_category_top10(sales: str, products: str, customers: str) -> str:
    return f"""
WITH {_LINES.format(sales=sales)}
SELECT date_format(month, 'yyyy-MM') AS month, category, transactions, {_amount('cents')} AS total_revenue
FROM (
    SELECT month, category, count(*) AS transactions, sum(cents) AS cents
    FROM lines JOIN {products} USING (product_id) GROUP BY month, category
    ORDER BY month DESC, cents DESC NULLS LAST, category LIMIT 10
)"""


REPORTS = {
    f.__name__: f
    for f in (
        sales_summary, product_performance, sales_metrics, dynamic_report, data_quality_report, monthly_category_top10,
    )
}
