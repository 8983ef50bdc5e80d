"""The same results as SQL over the test tables."""

from __future__ import annotations

from contract import views

_TABLES = f"""
    sales AS ({views.SALES_SQL}),
    products AS ({views.PRODUCTS_SQL}),
    customers AS ({views.CUSTOMERS_SQL})"""

_RAW = f"""
    raw_sales AS ({views.RAW_SALES_SQL}),
    raw_products AS ({views.RAW_PRODUCTS_SQL}),
    raw_customers AS ({views.RAW_CUSTOMERS_SQL})"""

_AS_OF = "DATE '1999-01-01'"

_AVG = "CAST(sum(amount) AS DOUBLE) / count(amount)"
_MONTH = "strftime(sale_date, '%Y-%m')"

SALES_SUMMARY = f"""
WITH {_TABLES}
SELECT {_MONTH} AS month_year, category, region,
       count(DISTINCT sale_id) AS total_transactions,
       count(DISTINCT customer_id) AS unique_customers,
       CAST(sum(quantity) AS BIGINT) AS total_units_sold,
       CAST(sum(amount) AS DOUBLE) AS total_revenue,
       {_AVG} AS avg_transaction_value,
       CAST(min(amount) AS DOUBLE) AS min_transaction_value,
       CAST(max(amount) AS DOUBLE) AS max_transaction_value,
       CAST(sum(CASE WHEN dayofweek(sale_date) IN (0, 6) THEN amount ELSE 0 END) AS DOUBLE) AS weekend_revenue,
       CAST(sum(CASE WHEN dayofweek(sale_date) NOT IN (0, 6) THEN amount ELSE 0 END) AS DOUBLE) AS weekday_revenue
FROM sales JOIN products USING (product_id) JOIN customers USING (customer_id)
GROUP BY ALL ORDER BY month_year DESC, total_revenue DESC
"""

PRODUCT_PERFORMANCE = f"""
WITH {_TABLES},
per_product AS (
    SELECT p.product_id, p.product_name, p.category, p.price,
           count(DISTINCT sale_id) AS total_sales,
           CAST(sum(quantity) AS BIGINT) AS total_quantity,
           sum(amount) AS revenue,
           {_AVG} AS avg_sale_amount,
           count(DISTINCT customer_id) AS unique_customers,
           min(sale_date) AS first_sale_date, max(sale_date) AS last_sale_date
    FROM products p LEFT JOIN sales s ON p.product_id = s.product_id
    GROUP BY p.product_id, p.product_name, p.category, p.price),
categories AS (
    SELECT category, CAST(sum(revenue) AS DOUBLE) AS total,
           CAST(sum(revenue) AS DOUBLE) / count(revenue) AS mean
    FROM per_product GROUP BY category)
SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price, total_sales,
       total_quantity, CAST(revenue AS DOUBLE) AS total_revenue, avg_sale_amount, unique_customers,
       first_sale_date, last_sale_date,
       round(CAST(revenue AS DOUBLE) * 100.0 / NULLIF(total, 0), 2) AS category_revenue_share,
       CASE WHEN CAST(revenue AS DOUBLE) > mean THEN 'Above Average'
            WHEN CAST(revenue AS DOUBLE) < mean THEN 'Below Average'
            ELSE 'Average' END AS performance_category,
       CAST(rank() OVER (PARTITION BY category ORDER BY revenue DESC NULLS LAST) AS INTEGER) AS category_rank,
       CAST(rank() OVER (ORDER BY revenue DESC NULLS LAST) AS INTEGER) AS overall_rank
FROM per_product JOIN categories USING (category)
ORDER BY total_revenue DESC NULLS LAST
"""

SALES_METRICS = f"""
WITH {_TABLES},
metrics AS (
    SELECT category, {_MONTH} AS month_year,
           count(DISTINCT sale_id) AS total_orders,
           CAST(sum(quantity) AS BIGINT) AS total_quantity,
           sum(amount) AS revenue,
           {_AVG} AS avg_order_value,
           count(DISTINCT customer_id) AS unique_customers
    FROM sales JOIN products USING (product_id) GROUP BY ALL),
ranks AS (
    SELECT category, CAST(rank() OVER (ORDER BY sum(revenue) DESC) AS INTEGER) AS category_rank
    FROM metrics GROUP BY category)
SELECT category, month_year, total_orders, total_quantity, CAST(revenue AS DOUBLE) AS total_revenue,
       avg_order_value, unique_customers, category_rank,
       CAST(revenue AS DOUBLE) /
           CAST(sum(revenue) OVER (PARTITION BY month_year) AS DOUBLE) * 100 AS revenue_share
FROM metrics JOIN ranks USING (category)
ORDER BY month_year DESC, category_rank
"""

DYNAMIC_REPORT = f"""
WITH {_TABLES},
by_region AS (
    SELECT 'sales_by_region' AS report_type, region AS dimension, {_MONTH} AS time_period,
           count(DISTINCT sale_id) AS orders, sum(amount) AS revenue
    FROM sales JOIN customers USING (customer_id) GROUP BY ALL),
by_category AS (
    SELECT 'sales_by_category' AS report_type, category AS dimension, {_MONTH} AS time_period,
           count(DISTINCT sale_id) AS orders, sum(amount) AS revenue
    FROM sales JOIN products USING (product_id) GROUP BY ALL)
SELECT report_type, dimension, time_period, CAST(orders AS DOUBLE) AS metric_value,
       'total_orders' AS metric_name FROM by_region
UNION ALL
SELECT report_type, dimension, time_period, CAST(revenue AS DOUBLE), 'total_revenue' FROM by_region
UNION ALL
SELECT report_type, dimension, time_period, CAST(orders AS DOUBLE), 'total_orders' FROM by_category
UNION ALL
SELECT report_type, dimension, time_period, CAST(revenue AS DOUBLE), 'total_revenue' FROM by_category
ORDER BY report_type, dimension, time_period, metric_name
"""

DATA_QUALITY_REPORT = f"""
WITH {_RAW},
sales_counts AS (
    SELECT count(*) AS n, count(*) FILTER (sale_id IS NULL) AS a,
           count(*) FILTER (product_id IS NULL) AS b, count(*) FILTER (customer_id IS NULL) AS c,
           count(*) FILTER (amount <= 0) AS d, count(*) FILTER (quantity <= 0) AS e,
           count(*) FILTER (CAST(sale_date AS DATE) > {_AS_OF}) AS f FROM raw_sales),
product_counts AS (
    SELECT count(*) AS n, count(*) FILTER (product_id IS NULL) AS a,
           count(*) FILTER (product_name IS NULL) AS b, count(*) FILTER (price <= 0) AS c,
           count(*) - count(DISTINCT product_id) AS d FROM raw_products),
customer_counts AS (
    SELECT count(*) AS n, count(*) FILTER (customer_id IS NULL) AS a,
           count(*) FILTER (customer_name IS NULL) AS b,
           count(*) FILTER (email NOT LIKE '%@%') AS c,
           count(*) - count(DISTINCT customer_id) AS d FROM raw_customers)
SELECT 'Sales Table' AS table_name, n AS total_records,
       CAST(a + b + c + d + e + f AS BIGINT) AS total_issues,
       'Null IDs: ' || a || ', Null Products: ' || b || ', Null Customers: ' || c ||
       ', Invalid Amounts: ' || d || ', Invalid Quantities: ' || e || ', Future Dates: ' || f AS issue_details
FROM sales_counts
UNION ALL
SELECT 'Product Table', n, CAST(a + b + c + d AS BIGINT),
       'Null IDs: ' || a || ', Null Names: ' || b || ', Invalid Prices: ' || c || ', Duplicate IDs: ' || d
FROM product_counts
UNION ALL
SELECT 'Customer Table', n, CAST(a + b + c + d AS BIGINT),
       'Null IDs: ' || a || ', Null Names: ' || b || ', Invalid Emails: ' || c || ', Duplicate IDs: ' || d
FROM customer_counts
"""

MONTHLY_CATEGORY_TOP10 = f"""
WITH {_TABLES}
SELECT {_MONTH} AS month, category, count(*) AS transactions,
       CAST(sum(amount) AS DOUBLE) AS total_revenue
FROM sales JOIN products USING (product_id) GROUP BY ALL
ORDER BY month DESC, total_revenue DESC NULLS LAST, category LIMIT 10
"""

PREVIEW_PRODUCTS = f"""
WITH {_TABLES}
SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price
FROM products ORDER BY product_id LIMIT 10
"""

PREVIEW_CUSTOMERS = f"""
WITH {_TABLES} SELECT * FROM customers ORDER BY customer_id LIMIT 10
"""

PREVIEW_SALES = f"""
SELECT sale_id, product_id, customer_id, quantity, CAST(amount AS DOUBLE) AS amount, sale_date
FROM ({views.LOADED_SALES_SQL}) ORDER BY sale_id LIMIT 10
"""


def _over_loaded(report: str) -> str:
    return report.replace(views.SALES_SQL, views.LOADED_SALES_SQL)


def _some_uncategorised(report: str) -> str:
    lacking = "SELECT * REPLACE (CASE WHEN product_id % 7 <> 0 THEN category END AS category)"
    return report.replace(views.PRODUCTS_SQL, f"{lacking} FROM ({views.PRODUCTS_SQL})")


# Cleaning

_STRIP = r"regexp_replace({x}, '^\s+|\s+$', '', 'g')"
_TITLE = r"""array_to_string(list_transform(regexp_extract_all({x}, '[a-zA-Z]+|[^a-zA-Z]+'),
    lambda t: concat(upper(t[1]), lower(t[2:]))), '')"""


def _strip(x: str) -> str:
    return _STRIP.format(x=x)


def _title(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN {_TITLE.format(x=_strip(x))} END"


_CLEAN = f"""{_RAW},
    clean_sales AS (
        SELECT sale_id, product_id, customer_id, COALESCE(quantity, 0) AS quantity,
               COALESCE(round_even(amount * 100, 0) / 100, 0) AS amount,
               CAST(sale_date AS DATE) AS sale_date,
               CAST(year(CAST(sale_date AS DATE)) AS INTEGER) AS year,
               CAST(month(CAST(sale_date AS DATE)) AS INTEGER) AS month,
               CAST(quarter(CAST(sale_date AS DATE)) AS INTEGER) AS quarter,
               CAST(isodow(CAST(sale_date AS DATE)) - 1 AS INTEGER) AS day_of_week,
               isodow(CAST(sale_date AS DATE)) IN (6, 7) AS is_weekend,
               round_even(amount / NULLIF(quantity, 0) * 100, 0) / 100 AS price_per_unit
        FROM raw_sales),
    clean_products AS (
        SELECT product_id, {_title("product_name")} AS product_name,
               COALESCE(upper({_strip("category")}), 'UNCATEGORIZED') AS category, price,
               CASE WHEN price <= 0 THEN NULL WHEN price <= 50 THEN 'Budget'
                    WHEN price <= 200 THEN 'Standard' WHEN price <= 500 THEN 'Premium'
                    WHEN price > 500 THEN 'Luxury' END AS price_tier
        FROM raw_products),
    clean_emails AS (
        SELECT * REPLACE (lower({_strip("email")}) AS email) FROM raw_customers),
    clean_customers AS (
        SELECT customer_id, {_title("customer_name")} AS customer_name, email,
               COALESCE(upper({_strip("region")}), 'UNKNOWN') AS region,
               string_split(email, '@')[2] AS email_domain,
               CASE WHEN string_split(email, '@')[2] IN ('company.com', 'business.com', 'corp.com') THEN 'Corporate'
                    WHEN string_split(email, '@')[2] IN ('gmail.com', 'yahoo.com', 'hotmail.com', 'outlook.com') THEN 'Personal'
                    WHEN string_split(email, '@')[2] = '' THEN 'Unknown'
                    ELSE 'Other' END AS customer_segment
        FROM clean_emails)"""

_STAMP = "'1999-01-01 00:00:00' AS transformed_at"

SALES_TRANSFORM = f"WITH {_CLEAN} SELECT *, {_STAMP} FROM clean_sales"
PRODUCT_TRANSFORM = f"WITH {_CLEAN} SELECT *, {_STAMP} FROM clean_products"
CUSTOMER_TRANSFORM = f"WITH {_CLEAN} SELECT *, {_STAMP} FROM clean_customers"

# Star schema

FACT_DENORMALIZED = f"""
WITH {_CLEAN}
SELECT s.*, p.category, p.price_tier, c.region, c.customer_segment,
       CASE WHEN amount <= 0 THEN NULL WHEN amount <= 100 THEN 'Small' WHEN amount <= 500 THEN 'Medium'
            WHEN amount <= 1000 THEN 'Large' WHEN amount > 1000 THEN 'Enterprise' END AS revenue_category,
       CAST(strftime(sale_date, '%Y%m%d') AS INTEGER) AS date_key
FROM clean_sales s
LEFT JOIN clean_products p ON s.product_id IS NOT DISTINCT FROM p.product_id
LEFT JOIN clean_customers c ON s.customer_id IS NOT DISTINCT FROM c.customer_id
"""

_DATES = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey"

DIM_DATE = f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, isodow(d) IN (6, 7) AS is_weekend
FROM ({_DATES})
"""

HOLIDAY_FLAG = f"""
SELECT d AS full_date, strftime(d, '%m-%d') IN ('01-01', '12-25') AS is_holiday FROM ({_DATES})
"""


def _first_versions(table: str, surrogate: str, key: str) -> str:
    return f"""
WITH {_CLEAN}
SELECT row_number() OVER (ORDER BY {key}) AS {surrogate}, *, {_AS_OF} AS effective_date,
       CAST(NULL AS DATE) AS end_date, TRUE AS is_current
FROM {table}
"""


DIMENSION_SET = f"""
WITH {_CLEAN}
SELECT 'dim_date' AS dimension, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS business_key FROM ({_DATES})
UNION ALL SELECT 'dim_product', CAST(product_id AS BIGINT) FROM clean_products
UNION ALL SELECT 'dim_customer', CAST(customer_id AS BIGINT) FROM clean_customers
"""

DIM_PRODUCT = _first_versions("clean_products", "product_key", "product_id")
DIM_CUSTOMER = _first_versions("clean_customers", "customer_key", "customer_id")

_VERSIONS = f"""{_TABLES},
    listed AS (
        SELECT row_number() OVER (ORDER BY product_id) AS product_key, *
        FROM products WHERE product_id >= 0),
    reissued AS (
        SELECT product_id, product_name, category, price + 10 AS price
        FROM products WHERE product_id >= 0 AND category = 'PROMO'
        UNION ALL
        SELECT * FROM products WHERE product_id < 0 AND category = 'ECONOMY'),
    versions AS (
        SELECT product_key, product_id, product_name, category, CAST(price AS DECIMAL(10,2)) AS price,
               DATE '1998-01-01' AS effective_date,
               CASE WHEN category = 'PROMO' THEN {_AS_OF} END AS end_date,
               category <> 'PROMO' AS is_current
        FROM listed
        UNION ALL
        SELECT (SELECT max(product_key) FROM listed) + row_number() OVER (ORDER BY product_id),
               product_id, product_name, category, CAST(price AS DECIMAL(10,2)), {_AS_OF},
               CAST(NULL AS DATE), TRUE
        FROM reissued)"""

SCD2_MERGE = f"""
WITH {_VERSIONS} SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM versions
"""

_KEYED = f"""
WITH {_VERSIONS},
loaded AS ({views.LOADED_SALES_SQL}),
customer_versions AS (
    SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id,
           DATE '1998-01-01' AS effective_date FROM customers)
SELECT row_number() OVER (ORDER BY sale_id) AS sales_key, p.product_key, c.customer_key,
       CAST(strftime(sale_date, '%Y%m%d') AS INTEGER) AS date_key, quantity, CAST(amount AS DOUBLE) AS amount
FROM loaded s
LEFT JOIN versions p ON s.product_id = p.product_id AND {{product}}
LEFT JOIN customer_versions c ON s.customer_id = c.customer_id AND {{customer}}
"""

FACT_KEYED = _KEYED.format(product="p.is_current", customer="TRUE")
FACT_POINT_IN_TIME = _KEYED.format(
    product="p.effective_date <= sale_date AND (p.end_date IS NULL OR sale_date < p.end_date)",
    customer="c.effective_date <= sale_date",
)

# Quality and integrity

_CLEAN_COUNTS = f"""{_CLEAN},
    counts AS (
        SELECT 'sales' AS table_name, 'not_null_columns' AS check_type, 'sale_id' AS column_name,
               'nulls' AS metric, count(*) FILTER (sale_id IS NULL) AS n FROM clean_sales
        UNION ALL SELECT 'sales', 'not_null_columns', 'product_id', 'nulls', count(*) FILTER (product_id IS NULL) FROM clean_sales
        UNION ALL SELECT 'sales', 'not_null_columns', 'customer_id', 'nulls', count(*) FILTER (customer_id IS NULL) FROM clean_sales
        UNION ALL SELECT 'sales', 'not_null_columns', 'sale_date', 'nulls', count(*) FILTER (sale_date IS NULL) FROM clean_sales
        UNION ALL SELECT 'products', 'not_null_columns', 'product_id', 'nulls', count(*) FILTER (product_id IS NULL) FROM clean_products
        UNION ALL SELECT 'products', 'not_null_columns', 'product_name', 'nulls', count(*) FILTER (product_name IS NULL) FROM clean_products
        UNION ALL SELECT 'customers', 'not_null_columns', 'customer_id', 'nulls', count(*) FILTER (customer_id IS NULL) FROM clean_customers
        UNION ALL SELECT 'customers', 'not_null_columns', 'customer_name', 'nulls', count(*) FILTER (customer_name IS NULL) FROM clean_customers
        UNION ALL SELECT 'sales', 'numeric_ranges', 'quantity', 'below_min', count(*) FILTER (quantity < 0) FROM clean_sales
        UNION ALL SELECT 'sales', 'numeric_ranges', 'quantity', 'above_max', count(*) FILTER (quantity > 1000) FROM clean_sales
        UNION ALL SELECT 'sales', 'numeric_ranges', 'amount', 'below_min', count(*) FILTER (amount < 0) FROM clean_sales
        UNION ALL SELECT 'sales', 'numeric_ranges', 'amount', 'above_max', count(*) FILTER (amount > 1000000) FROM clean_sales
        UNION ALL SELECT 'products', 'numeric_ranges', 'price', 'below_min', count(*) FILTER (price < 0) FROM clean_products
        UNION ALL SELECT 'products', 'numeric_ranges', 'price', 'above_max', count(*) FILTER (price > 10000) FROM clean_products
        UNION ALL SELECT 'sales', 'unique_columns', 'sale_id', 'duplicates',
                         count(*) - count(DISTINCT sale_id) - CAST(bool_or(sale_id IS NULL) AS INTEGER) FROM clean_sales
        UNION ALL SELECT 'products', 'unique_columns', 'product_id', 'duplicates',
                         count(*) - count(DISTINCT product_id) - CAST(bool_or(product_id IS NULL) AS INTEGER) FROM clean_products
        UNION ALL SELECT 'customers', 'unique_columns', 'customer_id', 'duplicates',
                         count(*) - count(DISTINCT customer_id) - CAST(bool_or(customer_id IS NULL) AS INTEGER) FROM clean_customers
        UNION ALL SELECT 'customers', 'unique_columns', 'email', 'duplicates',
                         count(*) - count(DISTINCT email) - CAST(bool_or(email IS NULL) AS INTEGER) FROM clean_customers
        UNION ALL SELECT 'sales', 'custom_checks', 'amount', '{{}} records have quantity but zero amount',
                         count(*) FILTER (quantity > 0 AND amount = 0) FROM clean_sales
        UNION ALL SELECT 'sales', 'custom_checks', 'sale_date', '{{}} records have future sale dates',
                         count(*) FILTER (sale_date > {_AS_OF}) FROM clean_sales
        UNION ALL SELECT 'products', 'custom_checks', 'price', '{{}} products have zero or negative prices',
                         count(*) FILTER (price <= 0) FROM clean_products
        UNION ALL SELECT 'customers', 'custom_checks', 'email', '{{}} customers have invalid email formats',
                         count(*) FILTER (email IS NULL OR NOT contains(email, '@')) FROM clean_customers)"""


def _counts_of(check: str) -> str:
    return f"""
WITH {_CLEAN_COUNTS}
SELECT table_name, column_name, metric, CAST(n AS BIGINT) AS n FROM counts WHERE check_type = '{check}'
"""


_LOG = f"""{_CLEAN_COUNTS},
    found AS (
        SELECT table_name, check_type, column_name, rn, bool_or(n > 0) AS broken,
               CASE check_type
                   WHEN 'numeric_ranges' THEN '"' || column_name || '": {{"below_min": ' ||
                        max(n) FILTER (metric = 'below_min') || ', "above_max": ' ||
                        max(n) FILTER (metric = 'above_max') || '}}'
                   WHEN 'custom_checks' THEN '"' || replace(max(metric), '{{}}', CAST(max(n) AS VARCHAR)) || '"'
                   ELSE '"' || column_name || '": ' || max(n) END AS detail
        FROM (SELECT *, CASE column_name WHEN 'sale_id' THEN 1 WHEN 'product_id' THEN 2 WHEN 'customer_id' THEN 3
                        WHEN 'quantity' THEN 4 WHEN 'amount' THEN 5 WHEN 'sale_date' THEN 6 ELSE 7 END AS rn
              FROM counts)
        GROUP BY table_name, check_type, column_name, rn),
    checks AS (
        SELECT t AS table_name, c AS check_type
        FROM (SELECT unnest(['sales', 'products', 'customers']) AS t),
             (SELECT unnest(['required_columns', 'not_null_columns', 'numeric_ranges', 'unique_columns',
                             'data_types', 'custom_checks']) AS c)),
    log AS (
        SELECT checks.table_name, checks.check_type, count(*) FILTER (broken) = 0 AS check_result,
               CASE checks.check_type
                   WHEN 'required_columns' THEN '{{"missing_columns": []}}'
                   WHEN 'data_types' THEN '{{"issues": []}}'
                   WHEN 'custom_checks' THEN '{{"issues": [' || COALESCE(string_agg(detail, ', ' ORDER BY rn) FILTER (broken), '') || ']}}'
                   ELSE '{{"' || CASE checks.check_type WHEN 'not_null_columns' THEN 'null_counts'
                                     WHEN 'numeric_ranges' THEN 'out_of_range' ELSE 'duplicate_counts' END ||
                        '": {{' || COALESCE(string_agg(detail, ', ' ORDER BY rn) FILTER (broken), '') || '}}}}' END AS details
        FROM checks LEFT JOIN found ON checks.table_name = found.table_name AND checks.check_type = found.check_type
        GROUP BY checks.table_name, checks.check_type)"""

DQ_LOG = f"WITH {_LOG} SELECT * FROM log"

DQ_REPORT_SUMMARY = f"""
WITH {_LOG}
SELECT table_name, count(*) FILTER (check_result) AS passed_checks, count(*) AS total_checks
FROM log GROUP BY table_name
"""

DQ_GATE = f"""
WITH {_LOG}
SELECT count(*) FILTER (check_result) AS passed_checks, count(*) AS total_checks,
       CAST(count(*) FILTER (check_result) AS DOUBLE) / count(*) AS pass_ratio,
       CAST(count(*) FILTER (check_result) AS DOUBLE) / count(*) >= 0.95 AS accepted
FROM log
"""


def _constraint(table: str, rule: str, column: str) -> str:
    count = (
        f"count(*) FILTER ({column} IS NULL)" if rule == "not_null"
        else f"count({column}) - count(DISTINCT {column})"
    )
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, "
        f"CAST({count} AS BIGINT) AS violations FROM clean_{table}"
    )


CONSTRAINT_CHECK = f"WITH {_CLEAN} " + " UNION ALL ".join(
    _constraint(*key) for key in (
        ("sales", "not_null", "sale_id"), ("sales", "unique", "sale_id"),
        ("products", "not_null", "product_id"), ("products", "not_null", "product_name"),
        ("products", "unique", "product_id"),
        ("customers", "not_null", "customer_id"), ("customers", "not_null", "customer_name"),
        ("customers", "unique", "customer_id"), ("customers", "unique", "email"),
    )
)

FK_ORPHANS = f"""
WITH {_TABLES}
SELECT 'sales' AS table_name, 'product_id' AS column_name, 'products' AS parent_table,
       count(DISTINCT product_id) AS orphan_values, count(*) AS orphan_rows
FROM sales WHERE product_id NOT IN (SELECT product_id FROM products WHERE category <> 'PROMO')
UNION ALL
SELECT 'sales', 'customer_id', 'customers', count(DISTINCT customer_id), count(*)
FROM sales WHERE customer_id NOT IN (SELECT customer_id FROM customers WHERE region <> 'ASIA')
"""

FK_ORPHANS_FACT = f"""
WITH {_TABLES}, loaded AS ({views.LOADED_SALES_SQL})
SELECT 'fact_sales' AS table_name, 'product_key' AS column_name, 'dim_product' AS parent_table,
       count(DISTINCT product_id) AS orphan_values, count(*) AS orphan_rows
FROM loaded JOIN products USING (product_id) WHERE category = 'PROMO'
UNION ALL
SELECT 'fact_sales', 'customer_key', 'dim_customer', count(DISTINCT customer_id), count(*)
FROM loaded JOIN customers USING (customer_id) WHERE region = 'ASIA'
UNION ALL
SELECT 'fact_sales', 'date_key', 'dim_date', count(DISTINCT sale_date), count(*) FROM loaded WHERE year(sale_date) < 2000
"""

FK_ORPHANS_LOGS = """
SELECT 'data_quality_logs' AS table_name, 'run_id' AS column_name, 'pipeline_runs' AS parent_table,
       count(DISTINCT l_orderkey) AS orphan_values, count(*) AS orphan_rows
FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
"""

# Load and audit

UPSERT_MERGE = f"""
WITH staged AS ({views.STAGED_SALES_SQL}),
history AS (
    SELECT * FROM staged WHERE sale_date < DATE '2000-01-01'
    QUALIFY row_number() OVER (PARTITION BY sale_id ORDER BY seq DESC) = 1),
late AS (
    SELECT * FROM staged WHERE sale_date >= DATE '1998-01-01'
    QUALIFY row_number() OVER (PARTITION BY sale_id ORDER BY seq DESC) = 1)
SELECT sale_id, product_id, customer_id, quantity, CAST(amount AS DOUBLE) AS amount, sale_date,
       DATE '2002-01-01' AS created_at
FROM history WHERE sale_id NOT IN (SELECT sale_id FROM late)
UNION ALL
SELECT sale_id, product_id, customer_id, quantity, CAST(amount + 1 AS DOUBLE), sale_date, DATE '2002-01-02'
FROM late
"""

# Sales after both loads of UPSERT_MERGE.
_MERGED_SALES = f"""
    SELECT sale_id, product_id, customer_id, quantity,
           CAST(CASE WHEN sale_date >= DATE '1998-01-01' THEN amount + 1 ELSE amount END AS DECIMAL(10,2)) AS amount, sale_date
    FROM ({views.STAGED_SALES_SQL})
    QUALIFY row_number() OVER (PARTITION BY sale_id ORDER BY sale_date >= DATE '1998-01-01' DESC, seq DESC) = 1
"""


def _over_merged(report: str) -> str:
    return report.replace(views.SALES_SQL, _MERGED_SALES)


_ORDERS_AS_SALES = """
    SELECT o_orderkey AS sale_id, min(l_partkey) AS product_id, o_custkey AS customer_id,
           CAST(sum(l_quantity) AS BIGINT) AS quantity, min(l_extendedprice) AS amount, CAST(o_orderdate AS DATE) AS sale_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey, o_orderdate
"""

JOB_LOAD = f"""
SELECT sale_id, product_id, customer_id, quantity, round(amount, 2) AS amount, sale_date, DATE '1999-01-01' AS created_at
FROM ({_ORDERS_AS_SALES})
"""

JOB_RUNS = f"""
WITH loaded AS (
    SELECT (SELECT count(*) FROM ({_ORDERS_AS_SALES})) + (SELECT count(*) FROM ({views.RAW_CUSTOMERS_SQL})) AS n
)
SELECT CAST(i + 1 AS BIGINT) AS run_id, 'orders' AS pipeline_name, CASE WHEN i = 0 THEN 'COMPLETED' ELSE 'FAILED' END AS status,
       CASE WHEN i = 0 THEN n ELSE 0 END AS records_processed, CAST(i AS INTEGER) AS started_at, i > 0 AS has_error
FROM loaded, range(4) AS r(i)
"""

JOB_LOGS = f"""
WITH sales AS ({_ORDERS_AS_SALES}),
counts AS (
    SELECT count(*) FILTER (sale_date > {_AS_OF}) AS future, count(*) FILTER (quantity > 1000) AS many,
           (SELECT count(*) FROM ({views.RAW_CUSTOMERS_SQL})) AS customers
    FROM sales),
checks AS (
    SELECT unnest([
        struct_pack(t := 'sales', c := 'required_columns', passed := true, details := '{{"missing_columns": []}}'),
        struct_pack(t := 'sales', c := 'not_null_columns', passed := true, details := '{{"null_counts": {{}}}}'),
        struct_pack(t := 'sales', c := 'numeric_ranges', passed := many = 0, details := CASE WHEN many = 0
            THEN '{{"out_of_range": {{}}}}' ELSE '{{"out_of_range": {{"quantity": {{"below_min": 0, "above_max": ' || many || '}}}}}}' END),
        struct_pack(t := 'sales', c := 'unique_columns', passed := true, details := '{{"duplicate_counts": {{}}}}'),
        struct_pack(t := 'sales', c := 'data_types', passed := true, details := '{{"issues": []}}'),
        struct_pack(t := 'sales', c := 'custom_checks', passed := future = 0, details :=
            CASE WHEN future = 0 THEN '{{"issues": []}}' ELSE '{{"issues": ["' || future || ' records have future sale dates"]}}' END),
        struct_pack(t := 'customers', c := 'required_columns', passed := true, details := '{{"missing_columns": []}}'),
        struct_pack(t := 'customers', c := 'not_null_columns', passed := true, details := '{{"null_counts": {{}}}}'),
        struct_pack(t := 'customers', c := 'numeric_ranges', passed := true, details := '{{"out_of_range": {{}}}}'),
        struct_pack(t := 'customers', c := 'unique_columns', passed := false,
            details := '{{"duplicate_counts": {{"email": ' || (customers - 1) || '}}}}'),
        struct_pack(t := 'customers', c := 'data_types', passed := true, details := '{{"issues": []}}'),
        struct_pack(t := 'customers', c := 'custom_checks', passed := false,
            details := '{{"issues": ["' || customers || ' customers have invalid email formats"]}}')
    ]) AS k, unnest(range(12)) AS i
    FROM counts)
SELECT r * 12 + i + 1 AS log_id, r + 1 AS run_id, k.t AS table_name, k.c AS check_type, k.passed AS check_result, k.details AS details
FROM checks, range(2) AS runs(r)
"""

UPSERT_UNIQUE_EMAIL = f"""
WITH {_TABLES},
target AS (
    SELECT * FROM customers
    QUALIFY email IS NULL OR row_number() OVER (PARTITION BY email ORDER BY customer_id DESC) = 1),
staged AS (
    SELECT o_custkey AS customer_id, 'Customer of order ' || o_orderkey AS customer_name,
           CASE WHEN month(o_orderdate) <> 12
                THEN concat('u', o_custkey + month(o_orderdate) % 3, '@example.org') END AS email,
           o_orderstatus AS region, o_orderkey AS seq
    FROM orders),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY seq DESC) AS by_id,
           row_number() OVER (PARTITION BY email ORDER BY seq DESC) AS by_email
    FROM staged)
SELECT customer_id, customer_name, email, region FROM ranked
WHERE by_id = 1 AND (email IS NULL OR by_email = 1)
UNION ALL
SELECT * FROM target t
WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.customer_id = t.customer_id)
  AND NOT EXISTS (SELECT 1 FROM staged s WHERE s.email = t.email)
"""

APPEND_LOAD = f"""
SELECT sale_id, product_id, customer_id, quantity, CAST(amount AS DOUBLE) AS amount, sale_date
FROM ({views.LOADED_SALES_SQL})
"""

STAGING_REPLACE = f"WITH {_CLEAN} SELECT product_id, product_name, category, price FROM clean_products"

RUN_HISTORY = """
WITH events AS (
    SELECT l_orderkey AS run_id, CAST(l_shipdate AS DATE) + 4000 AS event_date,
           bool_or(l_returnflag = 'R') AS failed, CAST(sum(l_quantity) AS BIGINT) AS records
    FROM lineitem GROUP BY 1, 2),
ends AS (
    SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY event_date DESC) = 1)
SELECT o_orderkey AS run_id, o_orderpriority AS pipeline_name,
       CASE WHEN failed IS NULL THEN 'STARTED' WHEN failed THEN 'FAILED' ELSE 'COMPLETED' END AS status,
       CAST(o_orderdate AS DATE) AS start_time, event_date AS end_time, records AS records_processed,
       CASE WHEN failed THEN 'returned' END AS error_message
FROM orders LEFT JOIN ends ON o_orderkey = run_id
"""

# Sources and sinks

CSV_ROUNDTRIP = views.RAW_PRODUCTS_SQL

QUERY_SOURCE = f"""
SELECT sale_date, count(*) AS sales, CAST(sum(quantity) AS BIGINT) AS units
FROM ({views.SALES_SQL}) GROUP BY sale_date
"""

ORACLE = {
    "sales_summary": SALES_SUMMARY,
    "product_performance": PRODUCT_PERFORMANCE,
    "sales_metrics": SALES_METRICS,
    "dynamic_report": DYNAMIC_REPORT,
    "data_quality_report": DATA_QUALITY_REPORT,
    "monthly_category_top10": MONTHLY_CATEGORY_TOP10,
    "preview_products": PREVIEW_PRODUCTS,
    "preview_customers": PREVIEW_CUSTOMERS,
    "preview_sales": PREVIEW_SALES,
    "sales_metrics_uncategorised": _some_uncategorised(SALES_METRICS),
    "product_performance_uncategorised": _some_uncategorised(PRODUCT_PERFORMANCE),
    "loaded_sales_summary": _over_loaded(SALES_SUMMARY),
    "loaded_product_performance": _over_loaded(PRODUCT_PERFORMANCE),
    "loaded_sales_metrics": _over_loaded(SALES_METRICS),
    "loaded_dynamic_report": _over_loaded(DYNAMIC_REPORT),
    "sales_transform": SALES_TRANSFORM,
    "product_transform": PRODUCT_TRANSFORM,
    "customer_transform": CUSTOMER_TRANSFORM,
    "fact_denormalized": FACT_DENORMALIZED,
    "dim_date": DIM_DATE,
    "holiday_flag": HOLIDAY_FLAG,
    "dimension_set": DIMENSION_SET,
    "dim_product": DIM_PRODUCT,
    "dim_customer": DIM_CUSTOMER,
    "scd2_merge": SCD2_MERGE,
    "fact_keyed": FACT_KEYED,
    "fact_point_in_time": FACT_POINT_IN_TIME,
    "dq_not_null": _counts_of("not_null_columns"),
    "dq_ranges": _counts_of("numeric_ranges"),
    "dq_unique": _counts_of("unique_columns"),
    "dq_custom": _counts_of("custom_checks"),
    "dq_log": DQ_LOG,
    "dq_report_summary": DQ_REPORT_SUMMARY,
    "dq_gate": DQ_GATE,
    "constraint_check": CONSTRAINT_CHECK,
    "fk_orphans": FK_ORPHANS,
    "fk_orphans_fact": FK_ORPHANS_FACT,
    "fk_orphans_logs": FK_ORPHANS_LOGS,
    "live_sales_summary": _over_merged(SALES_SUMMARY),
    "live_product_performance": _over_merged(PRODUCT_PERFORMANCE),
    "live_sales_metrics": _over_merged(SALES_METRICS),
    "job_load": JOB_LOAD,
    "job_runs": JOB_RUNS,
    "job_logs": JOB_LOGS,
    "upsert_merge": UPSERT_MERGE,
    "upsert_unique_email": UPSERT_UNIQUE_EMAIL,
    "append_load": APPEND_LOAD,
    "staging_replace": STAGING_REPLACE,
    "run_history": RUN_HISTORY,
    "csv_roundtrip": CSV_ROUNDTRIP,
    "query_source": QUERY_SOURCE,
}
