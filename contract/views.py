"""Sales, products and customers derived from the test tables, in Spark and in SQL.

``sale_id`` repeats in these tables (line numbers repeat within an order). The ``raw`` variants add
the disorder that the cleaning steps are there for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.parquet import read_table


# Stated, so that no job has to read file footers for them.
_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", _SCHEMAS[name])


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("amount"),
        F.to_date("o_orderdate").alias("sale_date"),
    )


SALES_SQL = """
    SELECT l_orderkey * 10 + l_linenumber AS sale_id, l_partkey AS product_id,
           o_custkey AS customer_id, CAST(l_quantity AS BIGINT) AS quantity,
           CAST(l_extendedprice AS DECIMAL(10,2)) AS amount, CAST(o_orderdate AS DATE) AS sale_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part, and for every part a variant that has never been sold."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
    )
    variant = part.withColumn("product_id", -F.col("product_id") - 1)
    return part.unionByName(variant.withColumn("product_name", F.concat(F.lit("new "), "product_name")))


PRODUCTS_SQL = """
    SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
           CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part
    UNION ALL
    SELECT -p_partkey - 1, 'new ' || p_name, p_type, CAST(p_retailprice AS DECIMAL(10,2)) FROM part
"""


def _email(key: str, padded: str = "concat(' U', {k}, '@GMAIL.com ')") -> str:
    """One SQL text for both engines: an e-mail of eight kinds by key."""
    return f"""CASE {key} % 8
        WHEN 0 THEN {padded.format(k=key)}
        WHEN 1 THEN concat('u', {key}, '@company.com')
        WHEN 2 THEN concat('noat', {key})
        WHEN 3 THEN concat('x', {key}, '@')
        WHEN 4 THEN concat('a', {key}, '@b@c')
        WHEN 5 THEN NULL
        WHEN 6 THEN concat('U', {key} % 50, '@yahoo.com')
        ELSE concat('u', {key}, '@example.org') END"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.expr(_email("c_custkey")).alias("email"),
            F.col("r_name").alias("region"),
        )
    )


CUSTOMERS_SQL = f"""
    SELECT c_custkey AS customer_id, c_name AS customer_name, {_email("c_custkey")} AS email,
           r_name AS region
    FROM customer JOIN nation ON c_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey
"""

# Disorder, as expressions both engines read alike.
_RAW_PRODUCT = "CASE WHEN l_orderkey % 29 = 0 THEN NULL ELSE l_partkey END"
_RAW_QUANTITY = """CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN 0
                        WHEN l_orderkey % 17 = 0 THEN -1 ELSE CAST(l_quantity AS BIGINT) END"""
_RAW_AMOUNT = """CASE WHEN l_orderkey % 19 = 0 THEN NULL WHEN l_orderkey % 23 = 0 THEN CAST(0 AS DOUBLE)
                      ELSE l_extendedprice / 100 / l_linenumber END"""
_RAW_NAME = """CASE {k} % 6 WHEN 0 THEN concat('  ', upper({n}), ' ') WHEN 1 THEN replace({n}, ' ', '-')
                    WHEN 2 THEN concat({n}, ' o''brien  3rd') WHEN 3 THEN ' '
                    WHEN 4 THEN NULL ELSE {n} END"""
_RAW_LABEL = """CASE {k} % 7 WHEN 0 THEN NULL WHEN 1 THEN concat('  ', lower({n}), ' ') ELSE {n} END"""
_RAW_PRICE = """CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 43 = 0 THEN CAST(0 AS DOUBLE)
                     WHEN p_partkey % 47 = 0 THEN CAST(-5 AS DOUBLE)
                     ELSE CAST(p_size AS DOUBLE) * 20 END"""


def staged_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with ``seq``, the order in which rows of one sale id replace one another."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("amount"),
        F.to_date("o_orderdate").alias("sale_date"),
        F.struct("l_shipdate", "l_partkey", "l_extendedprice", "l_quantity").alias("seq"),
    )


STAGED_SALES_SQL = """
    SELECT l_orderkey * 10 + l_linenumber AS sale_id, l_partkey AS product_id,
           o_custkey AS customer_id, CAST(l_quantity AS BIGINT) AS quantity,
           CAST(l_extendedprice AS DECIMAL(10,2)) AS amount, CAST(o_orderdate AS DATE) AS sale_date,
           row_number() OVER (ORDER BY l_shipdate, l_partkey, l_extendedprice, l_quantity) AS seq
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

LOADED_SALES_SQL = f"""
    SELECT sale_id, product_id, customer_id, quantity, amount, sale_date
    FROM ({STAGED_SALES_SQL})
    QUALIFY row_number() OVER (PARTITION BY sale_id ORDER BY seq DESC) = 1
"""


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"),
        F.expr(_RAW_PRODUCT).alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        F.expr(_RAW_QUANTITY).alias("quantity"),
        F.expr(_RAW_AMOUNT).alias("amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("sale_date"),
    )


RAW_SALES_SQL = f"""
    SELECT l_orderkey * 10 + l_linenumber AS sale_id, {_RAW_PRODUCT} AS product_id,
           o_custkey AS customer_id, {_RAW_QUANTITY} AS quantity, {_RAW_AMOUNT} AS amount,
           strftime(o_orderdate, '%Y-%m-%d') AS sale_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.expr(_RAW_NAME.format(k="p_partkey", n="p_name")).alias("product_name"),
        F.expr(_RAW_LABEL.format(k="p_partkey", n="p_type")).alias("category"),
        F.expr(_RAW_PRICE).alias("price"),
    )


RAW_PRODUCTS_SQL = f"""
    SELECT p_partkey AS product_id, {_RAW_NAME.format(k="p_partkey", n="p_name")} AS product_name,
           {_RAW_LABEL.format(k="p_partkey", n="p_type")} AS category, {_RAW_PRICE} AS price
    FROM part
"""


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.expr(_RAW_NAME.format(k="c_custkey", n="c_name")).alias("customer_name"),
            F.expr(_email("c_custkey")).alias("email"),
            F.expr(_RAW_LABEL.format(k="c_custkey", n="r_name")).alias("region"),
        )
    )


RAW_CUSTOMERS_SQL = f"""
    SELECT c_custkey AS customer_id, {_RAW_NAME.format(k="c_custkey", n="c_name")} AS customer_name,
           {_email("c_custkey")} AS email, {_RAW_LABEL.format(k="c_custkey", n="r_name")} AS region
    FROM customer JOIN nation ON c_nationkey = n_nationkey
                  JOIN region ON n_regionkey = r_regionkey
"""
