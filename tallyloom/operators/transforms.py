"""Cleaning and enriching of the three source tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.calendar import is_weekend
from tallyloom.functions.labels import NO_CATEGORY, NO_REGION, PRICE_TIER_EDGES, PRICE_TIERS
from tallyloom.functions.numeric import band, no_nan, round_cents
from tallyloom.functions.text import customer_segment, email_domain, or_raise, strip, title


def transform_sales(sales: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Calendar columns, unit price, rounded and filled numbers; a malformed date fails the job.

    The unit price comes from the numbers as they arrived: neither rounded nor filled, and null
    where the quantity is zero.
    """
    amount = no_nan(F.col("amount").cast("double"))
    unit_price = F.try_divide(amount, F.col("quantity").cast("double"))
    date = F.col("sale_date")
    parsed = or_raise(date.try_cast("date"), date, "sale_date is not a date")
    return sales.withColumn("sale_date", parsed).withColumns({
        "year": F.year(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "day_of_week": F.weekday(date),
        "is_weekend": is_weekend(date),
        "price_per_unit": round_cents(unit_price),
        "amount": F.coalesce(round_cents(amount), F.lit(0.0)),
        "quantity": F.coalesce("quantity", F.lit(0)),
        "transformed_at": F.lit(as_of),
    })


def transform_products(products: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Clean names and categories, and the price tier."""
    price = no_nan(F.col("price").cast("double"))
    return products.withColumns({
        "product_name": title(strip(F.col("product_name"))),
        "category": F.coalesce(F.upper(strip(F.col("category"))), F.lit(NO_CATEGORY)),
        "price": price,
        "price_tier": band(price, PRICE_TIER_EDGES, PRICE_TIERS),
        "transformed_at": F.lit(as_of),
    })


def transform_customers(customers: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Clean names, e-mails and regions, and the segment by e-mail domain."""
    email = F.lower(strip(F.col("email")))
    domain = email_domain(email)
    return customers.withColumns({
        "customer_name": title(strip(F.col("customer_name"))),
        "email": email,
        "region": F.coalesce(F.upper(strip(F.col("region"))), F.lit(NO_REGION)),
        "email_domain": domain,
        "customer_segment": customer_segment(domain),
        "transformed_at": F.lit(as_of),
    })


TRANSFORMS: dict[str, Callable[[DataFrame, dt.datetime], DataFrame]] = {
    "sales": transform_sales,
    "products": transform_products,
    "customers": transform_customers,
}


def transform(name: str, table: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The transform of the named source; other sources pass unchanged."""
    step = TRANSFORMS.get(name)
    return step(table, as_of) if step else table
