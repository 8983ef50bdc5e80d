"""Star schema: facts, dimensions, and versions of dimension rows over time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.calendar import date_key, is_weekend
from tallyloom.functions.labels import REVENUE_CATEGORIES, REVENUE_EDGES
from tallyloom.functions.numeric import band
from tallyloom.operators.lookup import sent_if_small
from tallyloom.operators.ordering import add_dense_key
from tallyloom.schemas import DIM_CUSTOMER, DIM_PRODUCT
from tallyloom.scratch import pin

PRODUCT_TRACKED, CUSTOMER_TRACKED = DIM_PRODUCT.digest_of, DIM_CUSTOMER.digest_of
#: Column of a stored dimension that holds the digest of each version's tracked columns.
DIGEST = "row_digest"


def required_date_key(date: Column) -> Column:
    return F.when(date.isNull(), F.raise_error(F.lit("a sale without a date has no date key")).cast("int")).otherwise(
        date_key(date)
    )


def _left_null_safe(facts: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Left join on ``_key`` in which a null key finds a null key; a repeated key repeats the fact."""
    return facts.join(side, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def denormalized_fact(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales with the labels of their product and customer, revenue category and date key.

    The dimensions are measured together. One within the bound is broadcast, so the sales are not shuffled;
    else both sides are shuffled, and AQE splits the rows of a hot key, or with no key at all.
    """
    product, customer = sent_if_small(
        products.select(F.col("product_id").alias("_key"), "category", "price_tier"),
        customers.select(F.col("customer_id").alias("_key"), "region", "customer_segment"),
    )
    fact = _left_null_safe(_left_null_safe(sales, product, "product_id"), customer, "customer_id")
    return fact.withColumns({
        "revenue_category": band(F.col("amount"), REVENUE_EDGES, REVENUE_CATEGORIES),
        "date_key": required_date_key(F.col("sale_date")),
    })


def date_dimension(sales: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """One row per date sold on. ``holidays`` has a column ``full_date``; without it
    ``is_holiday`` is null."""
    date = F.col("full_date")
    dim = sales.select(F.to_date("sale_date").alias("full_date")).distinct().select(
        required_date_key(date).alias("date_key"),
        "full_date",
        F.year(date).alias("year"),
        F.quarter(date).alias("quarter"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        F.weekday(date).alias("day_of_week"),
        is_weekend(date).alias("is_weekend"),
    )
    if holidays is None:
        return dim.withColumn("is_holiday", F.lit(None).cast("boolean"))
    marked = holidays.select("full_date").distinct().withColumn("_holiday", F.lit(True))
    return dim.join(marked, "full_date", "left").select(
        *dim.columns, F.coalesce("_holiday", F.lit(False)).alias("is_holiday")
    )


def first_versions(
    table: DataFrame, surrogate: str, business_key: str, as_of: dt.date, after: int = 0
) -> DataFrame:
    """Every row as the current version from ``as_of``, keys counted up in business key order."""
    return add_dense_key(table, surrogate, [business_key], start=after).withColumns({
        "effective_date": F.lit(as_of),
        "end_date": F.lit(None).cast("date"),
        "is_current": F.lit(True),
    })


def product_dimension(products: DataFrame, as_of: dt.date) -> DataFrame:
    return first_versions(products, "product_key", "product_id", as_of)


def customer_dimension(customers: DataFrame, as_of: dt.date) -> DataFrame:
    return first_versions(customers, "customer_key", "customer_id", as_of)


def dimensions(
    sales: DataFrame, products: DataFrame, customers: DataFrame, as_of: dt.date,
    holidays: DataFrame | None = None,
) -> dict[str, DataFrame]:
    return {
        "dim_date": date_dimension(sales, holidays),
        "dim_product": product_dimension(products, as_of),
        "dim_customer": customer_dimension(customers, as_of),
    }


def row_digest(rows: DataFrame, like: DataFrame, tracked: tuple[str, ...]) -> Column:
    """128 bits of the tracked columns of ``rows``, as the types of ``like`` hold them; nulls count as values."""
    cells = [F.col(c).cast(like.schema[c].dataType).alias(c) for c in tracked]
    return F.md5(F.to_json(F.struct(*cells), {"ignoreNullFields": "false"}).cast("binary"))


def scd2_merge(
    dim: DataFrame, incoming: DataFrame, surrogate: str, business_key: str,
    tracked: tuple[str, ...], as_of: dt.date,
) -> DataFrame:
    """Bring a dimension up to date, keeping the old versions (type 2).

    A current row whose tracked columns differ from the incoming ones is closed at ``as_of`` and
    followed by a new version; unknown keys are added; keys that do not come in stay as they are.

    Rows are compared once, by key and digest: of the dimension's stored ``DIGEST`` column if it has one, so that no
    wide row is shuffled for it. What comes of that is a table of the keys that change; with the usual few
    changes it is broadcast, and both the dimension and the incoming rows are read in place.
    """
    repeated = incoming.groupBy(business_key).count()
    if not repeated.filter((F.col("count") > 1) | F.col(business_key).isNull()).isEmpty():
        raise ValueError(f"incoming rows need one {business_key} each")
    columns = [c for c in dim.columns if c != DIGEST]
    digest = F.col(DIGEST) if DIGEST in dim.columns else row_digest(dim, dim, tracked)
    known = dim.filter("is_current").select(
        F.col(business_key).alias("_key"), F.col(surrogate).alias("_closed"), digest.alias("_old")
    )
    arriving = incoming.select(F.col(business_key).alias("_key"), row_digest(incoming, dim, tracked).alias("_new"))
    changed = (F.col("_closed").isNull()) | (F.col("_old") != F.col("_new"))
    changes = pin(arriving.join(known, "_key", "left").filter(changed).select("_key", "_closed"), "changes")
    last_key = dim.agg(F.max(surrogate)).first()[0] or 0

    closed = changes.filter("_closed IS NOT NULL").select("_closed", F.lit(True).alias("_over"))
    over = F.coalesce("_over", F.lit(False))
    versions = dim.join(closed, F.col(surrogate) == F.col("_closed"), "left").withColumns({
        "end_date": F.when(over, F.lit(as_of)).otherwise(F.col("end_date")),
        "is_current": F.col("is_current") & ~over,
    })
    added = incoming.join(changes, F.col(business_key) == F.col("_key"), "left_semi").select(
        business_key, *[F.col(c).cast(dim.schema[c].dataType).alias(c) for c in tracked]
    )
    following = first_versions(added, surrogate, business_key, as_of, after=last_key)
    return versions.select(*columns).unionByName(following.select(*columns))


def _valid_on(dates: DataFrame, dim: DataFrame, business_key: str, surrogate: str) -> DataFrame:
    """(business key, date, surrogate) of every key and date asked for: the version valid then, or null.

    An as-of join: versions and dates asked for are stacked, and along each key's days the last version to have
    begun is carried on. A window has a key's versions and distinct dates, however many rows asked for them,
    and no version meets a date that it is not the answer to.
    """
    none = F.lit(None).cast(dim.schema[surrogate].dataType)
    begun = F.struct(F.col(surrogate).alias("version"), "end_date")
    stacked = dim.select(
        F.col(business_key).alias("_key"), F.col("effective_date").alias("_date"), begun.alias("_begun"), F.lit(0).alias("_asked")
    ).unionByName(dates.select(
        F.col(business_key).alias("_key"), F.col("_date"),
        F.lit(None).cast(f"struct<version: {dim.schema[surrogate].dataType.simpleString()}, end_date: date>").alias("_begun"),
        F.lit(1).alias("_asked"),
    ))
    # A version closed on the day it began is followed by the one that took its place.
    order = ["_date", "_asked", F.col("_begun.end_date").asc_nulls_last()]
    so_far = Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = stacked.withColumn("_last", F.last("_begun", ignorenulls=True).over(so_far)).filter("_asked = 1")
    running = F.col("_last.end_date").isNull() | (F.col("_date") < F.col("_last.end_date"))
    return carried.select("_key", "_date", F.when(running, F.col("_last.version")).otherwise(none).alias(surrogate))


def keyed_fact(
    sales: DataFrame, dim_product: DataFrame, dim_customer: DataFrame, created_at: dt.datetime,
    point_in_time: bool = False, after: int = 0,
) -> DataFrame:
    """Sales with surrogate keys instead of business keys, numbered in sale id order.

    Keys point at the current version, or with ``point_in_time`` at the one valid on the sale date; the versions
    of a key do not overlap. Sales are numbered first, as they are narrow then, and joined after that.
    """
    narrow = sales.select(
        "sale_id", "product_id", "customer_id", required_date_key(F.col("sale_date")).alias("date_key"),
        "quantity", "amount", F.to_date("sale_date").alias("_on"),
    )
    facts = add_dense_key(narrow, "sales_key", ["sale_id"], start=after)
    sides = []
    for dim, key, surrogate in ((dim_product, "product_id", "product_key"), (dim_customer, "customer_id", "customer_key")):
        if point_in_time:
            asked = facts.select(key, F.col("_on").alias("_date")).distinct()
            sides.append(_valid_on(asked.filter(F.col(key).isNotNull()), dim, key, surrogate))
        else:
            sides.append(dim.filter("is_current").select(F.col(key).alias("_key"), surrogate))
    if not point_in_time:
        sides = sent_if_small(*sides)
    for side, key in zip(sides, ("product_id", "customer_id")):
        match = F.col(key) == F.col("_key")
        if point_in_time:
            match = match & (F.col("_on") == F.col("_date"))
        facts = facts.join(side, match, "left").drop("_key", "_date")
    return facts.select(
        "sales_key", "product_key", "customer_key", "date_key", "quantity", "amount", F.lit(created_at).alias("created_at")
    )
