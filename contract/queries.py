"""One query per operator or report: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import views
from tallyloom.operators import audit, integrity, quality, star
from tallyloom.operators.merge import survivors
from tallyloom.operators.transforms import transform
from tallyloom.plans import live, reports
from tallyloom.plans.job import SalesJob
from tallyloom.plans.store import TableStore, write_staging
from tallyloom.schemas import CUSTOMERS, DATA_QUALITY_LOGS, FACT_SALES, PRODUCTS, SALES
from tallyloom.scratch import pin, scratch_path
from tallyloom.sources.delimited import SEQ, read_text_cells, typed, write_csv
from tallyloom.sources.extract import extract

AS_OF = dt.date(1999, 1, 1)
NOW = dt.datetime(1999, 1, 1)
FIRST_LOAD, LATER_LOAD = dt.datetime(2002, 1, 1), dt.datetime(2002, 1, 2)


# Reports


def sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sales_summary(
        views.sales(spark, sf_dir), views.products(spark, sf_dir), views.customers(spark, sf_dir)
    )


def product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.product_performance(views.sales(spark, sf_dir), views.products(spark, sf_dir))


def sales_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sales_metrics(views.sales(spark, sf_dir), views.products(spark, sf_dir))


def _some_uncategorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products, every seventh without a category."""
    lacking = F.when(F.col("product_id") % 7 != 0, F.col("category"))
    return views.products(spark, sf_dir).withColumn("category", lacking)


def sales_metrics_uncategorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sales_metrics(views.sales(spark, sf_dir), _some_uncategorised(spark, sf_dir))


def product_performance_uncategorised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.product_performance(views.sales(spark, sf_dir), _some_uncategorised(spark, sf_dir))


def dynamic_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.dynamic_report(
        views.sales(spark, sf_dir), views.products(spark, sf_dir), views.customers(spark, sf_dir)
    )


def data_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = views.raw_sales(spark, sf_dir).withColumn("sale_date", F.to_date("sale_date"))
    return reports.data_quality_report(
        sales, views.raw_products(spark, sf_dir), views.raw_customers(spark, sf_dir), as_of=AS_OF
    )


def monthly_category_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.monthly_category_top10(views.sales(spark, sf_dir), views.products(spark, sf_dir))


def preview_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = views.products(spark, sf_dir).withColumn("price", F.col("price").cast("double"))
    return reports.table_preview(table, "product_id")


def preview_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_preview(views.customers(spark, sf_dir), "customer_id")


def preview_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_preview(_amounts(_loaded(spark, sf_dir)), "sale_id")


# Reports over loaded sales, where the loader has made the sale id unique


def _amounts(sales: DataFrame) -> DataFrame:
    return sales.withColumn("amount", F.col("amount").cast("double"))


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales after the upsert of every line in order of shipping."""
    rows = survivors(views.staged_sales(spark, sf_dir), "sale_id", (), "seq")
    return pin(rows.drop("seq"), "loaded-sales")


def loaded_sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sales_summary(
        _loaded(spark, sf_dir), views.products(spark, sf_dir), views.customers(spark, sf_dir),
        sale_id_unique=True,
    )


def loaded_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.product_performance(
        _loaded(spark, sf_dir), views.products(spark, sf_dir), sale_id_unique=True
    )


def loaded_sales_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sales_metrics(
        _loaded(spark, sf_dir), views.products(spark, sf_dir), sale_id_unique=True
    )


def loaded_dynamic_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.dynamic_report(
        _loaded(spark, sf_dir), views.products(spark, sf_dir), views.customers(spark, sf_dir),
        sale_id_unique=True,
    )


# Cleaning and enriching


def _transformed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    raw = {
        "sales": views.raw_sales(spark, sf_dir),
        "products": views.raw_products(spark, sf_dir),
        "customers": views.raw_customers(spark, sf_dir),
    }
    return {name: transform(name, table, NOW) for name, table in raw.items()}


def _clean(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table.drop("transformed_at") for name, table in _transformed(spark, sf_dir).items()}


def _stamped(table: DataFrame) -> DataFrame:
    """The time of the transform as text, which reads the same in any session's time zone."""
    return table.withColumn("transformed_at", F.date_format("transformed_at", "yyyy-MM-dd HH:mm:ss"))


def sales_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(_transformed(spark, sf_dir)["sales"])


def product_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(_transformed(spark, sf_dir)["products"])


def customer_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(_transformed(spark, sf_dir)["customers"])


# Star schema


def fact_denormalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.denormalized_fact(**_clean(spark, sf_dir))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.date_dimension(views.sales(spark, sf_dir)).drop("is_holiday")


def holiday_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New Year's Day and Christmas of every year sold in."""
    sales = views.sales(spark, sf_dir)
    years = sales.select(F.year("sale_date").alias("y")).distinct()
    holidays = years.select(F.explode(F.array(
        F.make_date("y", F.lit(1), F.lit(1)), F.make_date("y", F.lit(12), F.lit(25))
    )).alias("full_date"))
    return star.date_dimension(sales, holidays).select("full_date", "is_holiday")


def dimension_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of all three dimensions built in one call, by the name of the dimension."""
    built = star.dimensions(**_clean(spark, sf_dir), as_of=NOW.date())
    keys = {"dim_date": "date_key", "dim_product": "product_id", "dim_customer": "customer_id"}
    return reduce(DataFrame.unionByName, [
        built[name].select(F.lit(name).alias("dimension"), F.col(key).cast("bigint").alias("business_key"))
        for name, key in keys.items()
    ])


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.product_dimension(_clean(spark, sf_dir)["products"], AS_OF)


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.customer_dimension(_clean(spark, sf_dir)["customers"], AS_OF)


def _product_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts as first versions of 1998, then a year later: promoted parts cost ten more, small
    parts do not come in, and economy parts get a variant."""
    part = views.products(spark, sf_dir)
    sold = part.filter(F.col("product_id") >= 0)
    first = star.first_versions(sold, "product_key", "product_id", dt.date(1998, 1, 1))
    promoted = F.when(F.col("category") == "PROMO", F.col("price") + 10).otherwise(F.col("price"))
    incoming = part.filter(
        ((F.col("product_id") >= 0) & (F.col("category") != "SMALL"))
        | ((F.col("product_id") < 0) & (F.col("category") == "ECONOMY"))
    ).withColumn("price", promoted.cast("decimal(10,2)"))
    return star.scd2_merge(
        first, incoming, "product_key", "product_id", star.PRODUCT_TRACKED, AS_OF
    )


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _product_versions(spark, sf_dir).withColumn("price", F.col("price").cast("double"))


def _customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.customer_dimension(views.customers(spark, sf_dir), dt.date(1998, 1, 1))


def fact_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = star.keyed_fact(
        _loaded(spark, sf_dir), _product_versions(spark, sf_dir), _customer_versions(spark, sf_dir), NOW
    )
    return _amounts(fact).drop("created_at")


def fact_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = star.keyed_fact(
        _loaded(spark, sf_dir), _product_versions(spark, sf_dir), _customer_versions(spark, sf_dir),
        NOW, point_in_time=True,
    )
    return _amounts(fact).drop("created_at")


# Quality and integrity


def _counts(spark: SparkSession, sf_dir: str, check: str) -> DataFrame:
    parts = [
        quality.counters(table, name, NOW).filter(F.col("check_type") == check)
        .select(F.lit(name).alias("table_name"), "column_name", "metric", "n")
        for name, table in _clean(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir, "not_null_columns")


def dq_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir, "numeric_ranges")


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir, "unique_columns")


def dq_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir, "custom_checks")


def dq_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        quality.log_rows(spark, name, quality.validate(table, name, NOW))
        for name, table in _clean(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def dq_report_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(dq_log(spark, sf_dir))


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gate(dq_log(spark, sf_dir), 0.95)


def constraint_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _clean(spark, sf_dir)
    parts = [integrity.constraint_violations(clean[s.name], s) for s in (SALES, PRODUCTS, CUSTOMERS)]
    return reduce(DataFrame.unionByName, parts)


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales whose product has left the list (promoted parts) or whose customer has (one region)."""
    return integrity.orphan_counts(SALES, {
        "sales": views.sales(spark, sf_dir),
        "products": views.products(spark, sf_dir).filter(F.col("category") != "PROMO"),
        "customers": views.customers(spark, sf_dir).filter(F.col("region") != "ASIA"),
    })


def fk_orphans_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts whose product, customer or date has left its dimension (promoted parts, one region, the nineties)."""
    sales, products, customers = (v(spark, sf_dir) for v in (_loaded, views.products, views.customers))
    parts = star.product_dimension(products, AS_OF)
    buyers = star.customer_dimension(customers, AS_OF)
    return integrity.orphan_counts(FACT_SALES, {
        "fact_sales": star.keyed_fact(sales, parts, buyers, NOW),
        "dim_product": parts.filter(F.col("category") != "PROMO"),
        "dim_customer": buyers.filter(F.col("region") != "ASIA"),
        "dim_date": star.date_dimension(sales).filter(F.col("year") >= 2000),
    })


def fk_orphans_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a log row of its order's run; runs of finished orders are gone."""
    logs = views.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("run_id"))
    runs = views.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "F")
    return integrity.orphan_counts(DATA_QUALITY_LOGS, {
        "data_quality_logs": logs, "pipeline_runs": runs.select(F.col("o_orderkey").alias("run_id")),
    })


# Load and audit


def _store(spark: SparkSession, label: str) -> TableStore:
    return TableStore(spark, scratch_path(spark, label))


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History up to 2000, then a batch from 1998 on with dearer amounts, merged by sale id."""
    staged = pin(views.staged_sales(spark, sf_dir), "staged")
    store = _store(spark, "upsert")
    history = staged.filter(F.col("sale_date") < dt.date(2000, 1, 1))
    store.stage({"sales": store.upsert(SALES, history, "seq", FIRST_LOAD)})
    late = staged.filter(F.col("sale_date") >= dt.date(1998, 1, 1))
    late = late.withColumn("amount", (F.col("amount") + 1).cast("decimal(10,2)"))
    store.stage({"sales": store.upsert(SALES, late, "seq", LATER_LOAD)})
    store.publish(LATER_LOAD)
    return _amounts(TableStore(spark, store.root).read(SALES)).withColumn(
        "created_at", F.to_date("created_at")
    )


def upsert_unique_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, then a profile change with every order; the e-mail has one owner."""
    store = _store(spark, "emails")
    first = pin(views.customers(spark, sf_dir).withColumn("seq", F.col("customer_id")), "customers")
    store.stage({"customers": store.upsert(CUSTOMERS, first, "seq", FIRST_LOAD)})
    changes = views.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.concat(F.lit("Customer of order "), F.col("o_orderkey").cast("string")).alias("customer_name"),
        F.when(F.month("o_orderdate") == 12, F.lit(None)).otherwise(
            F.concat(F.lit("u"), (F.col("o_custkey") + F.month("o_orderdate") % 3).cast("string"),
                     F.lit("@example.org"))
        ).alias("email"),
        F.col("o_orderstatus").alias("region"),
        F.col("o_orderkey").alias("seq"),
    )
    store.stage({"customers": store.upsert(CUSTOMERS, pin(changes, "changes"), "seq", LATER_LOAD)})
    store.publish(LATER_LOAD)
    return TableStore(spark, store.root).read(CUSTOMERS)


# Names in the catalog


def _named(spark: SparkSession, sf_dir: str, report: str) -> DataFrame:
    """A live report, made after a first load, read after another one."""
    staged, database = pin(views.staged_sales(spark, sf_dir), "staged"), f"live_{uuid.uuid4().hex}"
    store = TableStore(spark, scratch_path(spark, "live"), database)
    products = pin(views.products(spark, sf_dir).withColumn("seq", F.col("product_id")), "products")
    customers = views.customers(spark, sf_dir).withColumn("email", F.lit(None).cast("string"))
    customers = pin(customers.withColumn("seq", F.col("customer_id")), "customers")
    history = staged.filter(F.col("sale_date") < dt.date(2000, 1, 1))
    for spec, rows in ((PRODUCTS, products), (CUSTOMERS, customers), (SALES, history)):
        store.stage({spec.name: store.upsert(spec, rows, "seq", FIRST_LOAD)})
    store.publish(FIRST_LOAD)
    store.catalog.view(report, live.REPORTS[report](*(f"{database}.{s.name}" for s in (SALES, PRODUCTS, CUSTOMERS))))
    late = staged.filter(F.col("sale_date") >= dt.date(1998, 1, 1))
    late = late.withColumn("amount", (F.col("amount") + 1).cast("decimal(10,2)"))
    store.stage({SALES.name: store.upsert(SALES, late, "seq", LATER_LOAD)})
    store.publish(LATER_LOAD)
    return spark.table(f"{database}.{report}")


def live_sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir, "sales_summary")


def live_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir, "product_performance")


def live_sales_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(spark, sf_dir, "sales_metrics")


# The load job


_ORDERS_AS_SALES = """
    SELECT o_orderkey AS sale_id, min(l_partkey) AS product_id, o_custkey AS customer_id,
        CAST(sum(l_quantity) AS BIGINT) AS quantity, CAST(min(l_extendedprice) AS DOUBLE) AS amount,
        date_format(o_orderdate, 'yyyy-MM-dd') AS sale_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey, o_orderdate"""


def _job(spark: SparkSession, sf_dir: str) -> tuple[SalesJob, str]:
    """A job that takes sales, one per order, and customers by SQL queries, and its database."""
    for name in ("lineitem", "orders"):
        views.table(spark, sf_dir, name).createOrReplaceTempView(name)
    views.raw_customers(spark, sf_dir).withColumn(
        "customer_name", F.concat(F.lit("c"), F.col("customer_id").cast("string"))
    ).withColumn("email", F.lit(None).cast("string")).createOrReplaceTempView("arriving_customers")
    database = f"job_{uuid.uuid4().hex}"
    return SalesJob(spark, {
        "pipeline_name": "orders", "database": database, "star_schema": False, "gold": False,
        "sources": [
            {"name": "sales", "type": "database", "query": _ORDERS_AS_SALES},
            {"name": "customers", "type": "database", "query": "SELECT * FROM arriving_customers"},
        ],
    }, scratch_path(spark, "job")), database


def job_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales that a whole job has loaded, by name."""
    job, database = _job(spark, sf_dir)
    result = job.run(NOW)
    if not result:
        raise RuntimeError(result.error)
    return _amounts(spark.table(f"{database}.sales")).withColumn("created_at", F.to_date("created_at"))


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs by name: a load, one stopped by its checks, one of an unknown source type, an append of known keys."""
    job, database = _job(spark, sf_dir)
    changes = [
        {}, {"quality_checks": {"threshold": 1.0, "fail_on_error": True}},
        {"sources": [{"name": "sales", "type": "parquetx"}]}, {"destinations": [{"source": "sales", "table": "sales"}]},
    ]
    for hour, change in enumerate(changes):
        SalesJob(spark, {**job.config, **change}, job.root).run(NOW + dt.timedelta(hours=hour))
    runs = spark.table(f"{database}.pipeline_runs")
    return runs.select("run_id", "pipeline_name", "status", "records_processed",
                       F.hour("start_time").alias("started_at"), F.col("error_message").isNotNull().alias("has_error"))


def job_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log rows of two runs of one job by name, with their ids."""
    job, database = _job(spark, sf_dir)
    for hour in range(2):
        SalesJob(spark, job.config, job.root).run(NOW + dt.timedelta(hours=hour))
    return spark.table(f"{database}.data_quality_logs").drop("created_at")


def append_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded sales in two batches without a merge key: before 1998 and after."""
    sales, store, cut = _loaded(spark, sf_dir), _store(spark, "append"), dt.date(1998, 1, 1)
    for batch in (F.col("sale_date") < cut, F.col("sale_date") >= cut):
        store.stage({"sales": store.append(SALES, sales.filter(batch), FIRST_LOAD)})
    store.publish(FIRST_LOAD)
    return _amounts(TableStore(spark, store.root).read(SALES)).drop("created_at")


def staging_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch is all that stays in staging, cut to the columns of the target."""
    root, clean = scratch_path(spark, "staging"), _clean(spark, sf_dir)
    products = clean["products"].select(*PRODUCTS.load_columns)
    write_staging(products.withColumn("price", F.lit(0.0)), root, "products")
    staged, _ = write_staging(products, root, "products")
    return staged


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a run: placed is its start, each shipped line a later event."""
    starts = views.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("pipeline_name"),
        F.lit(audit.STARTED).alias("status"), F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.lit(None).cast("bigint").alias("records_processed"), F.lit(None).cast("string").alias("error_message"),
    )
    names = starts.select("run_id", "pipeline_name")
    failed = F.col("l_returnflag") == "R"
    # Lines of one order and day are one event, so that the latest event is never a tie.
    ends = views.table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_orderkey").alias("run_id"), F.date_add("l_shipdate", 4000).cast("timestamp").alias("event_time")
    ).agg(
        F.max(failed).alias("failed"), F.sum(F.col("l_quantity").cast("bigint")).alias("records_processed")
    ).join(names, "run_id").select(
        "run_id", "pipeline_name", F.when(F.col("failed"), audit.FAILED).otherwise(audit.COMPLETED).alias("status"),
        "event_time", "records_processed",
        F.when(F.col("failed"), "returned").alias("error_message"),
    )
    runs = audit.current_runs(starts.unionByName(ends))
    return runs.withColumns({c: F.to_date(c) for c in ("start_time", "end_time")})


# Sources and sinks


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw products written as CSV and read again: blanks and quotes kept, empty cells null."""
    path = scratch_path(spark, "csv")
    write_csv(views.raw_products(spark, sf_dir), path)
    return typed(read_text_cells(spark, path), {"product_id": "bigint", "price": "double"}).drop(SEQ)


def query_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of a SQL query as a source."""
    views.sales(spark, sf_dir).createOrReplaceTempView("query_source_sales")
    source = {
        "name": "daily", "type": "database",
        "query": "SELECT sale_date, count(*) AS sales, sum(quantity) AS units "
                 "FROM query_source_sales GROUP BY sale_date",
    }
    return extract(spark, [source])["daily"].drop(SEQ)


QUERIES = {
    f.__name__: f
    for f in (
        sales_summary, product_performance, sales_metrics, dynamic_report, data_quality_report,
        monthly_category_top10, preview_products, preview_customers, preview_sales,
        sales_metrics_uncategorised, product_performance_uncategorised,
        loaded_sales_summary, loaded_product_performance, loaded_sales_metrics, loaded_dynamic_report,
        sales_transform, product_transform, customer_transform,
        fact_denormalized, dim_date, holiday_flag, dimension_set, dim_product, dim_customer, scd2_merge, fact_keyed,
        fact_point_in_time,
        dq_not_null, dq_ranges, dq_unique, dq_custom, dq_log, dq_report_summary, dq_gate,
        constraint_check, fk_orphans, fk_orphans_fact, fk_orphans_logs,
        live_sales_summary, live_product_performance, live_sales_metrics, job_load, job_runs, job_logs,
        upsert_merge, upsert_unique_email, append_load, staging_replace, run_history,
        csv_roundtrip, query_source,
    )
}
