"""Schemas, keys and references of every stored table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)


@dataclass(frozen=True)
class Reference:
    column: str
    table: str
    key: str


@dataclass(frozen=True)
class TableSpec:
    """One stored table.

    ``slice_date`` names the column, a date or a yyyymmdd key, whose month splits the stored files,
    so that a load rewrites only the months it touches. A table without a primary key is only appended to.
    ``digest_of`` names the columns of which the stored files keep a digest, besides the table's columns.
    """

    name: str
    schema: T.StructType
    primary_key: str | None
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    default_now: tuple[str, ...] = ()
    slice_date: str | None = None
    digest_of: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def keys(self) -> list[str]:
        """Columns that hold no value twice."""
        return [c for c in (self.primary_key, *self.unique) if c is not None]

    @property
    def load_columns(self) -> list[str]:
        """What a source delivers: every column but those filled in by default."""
        return [c for c in self.columns if c not in self.default_now]


_ID, _COUNT, _INT, _TEXT = T.LongType(), T.LongType(), T.IntegerType(), T.StringType()
_DATE, _TIME, _FLAG = T.DateType(), T.TimestampType(), T.BooleanType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


PRODUCTS = TableSpec(
    "products",
    _schema(
        product_id=_ID, product_name=_TEXT, category=_TEXT, price=MONEY,
    ),
    primary_key="product_id",
    not_null=("product_name",),
)

CUSTOMERS = TableSpec(
    "customers",
    _schema(
        customer_id=_ID, customer_name=_TEXT, email=_TEXT, region=_TEXT,
    ),
    primary_key="customer_id",
    unique=("email",),
    not_null=("customer_name",),
)

SALES = TableSpec(
    "sales",
    _schema(
        sale_id=_ID, product_id=_ID, customer_id=_ID, quantity=_COUNT, amount=MONEY,
        sale_date=_DATE, created_at=_TIME,
    ),
    primary_key="sale_id",
    references=(
        Reference("product_id", "products", "product_id"),
        Reference("customer_id", "customers", "customer_id"),
    ),
    default_now=("created_at",),
    slice_date="sale_date",
)

STG_SALES = TableSpec(
    "stg_sales",
    _schema(
        sale_id=_ID, product_id=_ID, customer_id=_ID, quantity=_COUNT, amount=MONEY,
        sale_date=_DATE, load_timestamp=_TIME,
    ),
    primary_key="sale_id",
    default_now=("load_timestamp",),
)

DIM_PRODUCT = TableSpec(
    "dim_product",
    _schema(
        product_key=_ID, product_id=_ID, product_name=_TEXT, category=_TEXT, price=MONEY,
        effective_date=_DATE, end_date=_DATE, is_current=_FLAG,
    ),
    primary_key="product_key",
    digest_of=("product_name", "category", "price"),
)

DIM_CUSTOMER = TableSpec(
    "dim_customer",
    _schema(
        customer_key=_ID, customer_id=_ID, customer_name=_TEXT, email=_TEXT, region=_TEXT,
        effective_date=_DATE, end_date=_DATE, is_current=_FLAG,
    ),
    primary_key="customer_key",
    digest_of=("customer_name", "email", "region"),
)

DIM_DATE = TableSpec(
    "dim_date",
    _schema(
        date_key=_INT, full_date=_DATE, year=_INT, quarter=_INT, month=_INT, day=_INT,
        day_of_week=_INT, is_weekend=_FLAG, is_holiday=_FLAG,
    ),
    primary_key="date_key",
)

FACT_SALES = TableSpec(
    "fact_sales",
    _schema(
        sales_key=_ID, product_key=_ID, customer_key=_ID, date_key=_INT, quantity=_COUNT,
        amount=MONEY, created_at=_TIME,
    ),
    primary_key="sales_key",
    references=(
        Reference("product_key", "dim_product", "product_key"),
        Reference("customer_key", "dim_customer", "customer_key"),
        Reference("date_key", "dim_date", "date_key"),
    ),
    default_now=("created_at",),
    slice_date="date_key",
)

PIPELINE_RUNS = TableSpec(
    "pipeline_runs",
    _schema(
        run_id=_ID, pipeline_name=_TEXT, status=_TEXT, start_time=_TIME, end_time=_TIME,
        records_processed=_COUNT, error_message=_TEXT,
    ),
    primary_key="run_id",
)

DATA_QUALITY_LOGS = TableSpec(
    "data_quality_logs",
    _schema(
        log_id=_ID, run_id=_ID, table_name=_TEXT, check_type=_TEXT, check_result=_FLAG,
        details=_TEXT, created_at=_TIME,
    ),
    primary_key="log_id",
    references=(Reference("run_id", "pipeline_runs", "run_id"),),
    default_now=("created_at",),
)

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        PRODUCTS, CUSTOMERS, SALES, STG_SALES, DIM_PRODUCT, DIM_CUSTOMER, DIM_DATE,
        FACT_SALES, PIPELINE_RUNS, DATA_QUALITY_LOGS,
    )
}

# Types a source's raw text columns are cast to; columns not named here stay text.
SOURCE_TYPES: dict[str, dict[str, str]] = {
    "sales": {
        "sale_id": "bigint", "product_id": "bigint", "customer_id": "bigint",
        "quantity": "bigint", "amount": "double",
    },
    "products": {"product_id": "bigint", "price": "double"},
    "customers": {"customer_id": "bigint"},
}
