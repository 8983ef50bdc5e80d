import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "tests", 8, **{"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [(1, 101, 201, 2, 100.0, "2024-01-01"), (2, 102, 202, 1, 50.0, "2024-01-02"),
         (3, 103, 203, 3, 150.0, "2024-01-03")],
        "sale_id bigint, product_id bigint, customer_id bigint, quantity bigint, amount double, sale_date string",
    )


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [(101, "Widget A", "Electronics", 50.0), (102, "Widget B", "Home", 50.0),
         (103, "Widget C", "Electronics", 50.0)],
        "product_id bigint, product_name string, category string, price double",
    )


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(
        [(201, "John Doe", "john@gmail.com", "North"), (202, "Jane Smith", "jane@company.com", "South"),
         (203, "Bob Johnson", "bob@yahoo.com", "East")],
        "customer_id bigint, customer_name string, email string, region string",
    )
