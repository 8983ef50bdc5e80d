import datetime as dt
import json

import pytest
from clock import NOW

from tallyloom.operators.audit import AuditLog
from tallyloom.plans import live
from tallyloom.plans.job import SalesJob
from tallyloom.plans.store import TableStore
from tallyloom.schemas import DIM_CUSTOMER, DIM_DATE, DIM_PRODUCT, FACT_SALES, SALES, TABLES
from tallyloom.sources.delimited import SEQ, read_text_cells, typed, write_csv
from tallyloom.sources.folders import claim

SALES_CSV = """sale_id,product_id,customer_id,quantity,sale_date,amount
1,101,201,2,2024-01-01,100.0
2,102,202,1,2024-01-02,50.0
3,103,203,3.0,2024-01-03,150.0
4,101,201,NA,2024-01-04,50.0
5,102,202,2,2024-01-05,
"""
PRODUCTS_CSV = """product_id,product_name,category,price
101,"widget, a",Electronics,50.0
102, widget B ,home,60
103,WIDGET c,None,700.5
"""
CUSTOMERS_CSV = """customer_id,customer_name,email,region
201,john doe,John@GMAIL.com ,north
202,jane o'brien,jane@company.com,south
203,bob,,null
"""


def write_sources(folder, sales=SALES_CSV, products=PRODUCTS_CSV, customers=CUSTOMERS_CSV):
    sources = []
    for name, text in (("sales", sales), ("products", products), ("customers", customers)):
        path = folder / f"{name}.csv"
        path.write_text(text)
        sources.append({"name": name, "type": "csv", "path": str(path)})
    return sources


def append_only(folder, **config):
    """Sales alone, appended: no merge key."""
    return {
        "pipeline_name": "test_load", "sources": write_sources(folder)[:1],
        "destinations": [{"source": "sales", "table": "sales"}], "star_schema": False, "gold": False, **config,
    }


def test_whole_job_twice(spark, tmp_path):
    root = str(tmp_path / "lake")
    feb = "9,101,201,1,2024-02-09,10\n"
    job = SalesJob(spark, {"sources": write_sources(tmp_path, sales=SALES_CSV + feb), "holidays": ["2024-01-01"]}, root)
    result = job.run(NOW)
    assert result and (result.run_id, result.status, result.records) == (1, "COMPLETED", 12)
    store = TableStore(spark, root)
    rows = {r.sale_id: (r.quantity, float(r.amount), str(r.sale_date)) for r in store.read(SALES).collect()}
    assert rows == {1: (2, 100.0, "2024-01-01"), 2: (1, 50.0, "2024-01-02"), 3: (3, 150.0, "2024-01-03"),
                    4: (0, 50.0, "2024-01-04"), 5: (2, 0.0, "2024-01-05"), 9: (1, 10.0, "2024-02-09")}
    names = {r.product_name: r.category for r in spark.table("products").collect()}
    assert names == {"Widget, A": "ELECTRONICS", "Widget B": "HOME", "Widget C": "UNCATEGORIZED"}
    assert {(r.email, r.region) for r in spark.table("customers").collect()} == {
        ("john@gmail.com", "NORTH"), ("jane@company.com", "SOUTH"), (None, "UNKNOWN")}
    facts = {(r.sales_key, r.product_key, r.date_key) for r in store.read(FACT_SALES).collect()}
    assert facts == {(1, 1, 20240101), (2, 2, 20240102), (3, 3, 20240103), (4, 1, 20240104), (5, 2, 20240105), (6, 1, 20240209)}
    assert [r.date_key for r in spark.table("dim_date").filter("is_holiday").collect()] == [20240101]
    assert not result.quality["sales"]["custom_checks"].passed  # sale 5: quantity without amount
    logs = AuditLog(spark, root).logs().collect()
    assert sorted(r.log_id for r in logs) == list(range(1, 19)) and {r.run_id for r in logs} == {1}
    details = {(r.table_name, r.check_type): json.loads(r.details) for r in logs}
    assert details["customers", "custom_checks"] == {"issues": ["1 customers have invalid email formats"]}

    # the next day a product is dearer and a customer has moved
    write_sources(tmp_path, sales="sale_id,product_id,customer_id,quantity,sale_date,amount\n5,103,203,2,2024-01-05,9\n",
                  products="product_id,product_name,category,price\n101,widget a,Electronics,51\n",
                  customers="customer_id,customer_name,email,region\n203,bob,bob@corp.com,west\n")
    later = NOW + dt.timedelta(days=1)
    result = SalesJob(spark, {"sources": job.config["sources"]}, root).run(later)
    assert (result.run_id, result.records) == (2, 3)
    store = TableStore(spark, root)
    assert {(r.sale_id, float(r.amount), r.created_at) for r in store.read(SALES).collect() if r.sale_id > 3} == {
        (4, 50.0, NOW), (5, 9.0, later), (9, 10.0, NOW)}
    # January has changed: its facts have new keys and point at the new version of product 101
    facts = {(r.sales_key, r.product_key, r.date_key) for r in store.read(FACT_SALES).collect()}
    assert facts == {(7, 4, 20240101), (8, 2, 20240102), (9, 3, 20240103), (10, 4, 20240104), (11, 3, 20240105), (6, 1, 20240209)}
    assert store.read(DIM_DATE).count() == 6
    versions = {(r.product_key, r.product_id, float(r.price), r.is_current) for r in store.read(DIM_PRODUCT).collect()}
    assert versions == {(1, 101, 50.0, False), (2, 102, 60.0, True), (3, 103, 700.5, True), (4, 101, 51.0, True)}
    assert store.read(DIM_CUSTOMER).filter("is_current").count() == 3
    runs = AuditLog(spark, root).runs().orderBy("run_id").collect()
    assert [(r.run_id, r.status, r.start_time, r.end_time, r.records_processed) for r in runs] == [
        (1, "COMPLETED", NOW, NOW, 12), (2, "COMPLETED", later, later, 3)]
    gold = spark.read.parquet(f"{root}/gold/sales_summary")
    assert gold.count() == 4 and "total_revenue" in gold.columns
    assert spark.sql("SELECT sum(transactions) FROM monthly_category_top10").first()[0] == 6
    assert spark.sql("SELECT count(*) FROM pipeline_runs JOIN data_quality_logs USING (run_id)").first()[0] == 36
    assert spark.table("stg_sales").columns == ["sale_id", "product_id", "customer_id", "quantity", "amount", "sale_date", SEQ]


def test_another_session_reads_tables_and_live_reports(spark, tmp_path):
    """All by name, as of the last load, also those of a store attached anew."""
    root, other = str(tmp_path / "lake"), spark.newSession()
    config = {"sources": write_sources(tmp_path), "database": "shop"}
    assert SalesJob(spark, config, root).run(NOW)
    counts = {name: other.table(f"shop.{name}").count() for name in TABLES}
    assert counts == {
        "sales": 5, "products": 3, "customers": 3, "stg_sales": 5, "dim_product": 3, "dim_customer": 3, "dim_date": 5,
        "fact_sales": 5, "pipeline_runs": 1, "data_quality_logs": 18}
    for name, spec in TABLES.items():
        if name != "stg_sales":
            assert [(f.name, f.dataType) for f in other.table(f"shop.{name}").schema] == [
                (f.name, f.dataType) for f in spec.schema]
    first = {name: other.table(f"shop.{name}").collect() for name in live.REPORTS}
    ranks = other.sql("SELECT product_id, overall_rank FROM shop.product_performance").collect()
    assert sorted(map(tuple, ranks)) == [(101, 1), (102, 3), (103, 1)]

    write_sources(tmp_path, sales="sale_id,product_id,customer_id,quantity,sale_date,amount\n6,102,203,2,2024-03-05,900\n")
    assert SalesJob(spark, config, root).run(NOW)
    assert other.table("shop.sales").count() == 6 and other.table("shop.pipeline_runs").count() == 2
    assert other.table("shop.data_quality_logs").agg({"run_id": "max"}).first()[0] == 2
    for name, before in first.items():
        assert other.table(f"shop.{name}").collect() != before, name
    ranks = other.sql("SELECT product_id, overall_rank FROM shop.product_performance").collect()
    assert sorted(map(tuple, ranks)) == [(101, 2), (102, 1), (103, 2)]

    # A failed load changes no name; a store of the same folder finds the published state in another database.
    write_sources(tmp_path, customers=CUSTOMERS_CSV + "204,,x@y.z,east\n")
    assert not SalesJob(spark, config, root).run(NOW)
    assert other.table("shop.sales").count() == 6 and other.table("shop.pipeline_runs").count() == 3
    TableStore(spark, root, "again").register()
    assert other.table("again.sales").count() == 6 and other.table("again.dim_product").count() == 3
    for database in ("shop", "again"):
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_append_job_and_collision(spark, tmp_path):
    root = str(tmp_path / "lake")
    config = append_only(tmp_path)
    first = SalesJob(spark, config, root).run(NOW)
    assert first and first.records == 5
    second = SalesJob(spark, config, root).run(NOW)
    assert not second and second.records == 0 and "stored already" in second.error
    assert TableStore(spark, root).read(SALES).count() == 5
    run = AuditLog(spark, root).runs().orderBy("run_id").collect()[1]
    assert (run.status, run.records_processed) == ("FAILED", 0) and "stored already" in run.error_message


def test_two_jobs_never_share_an_id(spark, tmp_path):
    """Both have looked at the ids before either takes one; those of a batch may lie apart."""
    one, other = AuditLog(spark, str(tmp_path)), AuditLog(spark, str(tmp_path))
    rows = spark.createDataFrame([("t", "c", True, "{}")] * 3, "table_name string, check_type string, check_result boolean, details string")
    ids = [log.start(name, NOW) for log, name in ((one, "a"), (other, "b"), (other, "b"), (one, "a"))]
    assert ids == [1, 2, 3, 4]
    for log, run in ((one, 1), (other, 2), (one, 1)):
        log.log_checks(run, rows, NOW)
    assert sorted((r.log_id, r.run_id) for r in other.logs().collect()) == [
        (1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (6, 2), (7, 1), (8, 1), (9, 1)]
    assert claim(spark, f"{tmp_path}/audit/ids/run_id/5") and not claim(spark, f"{tmp_path}/audit/ids/run_id/5")
    assert one.start("a", NOW) == 6
    one.end(2, "b", "FAILED", 0, NOW, "late")
    assert {r.run_id: r.status for r in one.runs().collect()} == {1: "STARTED", 2: "FAILED", 3: "STARTED", 4: "STARTED", 6: "STARTED"}


def test_stages(spark, tmp_path):
    job = SalesJob(spark, append_only(tmp_path), str(tmp_path / "lake"))
    extracted = job.extract()
    assert list(extracted) == ["sales"] and extracted["sales"].count() == 5
    assert {"year", "price_per_unit"} <= set(job.transform(extracted, NOW)["sales"].columns)


@pytest.mark.parametrize("change, message", [
    ({"sources": [{"name": "sales", "type": "parquetx", "path": "x"}]}, "no such kind of source: parquetx"),
    ({"sources": [{"name": "sales", "type": "csv", "path": "/nowhere.csv"}]}, "nowhere.csv"),
    ({"destinations": [{"source": "sales", "table": "sales", "merge_key": "amount"}]}, "merges on sale_id"),
    ({"quality_checks": {"threshold": 0.95, "fail_on_error": True}}, "5/6 checks passed"),
])
def test_failures_are_recorded(spark, tmp_path, change, message):
    root = str(tmp_path / "lake")
    result = SalesJob(spark, append_only(tmp_path, **change), root).run(NOW)
    assert not result and message in result.error
    run = AuditLog(spark, root).runs().first()
    assert (run.status, run.records_processed) == ("FAILED", 0) and message in run.error_message
    assert TableStore(spark, root).read(SALES).count() == 0


@pytest.mark.parametrize("row", ["1,101,201,2,2024-13-01,1.0", "1,101,201,2.5,2024-01-01,1.0", "1,101,201,2,2024-01-01,abc"])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_cells_fail_the_run(spark, tmp_path, row, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    config = append_only(tmp_path)
    (tmp_path / "sales.csv").write_text("sale_id,product_id,customer_id,quantity,sale_date,amount\n" + row + "\n")
    root = str(tmp_path / "lake")
    try:
        assert not SalesJob(spark, config, root).run(NOW)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert AuditLog(spark, root).runs().first().status == "FAILED"


def test_a_late_failure_publishes_nothing(spark, tmp_path):
    root = str(tmp_path / "lake")
    sources = write_sources(tmp_path, customers=CUSTOMERS_CSV + "204,,x@y.z,east\n")
    result = SalesJob(spark, {"sources": sources}, root).run(NOW)
    assert not result and "not_null customers.customer_name: 1 rows" in result.error
    assert TableStore(spark, root).read(SALES).count() == 0


def test_failing_reports_leave_the_load(spark, tmp_path, monkeypatch):
    def broken(self):
        raise RuntimeError("no report today")

    monkeypatch.setattr(SalesJob, "reports", broken)
    root = str(tmp_path / "lake")
    result = SalesJob(spark, {"sources": write_sources(tmp_path)}, root).run(NOW)
    assert (result.status, result.records, result.gold_error) == ("COMPLETED", 11, "no report today")
    run = AuditLog(spark, root).runs().first()
    assert (run.status, run.records_processed) == ("COMPLETED", 11)
    assert TableStore(spark, root).read(SALES).count() == 5


def test_a_sale_without_a_date_is_loaded(spark, tmp_path):
    root = str(tmp_path / "lake")
    result = SalesJob(spark, {"sources": write_sources(tmp_path, sales=SALES_CSV + "6,101,201,1,,10\n")}, root).run(NOW)
    assert (result.status, result.records, result.undated_sales, result.gold_error) == ("COMPLETED", 12, 1, None)
    store = TableStore(spark, root)
    assert store.read(SALES).filter("sale_date IS NULL").count() == 1
    assert store.read(FACT_SALES).count() == 5 and store.read(DIM_DATE).count() == 5


def test_any_source_to_any_table(spark, tmp_path):
    root = str(tmp_path / "lake")
    path = tmp_path / "returns.csv"
    config = {
        "sources": [{"name": "returns", "type": "csv", "path": str(path)}], "star_schema": False, "gold": False,
        "destinations": [{"source": "returns", "table": "returns"}],
    }
    path.write_text("return_id,reason,refund,open,empty\n1,late,2.5,true,\n2,7,3,FALSE,\n")
    assert SalesJob(spark, config, root).run(NOW).records == 2
    path.write_text("return_id,reason,refund,open,empty\n2,late,4.5,true,x\n")
    assert SalesJob(spark, config, root).run(NOW).records == 1
    table = spark.table("returns")
    assert dict(table.dtypes) == {
        "return_id": "bigint", "reason": "string", "refund": "double", "open": "boolean", "empty": "string"}
    assert sorted((r.return_id, r.reason, r.refund, r.open, r.empty) for r in table.collect()) == [
        (1, "late", 2.5, True, None), (2, "7", 3.0, False, None), (2, "late", 4.5, True, "x")]
    path.write_text("return_id,reason\n3,late\n")
    assert "has the columns" in SalesJob(spark, config, root).run(NOW).error


def test_absent_sources_and_query_sources(spark, tmp_path):
    root = str(tmp_path / "lake")
    SalesJob(spark, append_only(tmp_path), root).run(NOW)
    query = "SELECT sale_id + 100 AS sale_id, product_id, customer_id, quantity, amount, sale_date FROM sales"
    config = append_only(tmp_path, sources=[{"name": "sales", "type": "database", "query": query}],
                         destinations=[{"source": "sales", "table": "sales"}, {"source": "gone", "table": "products"}])
    result = SalesJob(spark, config, root).run(NOW)
    assert result and result.records == 5
    assert sorted(r.sale_id for r in TableStore(spark, root).read(SALES).collect()) == [1, 2, 3, 4, 5, 101, 102, 103, 104, 105]


def test_null_tokens_and_arrival_order(spark, tmp_path):
    for i, cells in enumerate((["", "NA", "NULL"], ["null", "n/a", "None", "nan"], ["-", '"a ""b"""', " x "])):
        (tmp_path / f"{i}.csv").write_text("n,t\n" + "".join(f"{j},{c}\n" for j, c in enumerate(cells)))
    cells = read_text_cells(spark, str(tmp_path)).orderBy(SEQ)
    assert [r.t for r in cells.collect()] == [None] * 7 + ["-", 'a "b"', " x "]
    assert [r.n for r in typed(cells, {"n": "bigint"}).orderBy(SEQ).collect()] == [0, 1, 2, 0, 1, 2, 3, 0, 1, 2]


def test_delimiter_and_column_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b;a\n1;2\n")
    row = read_text_cells(spark, str(tmp_path / "a.csv"), delimiter=";").first()
    assert (row.a, row.b) == ("2", "1")


def test_csv_sink(spark, tmp_path, customers):
    path = str(tmp_path / "out")
    write_csv(customers, path)
    assert sorted(tuple(r) for r in spark.read.option("header", True).csv(path).collect()) == sorted(
        tuple(str(v) for v in r) for r in customers.collect())
