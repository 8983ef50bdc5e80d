import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.integrity import ConstraintViolation
from tallyloom.operators.merge import survivors
from tallyloom.plans.store import TableStore, write_staging
from tallyloom.schemas import CUSTOMERS, DIM_DATE, SALES

OLD, NEW = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
CUSTOMER_DDL = "customer_id bigint, customer_name string, email string, region string, seq bigint"
SALES_DDL = "sale_id bigint, product_id bigint, customer_id bigint, quantity bigint, amount string, sale_date date, seq bigint"


def replay(stored: list[tuple], batch: list[tuple]) -> set[tuple]:
    """One row after the other: each removes the rows sharing its key or its e-mail."""
    rows = list(stored)
    for row in batch:
        rows = [r for r in rows if r[0] != row[0] and (row[2] is None or r[2] != row[2])]
        rows.append(row)
    return set(rows)


def customers_of(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], CUSTOMER_DDL)


def sales_of(spark, rows):
    """(id, amount, date) as staged sales."""
    staged = spark.createDataFrame([(i, 1, 2, 3, a, d, s) for s, (i, a, d) in enumerate(rows)], SALES_DDL)
    return staged.withColumn("amount", F.col("amount").cast("decimal(10,2)"))


def held(store, spec=SALES):
    return sorted((r.sale_id, float(r.amount), r.sale_date, r.created_at) for r in store.read(spec).collect())


@pytest.mark.parametrize("seed", range(5))
def test_customers_agree_with_row_by_row_replay(spark, tmp_path, seed):
    rng = random.Random(seed)

    def batch(n):
        return [(rng.randint(1, 9), f"name{i}", rng.choice([None, "a", "b", "c", "d", "e"]), f"r{i}") for i in range(n)]

    store = TableStore(spark, str(tmp_path))
    expected: set[tuple] = set()
    for size in (6, 14):
        rows = batch(size)
        expected = replay(sorted(expected, key=str), rows)
        store.stage({"customers": store.upsert(CUSTOMERS, customers_of(spark, rows), "seq", NEW)})
    assert {tuple(r) for r in store.read(CUSTOMERS).collect()} == expected


def test_a_new_owner_of_an_email_removes_the_old_one(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    first = customers_of(spark, [(1, "a", "e1", "r"), (2, "b", "e2", "r")])
    store.stage({"customers": store.upsert(CUSTOMERS, first, "seq", OLD)})
    second = customers_of(spark, [(3, "c", "e1", "r"), (2, "b2", "e9", "r"), (2, "b3", "e8", "r")])
    store.stage({"customers": store.upsert(CUSTOMERS, second, "seq", NEW)})
    assert {tuple(r) for r in store.read(CUSTOMERS).collect()} == {(2, "b3", "e8", "r"), (3, "c", "e1", "r")}


def test_a_hot_key_and_a_hot_email(spark):
    rows = [(i % 3000 if i % 3 else 1, f"n{i}", "hot@x" if i % 3 == 1 else None, "r") for i in range(9000)]
    got = {tuple(r)[:4] for r in survivors(customers_of(spark, rows), "customer_id", ("email",), "seq").collect()}
    assert got == replay([], rows)


def test_repeated_keys_are_cut_before_the_shuffle(spark, capsys):
    survivors(customers_of(spark, [(1, "a", "e", "r")]), "customer_id", ("email",), "seq").explain()
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan and "partial_max(seq" in plan


def test_missing_key_or_name_aborts(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for row in ((None, "n", "e", "r"), (1, None, "e", "r")):
        with pytest.raises(ConstraintViolation):
            store.upsert(CUSTOMERS, customers_of(spark, [row]), "seq", NEW)
    assert store.read(CUSTOMERS).collect() == []


JAN, FEB, MAR = dt.date(2024, 1, 5), dt.date(2024, 2, 5), dt.date(2024, 3, 5)


def test_only_touched_months_are_rewritten(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    first = sales_of(spark, [(1, "1", JAN), (2, "2", FEB), (3, "3", MAR), (4, "4", None)])
    store.stage({"sales": store.upsert(SALES, first, "seq", OLD)})
    before = dict(store._slices["sales"])
    # sale 2 moves from February to January; March and the undated sale are not touched
    store.stage({"sales": store.upsert(SALES, sales_of(spark, [(2, "9", JAN)]), "seq", NEW)})
    after = store._slices["sales"]
    assert after["2024-03"] == before["2024-03"] and after["none"] == before["none"]
    assert after["2024-01"] != before["2024-01"] and "2024-02" not in after
    assert held(store)[:2] == [(1, 1.0, JAN, OLD), (2, 9.0, JAN, NEW)]
    assert len(held(store)) == 4


def test_appended_batches_take_part_in_later_upserts(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for rows in ([(1, "1", JAN), (2, "2", FEB)], [(3, "3", JAN), (4, "4", FEB)]):
        store.stage({"sales": store.append(SALES, sales_of(spark, rows).drop("seq"), OLD)})
    store.stage({"sales": store.upsert(SALES, sales_of(spark, [(3, "7", JAN)]), "seq", NEW)})
    assert held(store) == [(1, 1.0, JAN, OLD), (2, 2.0, FEB, OLD), (3, 7.0, JAN, NEW), (4, 4.0, FEB, OLD)]


def test_append_refuses_known_and_repeated_keys(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = sales_of(spark, [(1, "1", JAN)]).drop("seq")
    store.stage({"sales": store.append(SALES, rows, OLD)})
    with pytest.raises(ConstraintViolation, match="is stored already"):
        store.append(SALES, rows, NEW)
    with pytest.raises(ConstraintViolation, match="repeats in the batch"):
        store.append(SALES, sales_of(spark, [(5, "1", JAN)] * 2).drop("seq"), NEW)


def test_readers_see_a_load_only_when_it_is_published(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.stage({"sales": store.upsert(SALES, sales_of(spark, [(1, "1", JAN)]), "seq", OLD)})
    assert TableStore(spark, str(tmp_path)).read(SALES).count() == 0
    store.publish(OLD)
    assert TableStore(spark, str(tmp_path)).read(SALES).count() == 1
    store.stage({"sales": store.upsert(SALES, sales_of(spark, [(2, "1", JAN)]), "seq", NEW)})
    assert store.read(SALES).count() == 2
    store.discard()
    assert store.read(SALES).count() == 1
    assert store.version == TableStore(spark, str(tmp_path)).version == 1


def test_tables_exist_before_any_load(spark, tmp_path):
    TableStore(spark, str(tmp_path)).register()
    assert spark.table("dim_date").schema == DIM_DATE.schema
    assert spark.sql("SELECT count(*) FROM sales JOIN products USING (product_id)").first()[0] == 0


def test_staging_keeps_the_last_batch(spark, tmp_path, products):
    write_staging(products, str(tmp_path), "products")
    staged, rows = write_staging(products.limit(1).select("product_id"), str(tmp_path), "products")
    assert (rows, staged.columns, staged.count()) == (1, ["product_id"], 1)
