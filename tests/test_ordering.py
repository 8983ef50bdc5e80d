import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.operators.ordering import add_dense_key, add_ranks


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = [
        # a third of all rows share one value, another part has none
        (i, rng.choice(["a", "a", "a", "b", None]), rng.choice([7, 7, None, rng.randint(0, 400)]))
        for i in range(3000)
    ]
    return spark.createDataFrame(rows, "id bigint, grp string, value bigint").cache()


def plain_ranks(df):
    order = F.col("value").desc_nulls_last()
    return df.withColumn("in_group", F.rank().over(Window.partitionBy("grp").orderBy(order))).withColumn(
        "overall", F.rank().over(Window.orderBy(order)))


def test_ranks_agree_with_the_plain_window(table):
    got = add_ranks(table, "value", {"in_group": "grp", "overall": None})
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(plain_ranks(table).collect(), key=lambda r: r.id)


def test_ranks_of_ties_and_nulls(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (3,)], "value int")
    got = sorted((r.value or 0, r.rank) for r in add_ranks(df, "value", {"rank": None}).collect())
    assert got == [(0, 4), (1, 3), (3, 1), (3, 1)]


def test_dense_key(table):
    keyed = add_dense_key(table, "key", ["id"], start=10)
    assert [(r.key, r.id) for r in keyed.orderBy("key").collect()] == [(i + 11, i) for i in range(3000)]


def test_dense_key_spreads_a_hot_order_key(spark, table):
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # it would join these few rows again
    keyed = add_dense_key(table.withColumn("hot", F.lit(1)), "key", ["hot"])
    spark.conf.unset(coalesce)
    parts = keyed.groupBy(F.input_file_name()).count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 2000
    assert sorted(r.key for r in keyed.collect()) == list(range(1, 3001))


def test_no_rows_are_gathered_in_one_partition(table, capsys):
    add_ranks(table, "value", {"in_group": "grp", "overall": None}).explain()
    add_dense_key(table, "key", ["id"]).explain()
    assert "SinglePartition" not in capsys.readouterr().out


def test_empty_table(spark):
    empty = spark.createDataFrame([], "value int")
    assert add_ranks(empty, "value", {"rank": None}).collect() == []
    assert add_dense_key(empty, "key", ["value"]).collect() == []
