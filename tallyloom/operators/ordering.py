"""Dense keys and ranks over tables of any size.

A window without partition columns, or one over a hot group, puts all its rows into one task.

For dense keys the rows are range-partitioned instead, numbered inside each partition, and shifted by the
size of the partitions before; only one number per partition reaches the driver. Ranks are of whole numbers:
equal values are one row each, and are counted at three levels by the upper bits of the value, so that no window
holds more than 2^22 rows, whatever the table. That is one lazy plan, told as SQL, which views can hold too.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.scratch import pin

_PART_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _offsets(sized: DataFrame, size: Column) -> DataFrame:
    """(_part, _before): total size of the partitions before each one.

    The rows are as many as the range exchange had partitions, so they fit any broadcast.
    """
    sizes = sized.groupBy("_part").agg(size.alias("_size")).orderBy("_part").collect()
    before = accumulate((row["_size"] for row in sizes), initial=0)
    rows = [(row["_part"], start) for row, start in zip(sizes, before)]
    return F.broadcast(sized.sparkSession.createDataFrame(rows, "_part bigint, _before bigint"))


def add_dense_key(df: DataFrame, key: str, order: list[str], start: int = 0) -> DataFrame:
    """Number the rows ``start + 1, start + 2, ...`` in the given order.

    Rows alike in ``order`` follow by the hash of the whole row, so that a key which many rows
    share, or lack, is still spread over several partitions.
    """
    row_id = F.monotonically_increasing_id()
    spread = df.orderBy(*order, F.xxhash64(*df.columns))
    ordered = pin(spread.withColumn("_row", row_id), "ordered")
    placed = ordered.withColumn("_part", F.shiftright("_row", _PART_BITS))
    within = F.col("_row").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    return placed.join(_offsets(placed, F.count("*")), "_part").select(
        (F.lit(start + 1) + F.col("_before") + within).alias(key), *df.columns
    )


_LEAST = "-9223372036854775808L"
_STEP = 22  # bits of a value that a window orders


def ranked_sql(rows: str, value: str, ranks: Mapping[str, str | None]) -> str:
    """SQL for all columns of ``rows``, a table or CTE, and the ranks of ``add_ranks``. No job runs for it."""
    joined, columns = "", ["r.*"]
    for at, (rank, group) in enumerate(ranks.items()):
        side = f"k{at}"
        same = f"r.{group} <=> {side}.g AND " if group else ""
        joined += f" JOIN ({_positions_sql(rows, value, group)}) {side}"
        joined += f" ON {same}coalesce(r.{value}, {_LEAST}) = {side}.v"
        columns.append(f"{side}.position AS {rank}")
    return f"SELECT {', '.join(columns)} FROM {rows} r{joined}"


def _positions_sql(rows: str, value: str, group: str | None) -> str:
    """(g, v, position) of every distinct value of a group; null is the least value."""
    key, by, same = (f"{group} AS g, ", "g, ", "{0}.g <=> {1}.g AND ") if group else ("", "", "")
    # Not foldable, else the optimizer would take the last window for one over everything.
    top = "g" if group else "pmod(v, 1)"

    def before(source: str, within: str) -> str:
        rest = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        return (
            f"SELECT *, coalesce(sum(n) OVER (PARTITION BY {within} ORDER BY v DESC {rest}), 0L) AS earlier"
            f" FROM ({source})"
        )

    one = f"SELECT {key}coalesce({value}, {_LEAST}) AS v, count(*) AS n FROM {rows} GROUP BY ALL"
    two, three = (
        f"SELECT {by}shiftright(v, {bits}) AS v, sum(n) AS n FROM ({one}) GROUP BY ALL" for bits in (_STEP, 2 * _STEP)
    )
    up = f"shiftright(v, {_STEP})"
    return (
        f"SELECT {'a.g, ' if group else ''}a.v, CAST(1 + a.earlier + b.earlier + c.earlier AS INT) AS position"
        f" FROM ({before(one, by + up)}) a JOIN ({before(two, by + up)}) b"
        f" ON {same.format('a', 'b')}shiftright(a.v, {_STEP}) = b.v"
        f" JOIN ({before(three, top)}) c ON {same.format('b', 'c')}shiftright(b.v, {_STEP}) = c.v"
    )


def add_ranks(df: DataFrame, value: str, ranks: Mapping[str, str | None]) -> DataFrame:
    """Competition ranks (1, 2, 2, 4) by the whole number ``value`` descending, nulls last, ties share a rank.

    ``ranks`` maps each rank column to the group column it restarts in, or to None for one rank
    over the whole table. ``df`` should be a stored table, as every rank reads it.
    """
    wide = df.withColumn(value, F.col(value).cast("bigint"))
    return df.sparkSession.sql(ranked_sql("{ranked_rows}", value, ranks), ranked_rows=wide)
