"""Shards that all have the mixture of the whole, by proportional stratified interleaving.

Within each source, rows are ranked in a seeded random order; row r of n stands at (r + u) / n,
with u an offset of the source's own. Sorted by that fraction, any stretch of rows has every
source in proportion. The sorted rows are cut into shards whose counts differ by one at most.

Ranks come from windows over slices of the random order, and positions from slices of the
fraction, so no source, however large, is ranked by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.workspace import Workspace, running_total, slice_of, slices_of


def unit(hex_digest: Column) -> Column:
    """A number in (0, 1) from the first 28 bits of a hex digest."""
    return (F.conv(F.substring(hex_digest, 1, 7), 16, 10).cast("long") + 0.5) / float(1 << 28)


def interleave(
    docs: DataFrame, shards: int, seed: str = "shard", id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1. The law is ``rows``: counts of shards differ by one at
    most, slots count from 0 without gaps, and sizes and sources follow the whole as closely as the
    interleaving lets them. ``grown_shard``, which belongs to another law, is null. Equal texts are
    rows like others and not kept together.

    - A null text has size 1 and a null checksum; a null source is a source of its own.
    - A null id is ordered by its text alone. Repeated rows are all placed, each in its own slot.
    - With fewer rows than shards some shards are empty. An empty table gives an empty table.
    """
    space = Workspace(docs.sparkSession)
    text = F.col(text_col).cast("binary")
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.md5(text))))
    rows = space.pin(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), key.alias("key"),
    ), "rows")
    total = rows.count()
    tie = [F.col("key"), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    sliced = rows.withColumn("part", slice_of(F.col("key"), total))
    ranked = running_total(sliced, ["source"], "part", tie, F.lit(1), "rank")
    counts = rows.groupBy("source").agg(F.count("*").alias("n")).withColumnRenamed("source", "_source")
    offset = unit(F.md5(F.concat_ws("|", F.lit(seed), F.coalesce("source", F.lit("")))))
    placed = ranked.join(counts, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "place", (F.col("rank") + offset) / F.col("n")
    )
    placed = placed.withColumn("part", F.floor(F.col("place") * slices_of(total))).drop("rank", "n", "_source")
    placed = space.pin(placed, "placed")
    space.drop(rows)
    order = [F.col("place"), F.col("source").asc_nulls_last(), *tie]
    numbered = running_total(placed, [], "part", order, F.lit(1), "position")
    shard = F.expr(f"position * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return numbered.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("position") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source",
    )
