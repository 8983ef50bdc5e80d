"""Mixing of sources to target weights along a low-discrepancy schedule.

Every source is a stream of its texts in a seeded random order, repeated in another order for a
second epoch, and cut into blocks of equally many words; a text may lie across blocks. The points
of the van der Corput sequence, mapped through the cumulated block counts of the sources, tell slot
by slot which source comes next; slots are ranked within their source, and the slot of rank r takes
the source's block r. A source whose points come too late gets its last blocks at the end, so
every source delivers its target to the word, in any stretch of the schedule close to its share.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.workspace import Workspace, running_total, slice_of, slices_of

BLOCK_WORDS = 4096
# A mixture of more sources is refused; the driver sets the targets of all.
MAX_SOURCES = 10_000
_BITS = 40


def targets_of(sizes: Sequence[int], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Words each source owes: ``share`` of all by weight, at most ``most`` times its size.

    What a source cannot take goes to the others by weight. Sources reach their limits in the order of
    limit over weight, so one pass in that order finds the common factor of those below theirs.
    """
    left = share * sum(sizes)
    weight = sum(weights)
    out = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (most * sizes[i] / weights[i], i))
    for at, i in enumerate(order):
        if most * sizes[i] * weight >= left * weights[i]:
            for j in order[at:]:
                out[j] = min(left * weights[j] / weight, most * sizes[j])
            break
        out[i] = most * sizes[i]
        left -= out[i]
        weight -= weights[i]
    return out


def _schedule(sources: DataFrame, blocks: list[int]) -> DataFrame:
    """(source_no, rank, slot) for ranks below every source's number of blocks."""
    spark = sources.sparkSession
    total = sum(blocks)
    edges = F.array(*[F.lit(x / max(total, 1)) for x in accumulate(blocks[:-1])]) if len(blocks) > 1 else None
    bits = F.lpad(F.bin("slot"), _BITS, "0")
    point = F.conv(F.reverse(bits), 2, 10).cast("double") / float(1 << _BITS)
    owner = F.size(F.filter(edges, lambda e: e <= F.col("point"))) if edges is not None else F.lit(0)
    slots = spark.range(total).select(F.col("id").alias("slot")).withColumn("point", point)
    slots = slots.withColumn("source_no", owner).withColumn("part", F.expr(f"slot * {slices_of(total)} div {max(total, 1)}"))
    ranked = running_total(slots, ["source_no"], "part", [F.col("slot")], F.lit(1), "rank")
    ranked = ranked.select("source_no", "rank", "slot")
    had = ranked.groupBy("source_no").count().withColumnRenamed("source_no", "_no")
    late = sources.select("source_no", "blocks").join(had, F.col("source_no") == F.col("_no"), "left").filter(
        "blocks > coalesce(count, 0)"
    ).select("source_no", F.explode(F.sequence(F.coalesce("count", F.lit(0)), F.col("blocks") - 1)).alias("rank"))
    return ranked.union(late.select("source_no", "rank", F.lit(total) + F.col("rank")))


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
    block_words: int = BLOCK_WORDS, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """(doc_id, fp, source, size, source_size, target, taken, first_slot) of every row of ``docs``.

    ``weights`` go round over the sources by code point, null last. ``size`` counts the words of the
    text (runs of anything but ASCII white space), ``taken`` those that the mix takes,
    repeats counted, ``first_slot`` the first slot of the schedule that takes one, null if none does.
    ``most`` is at most 2, so a text is taken twice at most. ``fp`` is a hash of the text. The rows
    follow from ids, texts and sources alone, so reruns agree.

    - A null or wordless text has size 0 and nothing of it is taken. A null source is a source.
    - Repeated rows are texts of their own. A null id is ordered by its text.
    - A source without words has target 0. An empty table gives an empty table.
    """
    if most > 2:
        raise ValueError("a text can be taken twice at most")
    spark = docs.sparkSession
    space = Workspace(spark)
    text = F.col(text_col).cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
    rows = space.pin(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("fp"),
        F.col(source_col).cast("string").alias("source"), size.alias("size"),
    ).withColumn("row", F.monotonically_increasing_id()), "rows")
    total = rows.count()
    sums = rows.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(sums) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sums = sorted(sums, key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [r["size"] for r in sums]
    targets = targets_of(sizes, [weights[i % len(weights)] for i in range(len(sums))], share, most)
    quotas = [int(t) for t in targets]
    blocks = [-(-q // block_words) for q in quotas]
    sources = spark.createDataFrame(
        [(r["source"], i, s, t, q, b) for i, (r, s, t, q, b) in enumerate(zip(sums, sizes, targets, quotas, blocks))],
        "_source string, source_no int, source_size bigint, target double, quota bigint, blocks bigint",
    )
    known = rows.join(F.broadcast(sources), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    # At most MAX_SOURCES rows are broadcast, above.
    epochs = known.filter("size > 0").withColumn("epoch", F.explode(F.array(F.lit(0), F.lit(1)))).filter(
        "epoch * source_size < quota"
    )
    key = F.md5(F.concat_ws("|", F.lit(seed), "epoch", F.coalesce("doc_id", "fp").cast("string")))
    epochs = epochs.withColumn("key", key).withColumn("part", slice_of(F.col("key"), total))
    tie = [F.col("key"), F.col("fp"), F.col("size")]
    streamed = running_total(epochs, ["source_no", "epoch"], "part", tie, F.col("size"), "start")
    begin = F.col("epoch") * F.col("source_size") + F.col("start")
    streamed = streamed.withColumn("begin", begin).withColumn("end", F.least(begin + F.col("size"), F.col("quota")))
    cut = streamed.filter("begin < end").withColumn(
        "rank", F.explode(F.expr(f"sequence(begin div {block_words}, (end - 1) div {block_words})"))
    )
    inside = F.least("end", (F.col("rank") + 1) * block_words) - F.greatest("begin", F.col("rank") * block_words)
    pieces = cut.select("row", "source_no", "rank", inside.alias("words"))
    slots = _schedule(sources, blocks)
    took = pieces.join(slots, ["source_no", "rank"]).groupBy("row").agg(
        F.sum("words").alias("taken"), F.min("slot").alias("first_slot")
    )
    return known.join(took, "row", "left").select(
        "doc_id", "fp", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"), "first_slot",
    )
