"""Removal of word sequences that an earlier text already holds, by level-wise doubling.

The first level has half the window's length. Not all its windows are looked up: of the half-length
windows inside any full window the one with the smallest hash is its anchor, so equal full windows have
equal anchors, and a text has few. Anchors that occur in one text alone are dropped; every other
anchor is extended to the full windows that it is the anchor of. Windows that repeat at one
length are extended to twice that length, until no candidates survive or ``longest`` is reached: a text keeps the
places and hashes of its repeated windows together, so two of them are joined to one in place, and of equal texts,
which repeat to their end, one stands for all with their smallest and largest id.
Only hashes, with the smallest and largest id that has them, are shuffled, summed up on the map
side first, so a passage that many texts share is a few rows.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.words import SPACE, find_words, gram_hashes, mix, pieces, word_hashes
from tallyloom.llm.workspace import Workspace

KEY = ["doc_id", "fp"]


def _half_windows(column: pa.Array, window: int):
    """For every text: number of words, hashes of half windows, of full ones, place of each one's anchor."""
    half = window // 2
    for first, last, data, bounds in pieces(column):
        starts, ends, at = find_words(data, bounds, SPACE)
        hashed = word_hashes(data, starts, ends)
        halves, full = gram_hashes(hashed, half), gram_hashes(hashed, window)
        for row in range(last - first):
            begin, end = int(at[row]), int(at[row + 1])
            n = end - begin
            if n < window:
                yield n, None, None, None
                continue
            g = halves[begin : end - half + 1]
            view = np.lib.stride_tricks.sliding_window_view(g, window - half + 1)
            anchors = view.argmin(axis=1) + np.arange(n - window + 1)
            yield n, g, full[begin : end - window + 1], anchors


def _ragged(arrays: list[np.ndarray], kind) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(kind, copy=False)))


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _anchored(texts: DataFrame, window: int) -> DataFrame:
    """(doc_id, fp, n_words, sha, anchors) of every text."""

    def find(batches):
        for batch in batches:
            found = [
                (n, np.unique(g[at]).view(np.int64) if g is not None else np.zeros(0, np.int64))
                for n, g, _, at in _half_windows(batch.column(2), window)
            ]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([n for n, _ in found], pa.int64()),
                pa.array([_sha((t or b"").split()) for t in batch.column(2).to_pylist()], pa.string()),
                _ragged([a for _, a in found], np.int64),
            ], [*KEY, "n_words", "sha", "anchors"])

    return texts.mapInArrow(find, "doc_id bigint, fp bigint, n_words bigint, sha string, anchors array<bigint>")


def _extended(texts: DataFrame, window: int) -> DataFrame:
    """(doc_id, fp, text, at, hash): the full windows whose anchor is among the text's ``repeated``."""

    def extend(batches):
        for batch in batches:
            at, hashes = [], []
            for (_, g, full, anchors), repeated in zip(_half_windows(batch.column(2), window), batch.column(3)):
                if g is None:
                    at.append(np.zeros(0, np.int32)), hashes.append(np.zeros(0, np.int64))
                    continue
                wanted = np.asarray(repeated.values).view(np.uint64)
                places = np.flatnonzero(np.isin(g[anchors], wanted))
                at.append(places), hashes.append(full[places].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], _ragged(at, np.int32), _ragged(hashes, np.int64)],
                [*KEY, "text", "at", "hash"],
            )

    return texts.mapInArrow(extend, "doc_id bigint, fp bigint, text binary, at array<int>, hash array<bigint>")


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """(doc_id, fp, n_removed, kept_sha256, removed) of texts with the places of windows to remove."""

    def cut(batches):
        for batch in batches:
            counts, shas, spans = [], [], []
            for text, places in zip(batch.column(2).to_pylist(), batch.column(3)):
                words = text.split()
                edge = np.zeros(len(words) + 1, np.int64)
                begins = np.asarray(places.values)
                np.add.at(edge, begins, 1)
                np.add.at(edge, begins + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                step = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]])))
                counts.append(int(gone.sum()))
                shas.append(_sha([w for w, g in zip(words, gone.tolist()) if not g]))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(step[::2], step[1::2])])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(shas, pa.string()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ], [*KEY, "n_removed", "kept_sha256", "removed"])

    return texts.mapInArrow(
        cut, "doc_id bigint, fp bigint, n_removed bigint, kept_sha256 string,"
        " removed array<struct<start: bigint, end: bigint>>",
    )


def _repeated(space: Workspace, windows: DataFrame, low: str, high: str) -> DataFrame:
    """(repeated, first): the hashes of windows that occur in several ids, with the smallest.

    Written before they are joined: a join of two shuffles, unlike one of an aggregate in place, can be split
    where many texts share a passage.
    """
    ids = windows.groupBy("hash").agg(F.min(low).alias("first"), F.max(high).alias("last"))
    return space.pin(ids.filter("first < last").select(F.col("hash").alias("repeated"), "first"), "repeated")


def _surviving(space: Workspace, windows: DataFrame) -> DataFrame:
    """The windows (doc_id, ..., hash) that repeat, with the smallest id that has them."""
    repeated = _repeated(space, windows, "doc_id", "doc_id")
    return windows.join(repeated, F.col("hash") == F.col("repeated")).drop("repeated")


def _doubled(texts: DataFrame, length: int) -> DataFrame:
    """(fp, low, high, at, hash): windows of twice ``length`` words whose halves are both among the text's."""

    def double(batches):
        for batch in batches:
            at, hashes = [], []
            for places, values in zip(batch.column(3), batch.column(4)):
                begins, h = np.asarray(places.values), np.asarray(values.values).view(np.uint64)
                second = np.searchsorted(begins, begins + length)
                found = np.flatnonzero(np.append(begins, -1)[second] == begins + length)
                with np.errstate(over="ignore"):
                    both = mix(h[found] * np.uint64(0x9E3779B97F4A7C15) + mix(h[second[found]]))
                at.append(begins[found]), hashes.append(both.view(np.int64))
            some = pa.array([len(a) > 0 for a in at], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], _ragged(at, np.int32), _ragged(hashes, np.int64)], ["fp", "low", "high", "at", "hash"]
            ).filter(some)

    return texts.mapInArrow(double, "fp bigint, low bigint, high bigint, at array<int>, hash array<bigint>")


def _longest(space: Workspace, level: DataFrame, window: int, longest: int | None) -> DataFrame:
    """(fp, longest_repeat) of the texts that have repeated windows (doc_id, fp, at, hash)."""
    classes = level.select(F.col("fp").alias("class"), "doc_id").groupBy("class").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    )
    one = level.join(classes, (F.col("fp") == F.col("class")) & (F.col("doc_id") == F.col("low")))
    texts = one.groupBy("fp", "doc_id", "low", "high").agg(F.sort_array(F.collect_list(F.struct("at", "hash"))).alias("w")).select(
        "fp", "low", "high", F.col("w.at").alias("at"), F.col("w.hash").alias("hash")
    )
    texts, length, levels = space.pin(texts, "level"), window, []
    while not texts.isEmpty():
        levels.append(space.pin(texts.select("fp", F.lit(length).alias("longest_repeat")), "reached"))
        if longest is not None and 2 * length > longest:
            break
        doubled = space.pin(_doubled(texts, length), "doubled")
        windows = doubled.select("fp", "low", "high", F.explode(F.arrays_zip("at", "hash")).alias("w")).select(
            "fp", "low", "high", "w.at", "w.hash"
        )
        repeated = _repeated(space, windows, "low", "high")
        kept = windows.join(repeated, F.col("hash") == F.col("repeated")).groupBy("fp", "low", "high").agg(
            F.sort_array(F.collect_list(F.struct("at", "hash"))).alias("w")
        )
        following = space.pin(kept.select("fp", "low", "high", F.col("w.at").alias("at"), F.col("w.hash").alias("hash")), "level")
        space.drop(texts, doubled, repeated)
        texts, length = following, 2 * length
    space.drop(texts)
    reached = reduce(DataFrame.union, levels) if levels else level.select("fp", F.lit(0).alias("longest_repeat"))
    return reached.groupBy("fp").agg(F.max("longest_repeat").alias("longest_repeat"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50,
    longest: int | None = None,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, removed, longest_repeat) of every row of ``docs``.

    Words are runs of anything but ASCII white space. A word goes if it is in a window of
    ``window`` words that also starts in a text with a smaller id. ``removed`` are the ranges of
    words that go; ``longest_repeat`` the length of the longest level at which a window of the
    row repeats in another id, 0 if none does. ``longest`` ends the doubling at that length.

    - A null text has no words; it and texts shorter than the window keep all they have.
    - A repetition inside one text alone, or among rows of one id, removes nothing.
    - A row with a null id removes nothing, and nothing is removed from it.
    - Repeated rows are returned as often as they come. An empty table gives an empty table.
    """
    space = Workspace(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("fp"),
        F.col(text_col).cast("binary").alias("text"),
    )
    all_rows = space.pin(_anchored(texts, window), "anchors")
    anchors = all_rows.filter("doc_id IS NOT NULL").select(*KEY, F.explode("anchors").alias("hash"))
    wanted = _surviving(space, anchors).groupBy(*KEY).agg(F.collect_set("hash").alias("repeated"))
    candidates = texts.join(wanted, KEY).dropDuplicates(KEY).select(*KEY, "text", "repeated")
    candidates = space.pin(_extended(candidates, window), "windows")
    windows = candidates.select(*KEY, F.explode(F.arrays_zip("at", "hash")).alias("w")).select(*KEY, "w.at", "w.hash")
    level = space.pin(_surviving(space, windows), "repeats")
    later = level.filter("first < doc_id").groupBy(*KEY).agg(F.collect_set("at").alias("places"))
    cut = space.pin(_cut(candidates.join(later, KEY).select(*KEY, "text", "places"), window), "cut")
    space.drop(candidates)
    # Told by text: the rows of one text in several ids repeat to its end, as far as levels go.
    rows = space.pin(level.select(*KEY).distinct(), "rows")
    reached = space.pin(_longest(space, level, window, longest), "longest").withColumnRenamed("fp", "text_fp")
    repeating = rows.join(reached, F.col("fp") == F.col("text_fp")).drop("text_fp")
    space.drop(level)

    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return all_rows.drop("anchors").join(cut, KEY, "left").join(repeating, KEY, "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"), F.coalesce("removed", none).alias("removed"),
        F.coalesce("longest_repeat", F.lit(0)).alias("longest_repeat"),
    )
