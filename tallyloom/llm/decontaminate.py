"""Benchmark passages in texts, found by one Aho-Corasick automaton.

The automaton holds every window of words of the normalised benchmark items. A text is
normalised to lower-case words with one space between them and scanned once; the end of a match
tells the words it covers, and their places in the original text are kept with them.

The patterns are sent to every task. They are of a size that is checked: beyond BLOCK_CHARS
they are split by hash into that many blocks, and the texts are scanned once for each.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.workspace import small_batches

# An automaton takes about a hundred bytes a character.
BLOCK_CHARS = 4_000_000

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of all characters beyond ASCII."""
    return text.translate(_TO_WORDS).split() if text else []


def _joined(words: list[bytes]) -> str:
    return b" ".join(words).decode("utf-8", "replace")


def _patterns(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(pattern, n, items): every window of the items, shorter items being one window."""

    def windows(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                n = min(window, len(words))
                out += [(item, _joined(words[i : i + n]), n) for i in range(len(words) - n + 1) if n]
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string()),
                pa.array([x[2] for x in out], pa.int32()),
            ], ["item", "pattern", "n"])

    items = benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("binary")).filter(
        F.col(id_col).isNotNull()
    )
    found = items.mapInArrow(windows, "item string, pattern string, n int")
    return found.groupBy("pattern", "n").agg(F.collect_set("item").alias("items"))


def _spans(text: bytes | None, ranges: list[int]) -> list[dict]:
    """Character ranges of runs of hit words in the original text."""
    if not ranges:
        return []
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text.decode("utf-8", "replace"))
    places = [m.span() for m in WORD.finditer(lower)]
    return [{"start": places[a][0], "end": places[b - 1][1]} for a, b in zip(ranges[::2], ranges[1::2])]


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


_BETWEEN = "doc_id bigint, text binary, n_words bigint, ranges array<bigint>, items array<string>, fp bigint"
_RESULT = (
    "doc_id bigint, fp bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string,"
    " items array<string>, spans array<struct<start: bigint, end: bigint>>"
)


def _scan(rows: DataFrame, patterns: list, last: bool) -> DataFrame:
    """Adds a block's hits to ``ranges`` (of words) and ``items``; the last block gives the result."""
    sent = rows.sparkSession.sparkContext.broadcast(patterns)

    def scan(batches):
        automaton = ahocorasick.Automaton()
        for k, (pattern, n, _) in enumerate(sent.value):
            automaton.add_word(f" {pattern} ", (n, k))
        automaton.make_automaton()
        found_any = len(automaton) > 0

        def hits(text, ranges, items):
            """(words, ranges of hit words, items) of one text."""
            words = words_of(text)
            line = _joined(words)
            found = list(automaton.iter(f" {line} ")) if words and found_any else []
            if not found:
                return len(words), ranges, items
            ends = np.cumsum([len(w) + 1 for w in line.split(" ")])
            edge = np.zeros(len(words) + 1, np.int64)
            for end, (_, (n, _)) in zip(np.searchsorted(ends, [e for e, _ in found]).tolist(), found):
                edge[end - n + 1] += 1
                edge[end + 1] -= 1
            np.add.at(edge, ranges[::2], 1)
            np.add.at(edge, ranges[1::2], -1)
            step = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(edge[:-1]) > 0, [0]])))
            return len(words), step.tolist(), sorted({i for _, (_, k) in found for i in sent.value[k][2]} | set(items))

        for batch in batches:
            texts = batch.column(1).to_pylist()
            told = [hits(t, r, i) for t, r, i in zip(texts, *(batch.column(c).to_pylist() for c in (3, 4)))]
            counts = pa.array([n for n, _, _ in told], pa.int64())
            items = pa.array([i for _, _, i in told], pa.list_(pa.string()))
            if not last:
                ranges = pa.array([r for _, r, _ in told], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], counts, ranges, items, batch.column(5)], batch.schema.names
                )
                continue
            shas = [hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for _, _, i in told]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(5), counts,
                pa.array([sum(r[1::2]) - sum(r[::2]) for _, r, _ in told], pa.int64()),
                pa.array([len(i) for _, _, i in told], pa.int64()), pa.array(shas, pa.string()), items,
                pa.array([_spans(t, r) for t, (_, r, _) in zip(texts, told)], pa.list_(_SPAN)),
            ], ["doc_id", "fp", "n_words", "n_hit", "n_items", "items_sha256", "items", "spans"])

    return rows.mapInArrow(scan, _RESULT if last else _BETWEEN)


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = 13, percent: int = 5,
) -> DataFrame:
    """(doc_id, fp, n_words, n_hit, n_items, items_sha256, items, spans, contaminated) of every row.

    ``fp`` is a hash of the text. A word is hit if an occurrence of a window of ``window`` words of an item covers it; an item
    of fewer words is one window. ``items`` has the ids of items with an occurring window, as
    sorted strings; ``spans`` the hit runs of the original text in characters. A row is contaminated
    if at least ``percent`` per cent of its words are hit, and one at least.

    - A null text has no words and no hits. Items without words match nothing.
    - Items with a null id are left out; items of equal text are all counted.
    - Repeated rows are returned as often as they come; null ids stay null.
    - Empty tables: no rows without texts, no hits without items.
    """
    small_batches(docs.sparkSession)
    patterns = _patterns(benchmark, item_col, item_text_col, window).cache()
    chars = patterns.agg(F.sum(F.length("pattern") + 2)).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"),
        F.lit(0).cast("bigint").alias("n_words"), F.array().cast("array<bigint>").alias("ranges"),
        F.array().cast("array<string>").alias("items"), F.xxhash64(F.col(text_col).cast("string")).alias("fp"),
    )
    for block in range(blocks):
        mine = patterns.filter(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == block)
        rows = _scan(rows, [tuple(r) for r in mine.orderBy("pattern").collect()], block == blocks - 1)
    patterns.unpersist()
    over = (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))
    return rows.withColumn("contaminated", over)
