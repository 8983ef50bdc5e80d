"""Language of texts by the nearest of several centroids per language.

A text is a TF-IDF vector of its byte n-grams of one to four bytes, over letters only and hashed to DIM
cells, normalised. The vectors of each language are clustered into a few centroids (spherical
k-means), and a text has the language of the centroid with the highest cosine. It is rejected if
that cosine is lower than labelled texts of the language and of its length have with centroids that
were fitted without them. Length is the number of cells a text fills, as lines that repeat add nothing.

Document counts for the IDF cover every labelled text. The clusters are fitted on at most
``per_language`` labelled texts of each language, those with the smallest hash of id and text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.words import pieces
from tallyloom.llm.workspace import free_name, small_batches

DIM = 2048
PER_LANGUAGE = 600
CENTROIDS = 4
# More languages than this are refused: the model is sent to every task.
MAX_LANGUAGES = 1000
# The bound of a language and length is this quantile of the cosines of labelled texts outside the fit, less
# MARGIN of its distance from their median. Both were chosen on the held-out texts of sf0.1.
QUANTILE = 0.02
MARGIN = 1.0
# A language with fewer labelled texts has the lowest bound that others have for the length.
LEAST_TEXTS = 20

_LENGTHS = 24
_NEIGHBOURS = 100


def _letters() -> np.ndarray:
    table = np.full(256, 0x20, np.uint64)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    table[0x61:0x7B] = np.arange(0x61, 0x7B)
    table[0x80:] = np.arange(0x80, 0x100)
    return table


def counts_of(column: pa.Array):
    """(first row, n-gram counts per row, DIM wide) of pieces of a column of texts."""
    table = _letters()
    for first, last, data, bounds in pieces(column, 1 << 19):
        n = len(data)
        out = np.zeros((last - first, DIM), np.float32)
        row = np.repeat(np.arange(last - first), np.diff(bounds))
        byte = table[data]
        code, valid = np.zeros(n, np.uint64), np.ones(n, bool)
        for size in range(1, 5):
            if n < size:
                break
            tail = byte[size - 1 :]
            code = code[: n - size + 1] * np.uint64(257) + tail
            valid = valid[: n - size + 1] & (row[: n - size + 1] == row[size - 1 :])
            # Two blanks in a row tell nothing.
            if size > 1:
                valid &= (tail != 0x20) | (byte[size - 2 : n - 1] != 0x20)
            keep = valid if size > 1 else valid & (tail != 0x20)
            cell = (code[keep] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 11)).astype(np.int64)
            for at in range(0, last - first, 256):
                lo, hi = np.searchsorted(row[: n - size + 1][keep], [at, at + 256])
                wide = min(256, last - first - at)
                add = np.bincount((row[: n - size + 1][keep][lo:hi] - at) * DIM + cell[lo:hi], minlength=wide * DIM)
                out[at : at + wide] += add.reshape(wide, DIM)
        yield first, out


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows, the count by its logarithm."""
    x = np.log1p(counts) * idf
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(norm > 0, norm, 1)


def _length(counts: np.ndarray) -> np.ndarray:
    """Class of a text's length: twice the binary logarithm of the cells it fills."""
    return np.minimum(np.rint(2 * np.log2(1 + (counts > 0).sum(axis=1))).astype(int), _LENGTHS - 1)


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of spherical k-means, started from far-apart rows."""
    chosen = [0]
    nearest = x @ x[0]
    for _ in range(min(k, len(x)) - 1):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    centroids = x[chosen]
    for _ in range(rounds):
        own = (x @ centroids.T).argmax(axis=1)
        sums = np.stack([x[own == i].sum(axis=0) if (own == i).any() else centroids[i] for i in range(len(centroids))])
        centroids = sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-12)
    return centroids


def outside(x: np.ndarray, k: int) -> np.ndarray:
    """Cosine of every row with the nearest centroid of a fit on the other half of the rows."""
    half = np.arange(len(x)) % 2 == 0
    score = np.zeros(len(x))
    for part in (half, ~half):
        score[part] = (x[part] @ cluster(x[~part], k).T).max(axis=1)
    return score


def least_cosines(score: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bound for every class of length; zeros if there are too few texts to tell."""
    if len(score) < LEAST_TEXTS:
        return np.zeros(_LENGTHS)
    known = [i for i in range(_LENGTHS) if (size == i).sum() >= 5] or [int(np.median(size))]
    usual = np.interp(np.arange(_LENGTHS), known, [np.median(score[np.abs(size - i) <= (len(known) == 1)]) for i in known])
    # The cosine of a sample falls by the root of its length.
    below = np.arange(known[0])
    usual[below] = usual[known[0]] * 0.5 ** ((known[0] - below) / 4)
    ratio = score / np.maximum(usual[size], 1e-12)
    least = np.zeros(_LENGTHS)
    for i in range(_LENGTHS):
        far = np.abs(size - i)
        some = ratio[far <= np.sort(far)[min(_NEIGHBOURS, len(far)) - 1]]
        low, middle = np.quantile(some, [QUANTILE, 0.5])
        least[i] = usual[i] * max(0.0, low - MARGIN * (middle - low))
    return least


def _document_counts(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Texts that hold each cell, and texts: one short row a task and cell reaches the aggregate."""

    def count(batches):
        total, rows = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for _, counts in counts_of(batch.column(0)):
                total += (counts > 0).sum(axis=0)
                rows += len(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(-1, DIM), pa.int32()), pa.array(np.concatenate([[rows], total]), pa.int64()),
        ], ["cell", "n"])

    sums = texts.mapInArrow(count, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    by_cell = {r["cell"]: r["n"] for r in sums}
    return np.array([by_cell.get(c, 0) for c in range(DIM)]), by_cell.get(-1, 0)


class Model:
    """Languages, idf, centroids with their language, and the least cosine by language and length."""

    def __init__(self, languages, idf, centroids, owner, least):
        self.languages, self.idf, self.centroids, self.owner, self.least = languages, idf, centroids, owner, least

    def predict(self, counts: np.ndarray):
        """(number of language, cosine, rejected) of every row."""
        near = weigh(counts, self.idf).astype(np.float32) @ self.centroids.T
        best = near.argmax(axis=1)
        score = near[np.arange(len(near)), best].astype(float).clip(0, 1)
        lang = self.owner[best]
        return lang, score, score < self.least[lang, _length(counts)]


def fit(
    labelled: DataFrame, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS
) -> Model | None:
    """A model of the rows (text binary, lang string not null, draw bigint); None without rows."""
    spark = labelled.sparkSession
    sizes = labelled.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    languages = sorted(r["lang"] for r in sizes)
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not languages:
        return None
    held, total = _document_counts(labelled.select("text"))
    idf = (np.log((1 + total) / (1 + held)) + 1).astype(np.float32)
    sent = spark.sparkContext.broadcast((idf, centroids))
    # The texts with the smallest draws. Draws are even, so this bound leaves a language a little over twice
    # the texts that are used, however many it has; repeated rows share a draw and count once.
    share = [(r["lang"], min(1.0, (2 * per_language + 200) / max(r["n"], 1))) for r in sizes]
    bound = spark.createDataFrame(share, "_lang string, _share double")
    near = labelled.join(F.broadcast(bound), F.col("lang") == F.col("_lang")).filter(
        F.col("draw") <= F.col("_share") * float(1 << 63)
    ).dropDuplicates(["lang", "draw"])

    def centre(frame: pd.DataFrame) -> pd.DataFrame:
        idf, k = sent.value
        frame = frame.sort_values(["draw", "text"]).head(per_language)
        counts = np.concatenate([c for _, c in counts_of(pa.array(frame["text"].tolist(), pa.binary()))])
        x = weigh(counts, idf)
        found = cluster(x, k)
        low = least_cosines(outside(x, k), _length(counts)) if len(x) >= LEAST_TEXTS else np.zeros(_LENGTHS)
        return pd.DataFrame({
            "lang": frame["lang"].iloc[0], "centroids": [found.astype(np.float32).tobytes()],
            "least": [low.astype(np.float64).tobytes()],
        })

    fitted = near.select("lang", "text", "draw").groupBy("lang").applyInPandas(
        centre, "lang string, centroids binary, least binary"
    ).collect()
    fitted = {r["lang"]: r for r in fitted}
    parts = [np.frombuffer(bytes(fitted[x]["centroids"]), np.float32).reshape(-1, DIM) for x in languages]
    least = np.stack([np.frombuffer(bytes(fitted[x]["least"]), np.float64) for x in languages])
    told = least.any(axis=1)
    if told.any():
        least[~told] = least[told].min(axis=0)
    owner = np.concatenate([np.full(len(p), i) for i, p in enumerate(parts)])
    return Model(languages, idf, np.concatenate(parts), owner, least)


def identify(
    docs: DataFrame, held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS, into: str = "language",
) -> DataFrame:
    """``docs`` with a column ``into``: (lang_pred, score, rejected, held_out). One of that name is replaced.

    Learns from rows with text and language for which ``held_out`` (default: crc32 of the id as text,
    modulo 3, is 1) is not true. ``score`` is the cosine with the nearest centroid, from 0 to 1.

    - A null text, or one without a letter, is ``und`` with score 0, and rejected.
    - Any other text has a learned language, also if it is rejected; ``und`` if none was learned.
    - Rejected is a text further off than all but about QUANTILE of the labelled texts of the language and length. Where no language has LEAST_TEXTS labelled texts, nothing with letters is rejected.
    - A null id is held out of learning. Repeated rows are told alike, ties by the first centroid.
    - An empty table gives an empty table.
    """
    small_batches(docs.sparkSession)
    if held_out is None:
        held_out = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1
    held = F.coalesce(held_out, F.lit(True))
    text = F.col(text_col).cast("string")
    readable = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    labelled = docs.filter(~held & readable & F.col(lang_col).isNotNull()).select(
        text.cast("binary").alias("text"), F.col(lang_col).cast("string").alias("lang"),
        F.shiftrightunsigned(F.xxhash64(F.col(id_col), text), 1).alias("draw"),
    )
    model = fit(labelled, per_language, centroids)
    sent = docs.sparkSession.sparkContext.broadcast(vars(model) if model else None)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def told(texts: pd.Series) -> pd.DataFrame:
        model = Model(**sent.value) if sent.value else None
        column = pa.array(texts, pa.binary(), from_pandas=True)
        names, scores, rejects = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        if model is not None:
            for first, counts in counts_of(column):
                lang, score, reject = model.predict(counts)
                for i, (l, some) in enumerate(zip(lang, counts.any(axis=1))):
                    if some and column[first + i].is_valid:
                        names[first + i] = model.languages[l]
                scores[first : first + len(counts)] = score
                rejects[first : first + len(counts)] = reject
        return pd.DataFrame({"lang_pred": names, "score": scores, "rejected": rejects})

    guess = told(F.when(readable, text.cast("binary")))
    guessed, kept_out = free_name([*docs.columns, into], "guess"), free_name([*docs.columns, into], "held")
    marked = docs.withColumn(guessed, guess).withColumn(kept_out, held)
    none = F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    best = F.when(readable, F.col(guessed)).otherwise(none)
    fields = [best[name].alias(name) for name in ("lang_pred", "score", "rejected")]
    return marked.withColumn(into, F.struct(*fields, F.col(kept_out).alias("held_out"))).drop(guessed, kept_out)
