"""Alignment of two tokenizers' tokens by diagonal run skipping, and how documents share the links.

Both tokenizers cut the same bytes, so a text is two rising arrays of byte ends. Walking along them, an
index pair (i, j) stays on the diagonal while ends are equal. A stretch of one-to-one tokens is jumped:
blocks of 1, 2, 4 ... ends are compared at the current shift j - i, and the first unequal end inside the
last block is found. There an irregular group begins; the side that lags takes tokens until both ends
agree, and the shift becomes that of the token after it.

A text's links are kept as its distinct id pairs with their counts, written once. Spark sums up in how many
documents each pair occurs. The documents get the sums of the pairs that most of them hold from a table sent to
the tasks, of at most ``sent`` pairs; only links of rarer pairs, if there are any, are shuffled. So no hot
pair ever is.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.workspace import Workspace, small_batches

#: Characters that one call of a tokenizer gets; see ``chunks``.
CALL_CHARS = 1 << 17
#: Bits of a pair's number that hold the B id.
B_BITS = 24
#: Pairs sent to every task: all if they are no more, else those that the most documents hold.
SENT_PAIRS = 1 << 20


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


# Both kinds of tokenizer begin a new token at a single space between a visible character and a letter.
_SEAM = re.compile(r"(?<=[!-~]) (?=[A-Za-z])")


def chunks(text: str, size: int) -> list[str]:
    """Parts that, each with a space before it, add up to space + text, and whose tokens add up to the text's.

    A part is longer than ``size`` only where it has no seam.
    """
    parts, start = [], 0
    while len(text) - start > size:
        seam = _SEAM.search(text, start + size)
        if seam is None:
            break
        parts.append(text[start : seam.start()])
        start = seam.end()
    return [*parts, text[start:]]


# Fixed value: the pattern that cuts a text before byte-level merges, as byte-level vocabularies define it.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevel:
    """A byte-level BPE vocabulary of a ``tokenizers`` file; encodes space + text, special strings as plain text.

    Where the file's ids follow its merges, as those of a plain byte-level BPE do, the merges are run by ``tiktoken``
    over the file's vocabulary, at a fifth of the time for the same ids; else by ``tokenizers``.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        alphabet, special = _byte_of_char(), {t["id"]: t["content"] for t in told.get("added_tokens", [])}
        vocabulary = {at: entry for entry, at in told["model"]["vocab"].items()}
        pieces = {at: bytes(map(alphabet.__getitem__, e)) for at, e in vocabulary.items() if at not in special}
        pieces |= {at: entry.encode() for at, entry in special.items()}
        self.pieces = [pieces.get(at, b"") for at in range(max(pieces) + 1)]
        if self._plain(told, vocabulary, special):
            import tiktoken

            ranks = {piece: at for at, piece in pieces.items() if at not in special}
            encoding = tiktoken.Encoding("own", pat_str=_CUT, mergeable_ranks=ranks, special_tokens={})
            self._encode = encoding.encode_ordinary
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            self._encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _plain(told: dict, vocabulary: dict[int, str], special: dict[int, str]) -> bool:
        model, first = told["model"], told["pre_tokenizer"] or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        single = len(vocabulary) - len(merges) - len(special.keys() & vocabulary.keys())
        return (
            model["type"] == "BPE" and told["normalizer"] is None and first.get("type") == "ByteLevel"
            and first.get("use_regex", True) and not first.get("add_prefix_space") and not model.get("ignore_merges")
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
            and all(t["special"] for t in told.get("added_tokens", []))
            and all(vocabulary.get(single + n) == "".join(m) for n, m in enumerate(merges))
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._encode(" " + t) for t in texts]


class Pieces:
    """A ``sentencepiece`` model, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = []
        for at in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(at)
            byte = bytes([int(piece[3:5], 16)]) if self.model.is_byte(at) else None
            self.pieces.append(piece.replace("▁", " ").encode() if byte is None else byte)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def runs(a: list[int], b: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """Groups (i0, i1, j0, j1) of two rising arrays with equal last ends; a one-to-one run is one tuple of n tokens each.

    A tuple is a run of one-to-one groups if i1 - i0 == j1 - j0 and a[i0] == b[j0], else one irregular group.
    """
    i, j, n = 0, 0, len(a)
    while i < n:
        if a[i] == b[j]:
            # Blocks are compared at this shift, each twice as long as the last, up to one with an unlike end.
            start, shift, step = i, j - i, 2
            i += 1
            while True:
                block, other = a[i : i + step], b[i + shift : i + shift + step]
                if block == other:
                    i += len(block)
                    if len(block) < step:
                        break
                    step += step
                    continue
                while len(block) > 8 or len(other) > 8:
                    # The first unlike end is in this block: keep the half that has it.
                    half = max(len(block), len(other)) // 2
                    if block[:half] == other[:half]:
                        block, other = block[half:], other[half:]
                        i += half
                    else:
                        block, other = block[:half], other[:half]
                for x, y in zip(block, other):
                    if x != y:
                        break
                    i += 1
                break
            j = i + shift
            yield start, i, start + shift, j
        else:
            i0, j0 = i, j
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i, j = i + 1, j + 1
            yield i0, i, j0, j


def _ranges(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """All numbers of all ranges, one after the other."""
    sizes = stops - starts
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Alignment:
    """Tokens of one text, the first token of every group on either side, and the linked tokens."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray):
        self.a, self.b = a, b
        found = np.array(list(runs(a_ends.tolist(), b_ends.tolist())), np.int64).reshape(-1, 4)
        i0, i1, j0, j1 = found.T
        single = a_ends[i0] == b_ends[j0] if len(found) else np.zeros(0, bool)
        odd = ~single
        heads_a, heads_b = np.ones(len(a), bool), np.ones(len(b), bool)
        heads_a[_ranges(i0[odd] + 1, i1[odd])] = False
        heads_b[_ranges(j0[odd] + 1, j1[odd])] = False
        self.a_heads, self.b_heads = np.flatnonzero(heads_a), np.flatnonzero(heads_b)
        # One-to-one stretches link token by token; in irregular groups an A token links the B tokens it overlaps.
        inside = _ranges(i0[odd], i1[odd])
        a_from = np.concatenate([[0], a_ends[:-1]]) if len(a) else a_ends
        b_from = np.concatenate([[0], b_ends[:-1]]) if len(b) else b_ends
        first = np.searchsorted(b_ends, a_from[inside], "right")
        last = np.searchsorted(b_from, a_ends[inside], "left")
        self.a_linked = np.concatenate([_ranges(i0[single], i1[single]), np.repeat(inside, last - first)])
        self.b_linked = np.concatenate([_ranges(j0[single], j1[single]), _ranges(first, last)])


class Aligner:
    """Two tokenizers side by side."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.a_sizes, self.b_sizes = (np.array(list(map(len, t.pieces)), np.int64) for t in (self.a, self.b))
        # Every token of a digest's text with what follows it: another token, the other side, the next group.
        self._said = [f"{n}{end}".encode() for n in range(len(self.a.pieces)) for end in ",|"]
        self._b_said = len(self._said)
        self._said += [f"{n}{end}".encode() for n in range(len(self.b.pieces)) for end in ",;"]

    def align(self, texts: list[str | None]) -> Iterator[Alignment | None]:
        """None for null and empty texts and those whose tokens do not give back space + text."""
        parts = [chunks(t, CALL_CHARS) if t else [] for t in texts]
        flat = [p for ps in parts for p in ps]
        first = 0
        tokens: list[tuple[list[int], list[int]]] = []
        for at in range(len(flat)):
            if at + 1 == len(flat) or sum(map(len, flat[first : at + 2])) > CALL_CHARS:
                call = flat[first : at + 1]
                tokens += zip(self.a.encode(call), self.b.encode(call))
                first = at + 1
        done = 0
        for text, ps in zip(texts, parts):
            if not ps:
                yield None
                continue
            own = tokens[done : done + len(ps)]
            done += len(ps)
            a, b = ([i for part in own for i in part[side]] for side in (0, 1))
            whole = b" " + text.encode()
            if any(b"".join(map(t.pieces.__getitem__, ids)) != whole for t, ids in ((self.a, a), (self.b, b))):
                yield None
                continue
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            yield Alignment(a, b, np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b]))

    def digest(self, found: Alignment) -> str:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3``: the groups in order, their ids on either side."""
        last_a, last_b = np.zeros(len(found.a), np.int64), np.zeros(len(found.b), np.int64)
        last_a[found.a_heads[1:] - 1] = last_b[found.b_heads[1:] - 1] = last_a[-1] = last_b[-1] = 1
        # A group's A tokens stand behind all B tokens of the groups before, its B tokens behind its A tokens.
        a_groups, b_groups = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        a_stops = np.append(found.a_heads[1:], len(found.a))
        codes = np.empty(len(found.a) + len(found.b), np.int64)
        codes[np.arange(len(found.a)) + found.b_heads[a_groups]] = 2 * found.a + last_a
        codes[np.arange(len(found.b)) + a_stops[b_groups]] = self._b_said + 2 * found.b + last_b
        return hashlib.sha256(b"".join(map(self._said.__getitem__, codes.tolist()))[:-1]).hexdigest()


def _texts(column: pa.Array) -> list[str | None]:
    """Texts that are no valid Unicode are told as null: no tokens give them back."""

    def read(value: bytes | None) -> str | None:
        try:
            return None if value is None else value.decode()
        except UnicodeDecodeError:
            return None

    return [read(v) for v in column.to_pylist()]


def _batches(batches, aligner: Aligner):
    """Rows a few at a time with their alignments, so that the tokens of little text are held at once."""
    for batch in batches:
        texts = _texts(batch.column(batch.num_columns - 1))
        start = 0
        while start < len(texts):
            stop, held = start, 0
            while stop < len(texts) and (stop == start or held + len(texts[stop] or "") <= 8 * CALL_CHARS):
                held += len(texts[stop] or "")
                stop += 1
            yield batch.slice(start, stop - start), aligner.align(texts[start:stop])
            start = stop


def token_groups(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, groups: array<struct<a: array<int>, b: array<int>>>) of every row: the aligned ids in order.

    ``groups`` is empty for texts without tokens, see ``alignment_counts``.
    """
    small_batches(docs.sparkSession)
    side = pa.list_(pa.int32())
    kind = pa.list_(pa.struct([("a", side), ("b", side)]))

    def align(batches):
        aligner = Aligner(a_path, b_path)
        for some, found in _batches(batches, aligner):
            groups = []
            for one in found:
                cut = [] if one is None else zip(
                    np.split(one.a, one.a_heads[1:]), np.split(one.b, one.b_heads[1:])
                )
                groups.append([{"a": a.tolist(), "b": b.tolist()} for a, b in cut])
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(groups, kind)], ["doc_id", "groups"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(align, "doc_id bigint, groups array<struct<a: array<int>, b: array<int>>>")


def _linked(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times): a text's distinct pairs, how often each."""
    counts = ["n_a", "n_b", "n_groups", "n_links"]

    def align(batches):
        aligner = Aligner(a_path, b_path)
        for some, found in _batches(batches, aligner):
            told, digests, pairs, times = [], [], [], []
            for one in found:
                if one is None:
                    told.append((0, 0, 0, 0)), digests.append("")
                    pairs.append(np.zeros(0, np.int64)), times.append(np.zeros(0, np.int64))
                    continue
                told.append((len(one.a), len(one.b), len(one.a_heads), len(one.a_linked)))
                digests.append(aligner.digest(one))
                key, n = np.unique((one.a[one.a_linked] << B_BITS) + one.b[one.b_linked], return_counts=True)
                pairs.append(key), times.append(n)
            ends = pa.array(np.cumsum([0, *map(len, pairs)]), pa.int32())
            lists = [
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x).astype(kind)))
                for x, kind in ((pairs, np.int64), (times, np.int32))
            ]
            yield pa.RecordBatch.from_arrays(
                [*some.columns[:2], *(pa.array(c, pa.int64()) for c in zip(*told)), pa.array(digests, pa.string()), *lists],
                ["row", "doc_id", *counts, "groups_sha256", "pairs", "times"],
            )

    return rows.mapInArrow(
        align, f"row bigint, doc_id bigint, {', '.join(f'{c} bigint' for c in counts)}, groups_sha256 string,"
        " pairs array<bigint>, times array<int>",
    )


def _most_held(counts: DataFrame, rows: int, sent: int) -> DataFrame:
    """The pairs that the most documents hold, at most ``sent`` of the ``rows``."""
    if rows <= sent:
        return counts
    bound = counts.agg(F.percentile_approx("docs", 1 - sent / rows)).first()[0]
    while counts.filter(F.col("docs") > bound).count() > sent:
        bound *= 2
    return counts.filter(F.col("docs") > bound)


def alignment_counts(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
    sent: int = SENT_PAIRS,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    A encodes space + text by the byte-level BPE file ``a_path``, B the text by the sentencepiece model
    ``b_path``. Byte offsets where tokens of both end cut them into groups; a link is a token of A and one of B
    whose bytes overlap. An id pair counts in how many rows it is linked; ``count_sum`` adds up the counts
    of a row's links, ``n_best`` counts the links whose count is the highest of their A id.

    - A text that is null, empty, no valid Unicode, or whose tokens do not join to space + text has no tokens:
      zeros, and an empty digest. It adds to no count.
    - Repeated rows are rows: each adds to the counts and is returned. A null id is returned as null.
    - Texts longer than ``CALL_CHARS`` are encoded in parts cut at spaces, with the same tokens.
    - An empty table gives an empty table; other columns, whatever their names, are not read.
    """
    space = Workspace(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).cast("binary").alias("text"),
    )
    linked = space.pin(_linked(rows, a_path, b_path), "linked")
    held = linked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    of_a = Window.partitionBy(F.shiftright("pair", B_BITS))
    best = F.when(F.col("docs") == F.max("docs").over(of_a), 1).otherwise(0)
    counts = space.pin(held.withColumn("best", best), "pairs")
    n = counts.count()
    common = _most_held(counts, n, sent).withColumnRenamed("pair", "_pair")

    links = linked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(
        "row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times")
    )
    same = F.col("pair") == F.col("_pair")
    totals = [F.sum(F.col("times") * F.col("docs")).alias("s"), F.sum(F.col("times") * F.col("best")).alias("t")]
    sums = links.join(F.broadcast(common), same).groupBy("row").agg(*totals)
    if n > sent:
        rest = links.join(F.broadcast(common), same, "left_anti")
        rare = counts.withColumnRenamed("pair", "_pair")
        sums = sums.union(rest.join(rare, same).groupBy("row").agg(*totals))
        sums = sums.groupBy("row").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    zero = F.lit(0).cast("bigint")
    return linked.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("t", zero).alias("n_best"),
        F.coalesce("s", zero).alias("count_sum"), "groups_sha256",
    )
