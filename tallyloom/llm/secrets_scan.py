"""Secrets in texts and in what is encoded in them.

A worklist of layers: the text itself, then the layer in which every URL, Unicode, hexadecimal
character escape is replaced by what it stands for and every base64 run by its bytes, and so on until a layer
has nothing to decode or was seen before. Every layer is scanned whole. Each character of a layer carries the range
of the original text that it came from, so a find in any layer is told as a span of the original.

Many escapes for the sign that begins the next one are decoded on the spot, so that a chain is one step however
long. Bytes that are compressed, in base64 or in escapes, are unfolded at once to their
end: all members, whatever is compressed in them in turn, also where the end is missing. What unfolds to more than a
bound is read as it unfolds, a window at a time, and not kept.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.workspace import small_batches

# What the compressed runs of a text may unfold to at once in all its layers: so many bytes, and so many more for
# each character. A run that goes beyond them is read in windows, each with the end of the last.
MAX_INFLATED = 16 << 20
MORE_INFLATED = 64
WINDOW, OVERLAP = 1 << 20, 1 << 16
_PIECE = 1 << 16
# A chain of as many escapes of escape signs is one step; a shorter one takes a layer for each, as bytes of compressed
# runs may be such signs, and are escaped with the others.
CHAIN = 16

# Fixed patterns: kind, pattern, group that must be long enough, its length.
KINDS = (
    ("assign", re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
# The same finds, told from far fewer attempts.
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
_KEY = re.compile(r"passw|secret|token|api_?key", re.IGNORECASE | re.ASCII)

_ESCAPE = re.compile(r"(?:%[0-9A-Fa-f]{2})+|\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\u[0-9A-Fa-f]{4})+|(?:\\x[0-9A-Fa-f]{2})+|&#(?:x[0-9A-Fa-f]{1,6}|[0-9]{1,7});")
_UNIT = re.compile(r"%[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|&#(?:x[0-9A-Fa-f]{1,6}|[0-9]{1,7});")
# What compressed runs and two-byte characters begin with.
_BEGINNINGS = (b"\x1f\x8b\x08", b"BZh", b"\xfd7zXZ\x00", b"x\x01", b"x\x5e", b"x\x9c", b"x\xda", b"\xff\xfe", b"\xfe\xff")


def _escaped(data: bytes) -> str:
    """A pattern of bytes in URL escapes, or as themselves where an URL has them so."""
    plain = [re.escape(chr(c)) + "|" if chr(c).isalnum() and c < 0x80 or c == 0x5E else "" for c in data]
    return "".join(f"(?:{own}%{c:02x})" for own, c in zip(plain, data))


# The runs of escapes, in an URL's or in a string's form, that begin so.
_PACKED = re.compile(
    f"(?:{'|'.join(map(_escaped, _BEGINNINGS))})(?:%[0-9a-f]{{2}}|[a-z0-9_.~/-])*"
    + "|(?:" + "|".join("".join(f"\\\\x{c:02x}" for c in b) for b in _BEGINNINGS) + r")(?:\\x[0-9a-f]{2})*",
    re.IGNORECASE | re.ASCII,
)
# Characters of either base64 alphabet, lines of them joined.
_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:(?:\r\n|[\n\r])[ \t]*[A-Za-z0-9+/_-]+)*={0,2}")
_BREAK = re.compile(r"[\r\n][\r\n \t]*")
_SEPARATOR = re.compile(r"[/_-]")
# Fewer characters than this are not tried.
_SHORTEST = 16
_SPACES = dict.fromkeys(map(ord, "\t\r\n"))


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, number of kind, end) of the base finds of one text."""
    found = []
    if _KEY.search(text):
        found += [(m.start(), 0, m.end()) for m in KINDS[0][1].finditer(text) if len(m[2]) >= KINDS[0][3]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in KINDS[1][1].finditer(text) if len(m[0]) >= KINDS[1][3]]
    found += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found)


def _machine(data: bytes):
    """A decompressor for bytes that begin like a compressed run."""
    if data[:3] == b"\x1f\x8b\x08" or (len(data) > 2 and data[0] & 15 == 8 and (data[0] << 8 | data[1]) % 31 == 0):
        return zlib.decompressobj(47)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor() if data[:6] == b"\xfd7zXZ\x00" else None


_BROKEN = (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError)


def _members(data: Iterator[bytes], past: list[bytes] | None = None) -> Iterator[bytes]:
    """What compressed bytes unfold to, one member after the other, up to their end or to what is not compressed.

    ``past`` gets the bytes after the last member, where that has an end.
    """
    rest = next(data, b"")
    while (machine := _machine(rest)) is not None:
        try:
            while not machine.eof:
                out = machine.decompress(rest, _PIECE)
                rest = getattr(machine, "unconsumed_tail", b"")
                if out:
                    yield out
                elif not rest and getattr(machine, "needs_input", True) and not machine.eof:
                    rest = next(data, b"")
                    if not rest:
                        return
        except _BROKEN:
            return
        rest = machine.unused_data
        while len(rest) < 8 and (more := next(data, b"")):
            rest += more
    if past is not None:
        past.append(rest)


def _unfolded(data: bytes, past: list[bytes] | None = None) -> tuple[Iterator[bytes], int]:
    """The bytes in compressed bytes, and how many layers of compression were around them.

    Ends at bytes that are not compressed, or that begin like a layer around them. ``past`` gets the bytes after the
    outermost layer, once all is read.
    """
    flow, depth, seen = iter([data]), 0, set()
    while True:
        head = b""
        while len(head) < 1 << 10 and (more := next(flow, b"")):
            head += more
        flow = chain([head], flow)
        if _machine(head) is None or head[: 1 << 10] in seen:
            return flow, depth
        seen.add(head[: 1 << 10])
        inside = _members(flow, past if depth == 0 else None)
        first = next(inside, b"")
        if not first:
            return iter([head]) if depth else flow, depth
        flow, depth = chain([first], inside), depth + 1


def _sure(data: bytes, text: str) -> bool:
    """Whether bytes were compressed: two bytes of zlib may be chance, unless text comes of them."""
    return data[:1] in b"\x1f\x42\xfd\xfe\xff" or _printable(text.encode()) >= min(len(text), 16)


def _wide(data: bytes) -> str | None:
    """The encoding of two-byte characters, by their mark or by the zeros of the first ones."""
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16"
    head = data[: 32 & -2]
    if len(head) >= 12 and len(set(head)) > 4:
        for encoding, zeros, others in (("utf-16-le", head[1::2], head[::2]), ("utf-16-be", head[::2], head[1::2])):
            if not any(zeros) and others.isascii() and all(others):
                return encoding
    return None


def _text(data: bytes) -> str:
    """Bytes as text; what is none stays as replacement characters."""
    return data.decode(_wide(data) or "utf-8", "replace")


def _printable(data: bytes) -> int:
    """Number of bytes at the beginning that are printable text."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError as e:
        text = data[: e.start].decode("utf-8")
    if not text.translate(_SPACES).isprintable():
        text = text[: next(i for i, c in enumerate(text) if not c.isprintable() and c not in "\t\r\n")]
    return len(text.encode())


def _units(run: str) -> list[tuple[str, int, int]] | None:
    """(character, start, end in the run) of an escape."""
    if run[0] == "&":
        code = int(run[3:-1], 16) if run[2] == "x" else int(run[2:-1])
        return [(chr(code), 0, len(run))] if code < 0x110000 and not 0xD800 <= code < 0xE000 else None
    if run[:3] == "\\u{":
        code = int(run[3:-1], 16)
        return [(chr(code), 0, len(run))] if code < 0x110000 and not 0xD800 <= code < 0xE000 else None
    if run[:2] == "\\u":
        wide = bytes.fromhex(run.replace("\\u", "")).decode("utf-16-be", "replace")
        out, at = [], 0
        for c in wide:
            size = 12 if ord(c) > 0xFFFF else 6
            out.append((c, at, at + size))
            at += size
        return out
    step = 3 if run[0] == "%" else 4
    data = bytes.fromhex(run.replace("%", "").replace("\\x", ""))
    out, at = [], 0
    for c in data.decode("utf-8", "replace"):
        size = step * (len(c.encode()) if c != "�" else 1)
        out.append((c, at, at + size))
        at += size
    return out


def _escapes(text: str, stops: list[int]) -> Iterator[tuple[int, int, list[tuple[str, int, int]]]]:
    """(start, end, units) of all escapes; a chain of those for the sign that begins the next is one.

    None goes over one of ``stops``.
    """
    at = 0
    while (m := _ESCAPE.search(text, at)) is not None:
        a, at = m.span()
        stop = bisect_right(stops, a)
        if stop < len(stops) and stops[stop] < at:
            at = stops[stop]
        units = _units(text[a:at])
        if units is None:
            continue
        if units and units[-1][0] in "%\\&":
            sign, first, last = units[-1]
            links, past = 0, at
            while (n := _UNIT.match(sign + text[past : past + 11])) is not None:
                more = _units(n[0])
                if not more or more[0][0] not in "%\\&":  # what the chain comes to is for the next layer
                    break
                sign, past, links = more[0][0], past + len(n[0]) - 1, links + 1
            if links >= CHAIN:
                at = past
                units[-1] = (sign, first, at - a)
        yield a, at, units


def _bytes(body: str) -> bytes:
    """Bytes of base64 without its padding; a last character that fills no byte is left out."""
    body = body[: len(body) - (len(body) % 4 == 1)]
    return base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4))


class _Oversize(Exception):
    """A run that unfolds to more than may be kept; ``flow`` tells all of it."""

    def __init__(self, flow: Iterator[bytes]):
        self.flow = flow


def _kept(flow: Iterator[bytes], left: int) -> bytes:
    parts, size = [], 0
    for part in flow:
        parts.append(part)
        size += len(part)
        if size > left:
            raise _Oversize(chain(parts, flow))
    return b"".join(parts)


def _kinds_in(flow: Iterator[bytes]) -> set[int]:
    """The kinds of finds in a flow and its layers, read in windows that each begin with the end of the last."""
    kinds, held = set(), b""
    for part in chain(flow, [None]):
        held += part or b""
        if len(held) >= WINDOW or part is None:
            kinds |= {kind for _, kind, _ in scan_layers(_text(held))[1]}
            held = held[-OVERLAP:]
    return kinds


def _piece(body: str, start: int, ends: list[int], left: int) -> tuple[str, int, bool] | None:
    """(text, end, inflated) of the base64 that starts at a place and reaches as far as one of ``ends``."""
    head = _bytes(body[start : start + _SHORTEST])
    if _machine(head) is not None and _unfolded(_bytes(body[start : start + 1024]))[1]:
        data, past = _bytes(body[start:]), []
        text = _text(_kept(_unfolded(data, past)[0], left))
        read = len(data) - sum(map(len, past))
        return (text, min(len(body), start + -(-read * 4 // 3)), True) if _sure(data, text) else None
    if _wide(head):
        data = _bytes(body[start:])
        text = _text(data[: len(data) & -2])
        return (text, len(body), True) if text.translate(_SPACES).replace("\ufeff", "").isprintable() else None
    # A character cut at the end of the part that was decoded is no sign of other bytes.
    if _printable(head) < 9:
        return None
    size = 1024
    while True:
        data = _bytes(body[start : start + size])
        good = _printable(data)
        if good < len(data) - 3 or start + size >= len(body):
            break
        size *= 4
    for end in reversed(ends[: bisect_right(ends, start + good * 4 // 3 + 2)]):
        n = end - start
        if n < _SHORTEST:
            return None
        past = n * 3 // 4
        if n % 4 != 1 and past <= good and (past == len(data) or data[past] & 0xC0 != 0x80):
            return data[:past].decode("utf-8"), end, False
    return None


def _base64(run: str, left: int):
    """(first, last, text, offsets, inflated) of the base64 in a run; text None and a flow of bytes where it is oversize.

    Base64 may follow or precede other words, so it is tried from the beginning of the run, of each line and after each
    separator, the earliest first, and reaches as far as there is text, up to the end of the run, of a line or a
    separator. ``offsets`` are the places in the run of the characters of the base64.
    """
    bare = run.rstrip("=")
    breaks = list(_BREAK.finditer(bare))
    body = _BREAK.sub("", bare) if breaks else bare
    if breaks:
        keep = np.ones(len(bare), bool)
        for m in breaks:
            keep[m.start() : m.end()] = False
        place = np.flatnonzero(keep)
        lines = np.searchsorted(place, [m.end() for m in breaks]).tolist()
    else:
        place, lines = np.arange(len(bare)), []
    marks = [m.start() for m in _SEPARATOR.finditer(body)]
    starts = sorted({0, *lines, *(m + 1 for m in marks)})
    ends = sorted({*lines, *marks, len(body)})
    at = 0
    for start in starts:
        if start < at or len(body) - start < _SHORTEST:
            continue
        try:
            piece = _piece(body, start, ends, left)
        except _Oversize as large:
            yield int(place[start]), len(run), None, large.flow, True
            return
        if piece is None:
            continue
        text, at, inflated = piece
        if inflated:
            left -= len(text.encode())
        last = len(run) if at == len(body) else int(place[at - 1]) + 1
        yield int(place[start]), last, text, place[start:at], inflated


class _Reading:
    """What is known of a text while its layers are read."""

    def __init__(self, size: int):
        self.left = MAX_INFLATED + MORE_INFLATED * size
        self.found: set[tuple[int, int, int]] = set()
        self.large: dict[bytes, set[int]] = {}

    def read_large(self, run: str, flow: Iterator[bytes], begin: int, end: int) -> None:
        """A run stays in all later layers, but is read once."""
        key = _digest(run)
        if key not in self.large:
            self.large[key] = set()
            self.large[key] |= _kinds_in(flow)
        self.found |= {(begin, kind, end) for kind in self.large[key]}


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _packed(text: str) -> list[tuple[int, int, bytes]]:
    """(start, end, bytes) of escaped bytes that are compressed or two-byte characters."""
    found = []
    for m in _PACKED.finditer(text):
        data = bytes.fromhex(m[0].replace("\\x", "")) if m[0][0] == "\\" else unquote_to_bytes(m[0])
        if _wide(data) or (_machine(data) is not None and _unfolded(data[: 1 << 10])[1]):
            found.append((m.start(), m.end(), data))
    return found


def _end_of(text: str, start: int, end: int, size: int) -> int:
    """Where the first ``size`` bytes of an escaped run end."""
    if text[start] == "\\":
        return start + 4 * size
    at = start
    for _ in range(size):
        at += 3 if text[at] == "%" else 1
    return min(at, end)


def _next_layer(text: str, begin: np.ndarray | None, end: np.ndarray | None, reading: _Reading):
    """(text, begin, end) of the following layer, text None if nothing was decoded.

    ``begin`` and ``end`` are the range of the original for each character; None: its own place.
    """
    parts, at = [], 0
    begins, ends = [], []
    here = np.arange(len(text)) if begin is None else begin
    past = np.arange(1, len(text) + 1) if end is None else end
    escaped = "%" in text or "\\" in text or "&#" in text
    packed = _packed(text) if escaped else []
    # Escapes before compressed bytes end where these begin.
    starts = [a for a, _, _ in packed]
    matches = [(a, b, units) for a, b, units in (_escapes(text, starts) if escaped else [])]
    # A run beside an escape may go on in it, and is read in the next layer.
    opened, closed = {a for a, _, _ in matches}, {b for _, b, _ in matches}
    matches += [(m.start(), m.end(), None) for m in _RUN.finditer(text) if m.start() not in closed and m.end() not in opened]
    matches = packed + matches  # they win where both begin

    def put(a, b, new, first, last):
        nonlocal at
        parts.extend([text[at:a], new])
        begins.extend([here[at:a], np.asarray(first, np.int64)])
        ends.extend([past[at:a], np.asarray(last, np.int64)])
        at = b

    def put_whole(a, b, new):
        """Characters of which each may come from anywhere in the run."""
        reading.left -= len(new.encode("utf-8", "surrogatepass"))
        put(a, b, new, np.full(len(new), here[a]), np.full(len(new), past[b - 1]))

    for a, b, units in sorted(matches, key=lambda m: (m[0], -m[1])):
        if a < at:
            continue
        if isinstance(units, bytes):
            try:
                rest: list[bytes] = []
                new = _text(_kept(_unfolded(units, rest)[0], reading.left))
                if _sure(units, new):
                    put_whole(a, _end_of(text, a, b, len(units) - sum(map(len, rest))), new)
            except _Oversize as large:
                reading.read_large(text[a:b], large.flow, int(here[a]), int(past[b - 1]))
            continue
        if units is not None:
            put(
                a, b, "".join(c for c, _, _ in units), [int(here[a + s]) for _, s, _ in units],
                [int(past[min(a + e, b) - 1]) for _, _, e in units],
            )
            continue
        for low, high, new, place, inflated in _base64(text[a:b], reading.left):
            if new is None:
                reading.read_large(text[a + low : a + high], place, int(here[a + low]), int(past[a + high - 1]))
            elif inflated:
                put_whole(a + low, a + high, new)
            else:
                offs = np.cumsum([0, *(len(c.encode()) for c in new)])
                # Byte k of the run's bytes is told by characters k*4//3 to (k*4+3)//3 of it.
                first, last = place[offs[:-1] * 4 // 3], place[np.minimum((offs[1:] * 4 + 2) // 3, len(place)) - 1]
                put(a + low, a + high, new, here[a + first], past[a + last])
    if not parts:
        return None, None, None
    parts.append(text[at:])
    begins.append(here[at:])
    ends.append(past[at:])
    return "".join(parts), np.concatenate(begins), np.concatenate(ends)


def scan_layers(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], int, int]:
    """Base finds, finds of all layers as spans of the original, layers read, runs read in windows."""
    base = scan(text)
    reading, seen, layers = _Reading(len(text)), {_digest(text)}, 1
    layer, begin, end = text, None, None
    while True:
        layer, begin, end = _next_layer(layer, begin, end, reading)
        if layer is None or (told := _digest(layer)) in seen:
            return base, sorted({*base, *reading.found}), layers, len(reading.large)
        seen.add(told)
        layers += 1
        reading.found |= {(int(begin[a]), kind, int(end[b - 1])) for a, kind, b in scan(layer)}


def _joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind][0]}:{a}:{b}" for a, kind, b in found)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_spans, n_layers, n_oversize) of every row.

    The counts and the digest tell the finds in the text as it is; ``spans`` all finds, those in
    decoded layers included, as kind:start:end in characters of the original, by start, kind and end. ``n_oversize``
    counts the compressed runs that were read in windows, as they unfold to more than is kept.

    - A null text is read as empty, which has no finds and one layer.
    - Repeated rows are returned as often as they come; null ids stay null.
    - An empty table gives an empty table.
    """

    def find(batches):
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                base, found, layers, oversize = scan_layers(text or "")
                counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
                sha = hashlib.sha256(_joined(base).encode()).hexdigest()
                out.append((*counts, sha, _joined(found), len(found), layers, oversize))
            columns = list(zip(*out)) if out else [[]] * 8
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_spans", "n_layers", "n_oversize"],
            )

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        find, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string,"
        " spans string, n_spans bigint, n_layers bigint, n_oversize bigint",
    )
