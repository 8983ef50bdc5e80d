"""Operator 11 against a plain version, and its edge cases."""

import hashlib
import json
from collections import defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tallyloom.llm import token_alignment
from tallyloom.llm.token_alignment import Aligner, alignment_counts, chunks, runs, token_groups

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    chars = {}
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    for byte in range(256):
        chars[byte] = chr(byte) if byte in own else chr(256 + sum(x not in own for x in range(byte)))
    bytes_of = {c: bytes([n]) for n, c in chars.items()}

    def tokens(text):
        left = [(i, text_bytes(a.id_to_token(i), i)) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        return left, right

    def text_bytes(entry, i):
        return b"".join(bytes_of[c] for c in entry)

    return tokens


def plain(texts, tokens):
    """Every pair of tokens of a text is looked at."""
    told, links = [], []
    for text in texts:
        left, right = tokens(text) if text else ([], [])
        whole = b" " + (text or "").encode()
        if not text or any(b"".join(x for _, x in side) != whole for side in (left, right)):
            told.append((0, 0, 0, "")), links.append([])
            continue
        spans = []
        for side in (left, right):
            at, own = 0, []
            for i, piece in side:
                own.append((i, at, at + len(piece)))
                at += len(piece)
            spans.append(own)
        cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups = []
        for start, end in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(i) for i, s, e in own if start <= s and e <= end) for own in spans))
        links.append([(i, j) for i, s, e in spans[0] for j, t, u in spans[1] if s < u and t < e])
        told.append((len(left), len(right), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    held = defaultdict(int)
    for own in links:
        for pair in set(own):
            held[pair] += 1
    top = defaultdict(int)
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    return [
        (n_a, n_b, n_groups, len(own), sum(held[p] == top[p[0]] for p in own), sum(held[p] for p in own), sha)
        for (n_a, n_b, n_groups, sha), own in zip(told, links)
    ]


TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "The quick brown fox", None, "", " ", "   leading and trailing  ",
    "\n\n\ttabs\tand\r\nlines", "naïve café über straße 你好世界 \U0001f600\U0001f468‍\U0001f469‍\U0001f467", "<|endoftext|> and </s> <s> <unk> <0x41>",
    "already ▁ a piece mark", "nul \x00 byte", "don't we'll I'M 12345 1,234.50 ___ ====", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "  wide spaces　here", "é decomposed ﬁ ligature Ω", "x" * 300 + " " * 40 + "y", "﻿bom �",
]


def columns(frame):
    return [tuple(r)[1:] for r in sorted(frame.collect(), key=lambda r: r.doc_id)]


def test_against_every_pair(spark, prose, encoders):
    texts = TEXTS + [" ".join(prose(prose.rng.randrange(1, 60))).capitalize() + "." for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    wanted = plain(texts, encoders)
    assert columns(alignment_counts(docs, A, B)) == wanted
    # Few pairs are sent, the links of the others are joined.
    assert columns(alignment_counts(docs, A, B, sent=50)) == wanted


def test_groups_join_to_the_text(spark, encoders):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    for row in token_groups(docs, A, B).collect():
        text = ";".join("|".join(",".join(map(str, side)) for side in group) for group in row.groups)
        assert (hashlib.sha256(text.encode()).hexdigest() if row.groups else "") == plain(
            [TEXTS[row.doc_id]], encoders)[0][-1]


def test_edges(spark):
    kinds = "doc_id bigint, text string, row bigint, pairs string, n_a string, `_pair` int"
    rows = [(1, "same text here", 1, None, "", 2), (1, "same text here", 1, None, "", 2), (None, "same", None, "x", None, None),
            (2, None, None, None, None, None), (3, "", 7, "", "", 0)]
    found = alignment_counts(spark.createDataFrame(rows, kinds), A, B).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_a > 0, len(r.groups_sha256)) for r in found) == [
        (False, 0, True, 64), (True, 1, True, 64), (True, 1, True, 64), (True, 2, False, 0), (True, 3, False, 0)]
    twice = [r for r in found if r.doc_id == 1]
    assert twice[0] == twice[1] and twice[0].count_sum > twice[0].n_links
    empty = alignment_counts(spark.createDataFrame([], "doc_id bigint, text string"), A, B)
    assert empty.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert empty.count() == 0


def test_long_texts_in_parts(prose, monkeypatch, encoders):
    text = " ".join(prose(4000)) + "\n" * 3 + "  " + " ".join(prose(2000)) + " " + "z" * 5000 + " It's over"
    whole = Aligner(A, B)
    found = next(whole.align([text]))
    monkeypatch.setattr(token_alignment, "CALL_CHARS", 300)
    assert len(chunks(text, 300)) > 50 and " ".join(chunks(text, 300)) == text
    parts = next(whole.align([text]))
    assert whole.digest(parts) == whole.digest(found) and len(parts.a_linked) == len(found.a_linked)
    left, right = encoders(text)
    assert [i for i, _ in left] == parts.a.tolist() and [i for i, _ in right] == parts.b.tolist()


def test_byte_level_agrees_with_its_library(prose, tmp_path):
    """Over odd characters and mixtures of them; also where the file is not one of plain merges."""
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    odd = [" ", "  ", "\n", "\t", "'s", "'ll", "'S", "\u00a0", "\u3000", "\x1c", "\x85", "a", "B", "é", "1", "²", "Ⅷ", "_", "!",
           "🙂", "中", "\u200d", "\u0301", "ß", "'", "\x00", "\u180e", "\ufeff", "<|endoftext|>"]
    texts = ["".join(prose.rng.choices(odd, k=prose.rng.randrange(1, 50))) for _ in range(3000)]
    texts += ["".join(f"a{chr(c)}{chr(c)} {chr(c)}1" for c in range(n, n + 50)) for n in range(0, 0xD7C0, 331)]
    wanted = [library.encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert token_alignment.ByteLevel(A).encode(texts) == wanted
    with open(A) as file:
        told = json.load(file)
    vocabulary = told["model"]["vocab"]
    vocabulary["Ġt"], vocabulary["Ġa"] = vocabulary["Ġa"], vocabulary["Ġt"]
    (tmp_path / "b.json").write_text(json.dumps(told))
    swap = {256: 257, 257: 256}
    other = token_alignment.ByteLevel(str(tmp_path / "b.json"))
    assert other.encode(texts[:50] + ["at the table"]) == [
        [swap.get(i, i) for i in ids] for ids in wanted[:50] + [library.encode(" at the table").ids]]
    assert other.pieces[256] == b" a"


def test_runs(prose):
    for n in range(400):
        last = prose.rng.randrange(1, 60 if n % 2 else 400)
        a = sorted({*prose.rng.sample(range(1, last + 1), prose.rng.randrange(last)), last})
        b = sorted({*prose.rng.sample(range(1, last + 1), prose.rng.randrange(last)), last})
        if n % 4 > 1:  # long one-to-one stretches
            b = sorted({*(set(a) ^ set(prose.rng.sample(range(1, last + 1), min(last, 3)))), last})
        both = sorted(set(a) & set(b))
        ends = []
        for i0, i1, j0, j1 in runs(a, b):
            ends += a[i0:i1] if a[i0] == b[j0] else [a[i1 - 1]]
            assert a[i1 - 1] == b[j1 - 1]
        assert ends == both
