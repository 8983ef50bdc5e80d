import numpy as np
import pyarrow as pa

from tallyloom.llm.ngram_jaccard import ngram_sets
from tallyloom.llm.words import SPACE, find_words, gram_hashes, pieces, word_hashes

TEXTS = ["", None, "a", " a  b\tc ", "x" * 3000, "Ein Öl é x\x1cy", "a b", "\n\n", "b"]


def test_words_are_those_of_split():
    got = []
    for first, last, data, bounds in pieces(pa.array(TEXTS).cast(pa.binary()), 64):
        starts, ends, at = find_words(data, bounds, SPACE)
        for row in range(last - first):
            got.append([bytes(data[a:b]) for a, b in zip(starts[at[row] : at[row + 1]], ends[at[row] : at[row + 1]])])
    assert got == [(t or "").encode().split() for t in TEXTS]


def test_hashes_tell_words_apart_and_ignore_place_and_case():
    column = pa.array(["Aa bb aA", "zz bb", "AA"])
    for _, _, data, bounds in pieces(column):
        starts, ends, at = find_words(data, bounds, SPACE)
        lower, exact = (word_hashes(data, starts, ends, lower=x) for x in (True, False))
    assert len(set(lower.tolist())) == 3 and lower[0] == lower[2] == lower[5] and lower[1] == lower[4]
    assert len(set(exact.tolist())) == 5
    assert gram_hashes(lower[[0, 1, 2, 0, 1]], 2).tolist()[0] == gram_hashes(lower[[2, 1]], 2)[0]


def test_sets_hold_distinct_ngrams():
    sets = list(ngram_sets(pa.array(["a b c a b c", "a b", "", None, "B A"]), 3))
    assert [len(s) for s in sets] == [3, 1, 0, 0, 1]
    assert all((np.diff(s.astype(object)) > 0).all() for s in sets)
