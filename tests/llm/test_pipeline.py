"""Stages of the corpus pipeline on small tables, against plain versions on each stage's own input."""

import itertools
import re
from collections import Counter

import pytest

import corpus_pipeline
from tallyloom.llm.language import identify
from tallyloom.llm.mixing import targets_of

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def corpus(shared):
    """Three languages of syllables, near copies, benchmark passages, junk; columns that clash with inner names."""
    import random

    rng = random.Random(8)
    parts = {lang: [rng.choice("bcdfglmnprst") + rng.choice("aeiou") + rng.choice(("", "n", "r")) for _ in range(40)]
             for lang in ("xx", "yy", "zz")}

    def words(lang, n):
        return ["".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)]

    items = [words("xx", 30) for _ in range(4)]
    rows = []
    for i in range(240):
        lang = ("xx", "yy", "zz")[i % 3]
        rows.append((" ".join(words(lang, rng.randint(50, 160))), lang if i % 5 else None, ("web", "book", "web", None)[i % 4]))
    for i in range(0, 60, 6):  # copies, exact and with a word changed
        rows.append(rows[i])
        changed = rows[i][0].split()
        changed[len(changed) // 2] = "other"
        rows.append((" ".join(changed), *rows[i][1:]))
    for i in range(8):  # a whole benchmark item in a short text or in a long one
        rows.append((" ".join(words("xx", 20 if i % 2 else 900) + items[i % 4] + words("xx", 10)), "xx", "web"))
    rows += [(None, "xx", "web"), ("", None, None), ("12 34 !", "xx", "web")] + [rows[0]]
    docs = [(i, t, lang, s, len(t or ""), f"c{i}", 1, 2, 3) for i, (t, lang, s) in enumerate(rows)]
    table = shared.createDataFrame(docs, DOCS + ", language string, _fp int, copies int, leader_id int").repartition(3)
    return table, [" ".join(i) for i in items]


def kept(before, after):
    assert after.columns == before.columns
    return Counter(r.doc_id for r in after.collect())


def test_language(shared, corpus):
    docs, _ = corpus
    told = {r.doc_id: (r.text, r.answer) for r in identify(docs, into="answer").collect()}
    after = corpus_pipeline.language(shared, docs, "")
    wanted = {i for i, (text, answer) in told.items() if re.search("[a-z]", text or "") and not answer.rejected}
    assert kept(docs, after) == Counter(wanted) and len(wanted) > 0.9 * docs.count()
    assert {r.language for r in after.collect()} == {f"c{i}" for i in wanted}


def test_near_copies(shared, corpus):
    docs, _ = corpus
    texts = {r.doc_id: (r.text or "").encode().lower().split() for r in docs.collect()}
    grams = {i: {tuple(w[n : n + 5]) for n in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, w in texts.items()}
    root = {i: i for i in grams}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(grams), 2):
        if grams[a] and 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b]):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    wanted = {i for i in root if find(i) == i}
    assert len(wanted) < len(texts) - 15
    assert kept(docs, corpus_pipeline.near_copies(shared, docs, "")) == Counter(wanted)


def test_decontamination(shared, corpus, tmp_path):
    docs, items = corpus
    shared.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    windows = {tuple(w[n : n + 13]) for w in map(str.split, items) for n in range(len(w) - 12)}
    wanted = set()
    for r in docs.collect():
        w = re.findall(r"[a-z0-9]+", (r.text or "").lower())
        hit = {n + k for n in range(len(w) - 12) if tuple(w[n : n + 13]) in windows for k in range(13)}
        if not hit or 20 * len(hit) < len(w):
            wanted.add(r.doc_id)
    assert 0 < docs.count() - len(wanted) < 8
    assert kept(docs, corpus_pipeline.decontamination(shared, docs, str(tmp_path))) == Counter(wanted)


def test_mixture(shared, corpus):
    docs, _ = corpus
    after = kept(docs, corpus_pipeline.mixture(shared, docs, ""))
    rows = docs.collect()
    sizes = {r.doc_id: len((r.text or "").split()) for r in rows}
    sources = ["book", "web", None]
    totals = [sum(sizes[r.doc_id] for r in rows if r.source == s) for s in sources]
    targets = targets_of(totals, [5, 2, 1], 1.5, 2.0)
    for source, target in zip(sources, targets):
        own = [r.doc_id for r in rows if r.source == source]
        assert abs(sum(after[i] * sizes[i] for i in own) - target) <= 2 * max(sizes.values())
    assert max(after.values()) <= 2 and all(sizes[i] for i in after)


def test_whole_run(shared, corpus, tmp_path):
    """Every stage's decisions take effect, one after the other."""
    docs, items = corpus
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    shared.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = shared.read.parquet(f"{tmp_path}/documents.parquet")
    for n, (name, function) in enumerate(corpus_pipeline.STAGES[:-1]):
        function(shared, stage, str(tmp_path)).write.parquet(f"{tmp_path}/{n}")
        stage = shared.read.parquet(f"{tmp_path}/{n}")
    wanted = Counter(r.doc_id for r in stage.collect())
    placed = corpus_pipeline.run(shared, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in placed) == wanted and len(wanted) > 150
    shards = Counter(r.shard for r in placed)
    assert sorted(shards) == list(range(16)) and max(shards.values()) - min(shards.values()) <= 1
    assert len({(r.shard, r.slot) for r in placed}) == len(placed)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_of_empty_and_odd_tables(shared, tmp_path, name):
    shared.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    empty = shared.createDataFrame([], DOCS)
    assert stage(shared, empty, str(tmp_path)).count() == 0 and stage(shared, empty, str(tmp_path)).columns == empty.columns
    rows = [(None,) * 5, (1, None, None, None, None), (1, "one two", None, None, 7), (1, "one two", None, None, 7), (2, "", "x", "s", 0)]
    after = [r.doc_id for r in stage(shared, shared.createDataFrame(rows, DOCS), str(tmp_path)).collect()]
    assert sorted(after, key=lambda i: (i is not None, i)) == {
        "language": [1, 1], "near_copies": [None, 1, 1, 2], "decontamination": [None, 1, 1, 1, 2], "mixture": [1, 1, 1],
    }[name]


def test_near_copies_tells_texts_of_one_id_apart(shared, prose):
    a, b, c = (" ".join(prose(100)) for _ in range(3))
    rows = [(1, a), (1, a), (1, b), (2, a + " end"), (3, b), (3, c), (4, "  "), (5, None), (None, a)]
    docs = shared.createDataFrame([(*r, 7, "x") for r in rows], "doc_id bigint, text string, fp int, group_id string")
    kept = corpus_pipeline.near_copies(shared, docs, "")
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(1, a), (1, b), (3, c), (4, "  "), (5, None), (None, a)], key=str
    )
    assert corpus_pipeline.near_copies(shared, docs.limit(0), "").count() == 0
