"""Operators 1, 2, 4, 6, 7 and 9 against plain versions, and their edge cases."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyloom.llm.decontaminate import find_benchmark
from tallyloom.llm.mixing import mix, targets_of
from tallyloom.llm.near_vectors import near_vectors
from tallyloom.llm.ngram_jaccard import jaccard_groups
from tallyloom.llm.sharding import interleave
from tallyloom.llm.substring_dedup import remove_repeats

DOCS = "doc_id bigint, text string, lang string, source string, label string"


def frame(spark, texts, sources=None):
    sources = sources or [None] * len(texts)
    return spark.createDataFrame([(i, t, "en", s, "x") for i, (t, s) in enumerate(zip(texts, sources))], DOCS)


def edges(spark, prose):
    """Nulls in every column, empty and long texts, repeated rows, a repeated id."""
    long = " ".join(prose(9000))
    rows = [(1, None, None, None, None), (2, "", "en", "s", ""), (3, long, "en", "s", ""), (3, long, "en", "s", ""),
            (4, long + " end", None, None, None), (None, long, "en", "s", ""), (5, "one", "en", "s", ""),
            (5, "other words here", "en", "t", ""), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def linked(ids, pairs):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def family(prose):
    """A text, its copies, near copies of all degrees, and unlike texts around a shared passage."""
    base, passage = prose(220), prose(30)
    texts = [" ".join(base)] * 5
    for _ in range(110):
        words = list(base)
        for _ in range(prose.rng.choice([1, 2, 3, 4, 5, 6, 9, 14])):
            words[prose.rng.randrange(len(words))] = prose(1)[0] + str(prose.rng.randrange(10**6))
        texts.append(" ".join(words[prose.rng.choice([0, 0, 0, 5]) :]))
    texts += [" ".join(prose(10) + passage + prose(60)) for _ in range(40)]
    texts += [" ".join(prose(3) + passage) for _ in range(40)]
    texts += ["two words", "Two  WORDS", "", " ", "single"]
    prose.rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_jaccard_groups(shared, prose, words, percent):
    texts = family(prose)
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower())
        grams = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}
        sets.append(grams or ({tuple(w)} if w else set()))
    pairs = [
        (a, b) for a, b in itertools.combinations(range(len(sets)), 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    want = linked(range(len(sets)), pairs)
    assert len(pairs) > 200
    got = jaccard_groups(frame(shared, texts), words=words, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), want[i]) for i, s in enumerate(sets)}


def test_jaccard_edges(shared, prose):
    got = jaccard_groups(edges(shared, prose)).collect()
    assert sorted(((r.doc_id, r.component_id, r.n_shingles > 0) for r in got), key=str) == sorted([
        (1, 1, False), (2, 2, False), (3, 3, True), (3, 3, True), (4, 3, True), (None, None, True), (5, 5, True),
        (5, 5, True), (None, None, False)], key=str)
    assert jaccard_groups(edges(shared, prose).limit(0)).count() == 0


def test_remove_repeats(shared, prose):
    passage, longer = prose(50), prose(400)
    texts = [" ".join(prose(20) + passage + prose(20)) for _ in range(30)]
    texts += [" ".join(longer), " ".join(prose(7) + longer[30:390]), " ".join(longer), " ".join(passage * 3), "a b", ""]
    texts += [" ".join(prose(49)), " ".join(passage[:49])]
    first = {}
    split = [t.encode().split() for t in texts]
    for i, w in enumerate(split):
        for at in range(len(w) - 49):
            first.setdefault(tuple(w[at : at + 50]), i)
    got = {r.doc_id: r for r in remove_repeats(frame(shared, texts)).collect()}
    for i, w in enumerate(split):
        gone = {j for at in range(len(w) - 49) if first[tuple(w[at : at + 50])] < i for j in range(at, at + 50)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (
            len(w), len(gone), hashlib.sha256(kept).hexdigest()), i
        assert {j for s in got[i].removed for j in range(s.start, s.end)} == gone
    # Doubling goes on until nothing survives: 360 shared words hold windows of 50, 100 and 200.
    assert [got[i].longest_repeat for i in (0, 30, 31, 32, 34)] == [50, 400, 200, 400, 0]
    short = {r.doc_id: r.n_removed for r in remove_repeats(frame(shared, texts), longest=50).collect()}
    assert short == {i: r.n_removed for i, r in got.items()}


def test_remove_repeats_edges(shared, prose):
    got = [(r.doc_id, r.n_words, r.n_removed) for r in remove_repeats(edges(shared, prose)).collect()]
    assert sorted(got, key=str) == sorted([
        (1, 0, 0), (2, 0, 0), (3, 9000, 0), (3, 9000, 0), (4, 9001, 9000), (None, 9000, 0), (5, 1, 0), (5, 3, 0),
        (None, 0, 0)], key=str)
    assert remove_repeats(edges(shared, prose).limit(0)).count() == 0


def test_near_vectors(shared):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 32))
    near = base[:20].repeat(6, 0) + rng.standard_normal((120, 32)) * 0.2
    x = np.concatenate([base, near, base[:5]])
    label = [int(i) for i in rng.integers(0, 3, len(x))]
    rows = [(i, [float(v) for v in x[i]], label[i], "x") for i in range(len(x))]
    bad = [[], None, [0.0] * 32, [float("nan")] * 32, [None] + [1.0] * 31, [1.0, 2.0], [float("inf")] * 32]
    rows += [(1000 + i, v, 0, "x") for i, v in enumerate(bad)] + [(2000, rows[0][1], None, "x"), (None, rows[0][1], label[0], "x")]
    table = shared.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, node string")
    got = {r.vec_id: r for r in near_vectors(table).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cos = unit @ unit.T
    pairs = [(a, b) for a, b in itertools.combinations(range(len(x)), 2) if label[a] == label[b] and cos[a, b] >= 0.93]
    links = Counter(i for p in pairs for i in p)
    found = sum(got[i].n_links for i in range(len(x)))
    assert 0.97 * 2 * len(pairs) <= found <= 2 * len(pairs) and len(pairs) > 100
    assert all(got[i].n_links <= links[i] for i in range(len(x)))
    if found == 2 * len(pairs):
        assert {i: got[i].component_id for i in range(len(x))} == linked(range(len(x)), pairs)
    assert all(got[i].kept == (got[i].component_id == i) for i in range(len(x)))
    for i in [*range(1000, 1007), 2000]:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert near_vectors(table.limit(0)).count() == 0


def test_targets():
    assert targets_of([10, 100, 1000], [5, 2, 1], 1.5, 2.0) == [20.0, 200.0, 1445.0]
    assert targets_of([100, 100], [1, 1], 1.5, 2.0) == [150.0, 150.0]
    assert targets_of([0, 7], [5, 2], 1.5, 2.0) == [0.0, 10.5]
    assert targets_of([], [], 1.5, 2.0) == []


def test_mix(shared, prose):
    sources = ["a"] * 150 + ["b"] * 60 + [None] * 40 + ["é"] * 9
    texts = [" ".join(prose(prose.rng.randint(0, 200))) for _ in sources]
    docs = frame(shared, texts, sources)
    got = mix(docs, block_words=64).collect()
    again = mix(docs.repartition(5), block_words=64).collect()
    key = lambda r: r.doc_id
    assert sorted(got, key=key) == sorted(again, key=key)
    taken, sizes, target = Counter(), Counter(), {}
    for r in got:
        assert r.size == len(texts[r.doc_id].split()) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        sizes[r.source] += r.size
        target[r.source] = r.target
    order = ["a", "b", "é", None]
    assert [target[s] for s in order] == targets_of([sizes[s] for s in order], [5, 2, 1, 5], 1.5, 2.0)
    assert all(int(target[s]) == taken[s] for s in order)
    # Any half of the schedule has about half of every source.
    last = max(r.first_slot for r in got if r.first_slot is not None)
    assert last > 100


def md5(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def plain_mix(rows, weights, share, most, block):
    """{id: (taken, first slot)} of (id, text, source): streams laid out word by word, the schedule slot by slot."""
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    totals = [sum(sizes[i] for i, _, s in rows if s == source) for source in sources]
    targets = targets_of(totals, [weights[n % len(weights)] for n in range(len(sources))], share, most)
    words = [[] for _ in sources]  # the id of every word of a source's stream
    for n, source in enumerate(sources):
        for epoch in (0, 1):
            for i in sorted((i for i, _, s in rows if s == source), key=lambda i: md5("mix", epoch, i)):
                words[n] += [i] * sizes[i]
        words[n] = words[n][: int(targets[n])]
    blocks = [-(-len(w) // block) for w in words]
    slots, used, total = {}, [0] * len(sources), sum(blocks)
    for slot in range(total):
        point = int(f"{slot:040b}"[::-1], 2) / 2**40
        n = next((n for n in range(len(sources)) if point < sum(blocks[: n + 1]) / total), len(sources) - 1)
        slots[n, used[n]] = slot
        used[n] += 1
    out = {i: (0, None) for i, *_ in rows}
    for n, stream in enumerate(words):
        for at, i in enumerate(stream):
            slot = slots.get((n, at // block), total + at // block)
            taken, first = out[i]
            out[i] = (taken + 1, slot if first is None else min(first, slot))
    return out


@pytest.mark.parametrize("block", [7, 64])
def test_mix_agrees_with_a_plain_schedule(shared, prose, block):
    sources = ["a"] * 40 + ["b"] * 25 + [None] * 13 + ["é"] * 6 + ["tiny"]
    texts = [" ".join(prose(prose.rng.randint(0, 60))) if prose.rng.random() < 0.95 else None for _ in sources]
    got = {r.doc_id: (r.taken, r.first_slot) for r in mix(frame(shared, texts, sources), block_words=block).collect()}
    rows = [(i, t, s) for i, (t, s) in enumerate(zip(texts, sources))]
    assert got == plain_mix(rows, (5, 2, 1), 1.5, 2.0, block)


def test_interleave_agrees_with_a_plain_placement(shared, prose):
    sources = ["a"] * 90 + ["b"] * 45 + [None] * 11 + [f"s{i}" for i in range(7)]
    rows = list(enumerate(sources))
    places = []
    for source in set(sources):
        own = sorted((i for i, s in rows if s == source), key=lambda i: md5("shard", i))
        offset = (int(md5("shard", source or "")[:7], 16) + 0.5) / 2**28
        places += [((rank + offset) / len(own), source is None, (source or "").encode(), md5("shard", i), i) for rank, i in enumerate(own)]
    wanted, seen = {}, Counter()
    for position, (*_, i) in enumerate(sorted(places)):
        shard = position * 6 // len(rows)
        wanted[i] = (shard, seen[shard])
        seen[shard] += 1
    texts = [" ".join(prose(3)) for _ in rows]
    clash = frame(shared, texts, sources).selectExpr("*", "1 AS rank", "'x' AS place", "2 AS part", "3 AS key", "4 AS n")
    got = {r.doc_id: (r.shard, r.slot) for r in interleave(clash, shards=6).collect()}
    assert got == wanted


def test_mix_edges(shared, prose):
    got = mix(edges(shared, prose)).collect()
    assert len(got) == 9 and sum(r.taken for r in got) > 27000
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert mix(edges(shared, prose).limit(0)).count() == 0


def test_find_benchmark(shared, prose):
    items = [prose(20) for _ in range(6)] + [prose(4), prose(30)]
    bench = shared.createDataFrame(
        [(i, ", ".join(w).title()) for i, w in enumerate(items)] + [(99, None), (98, "..."), (None, "lost"), (50, " ".join(items[0]))],
        "item_id bigint, text string",
    )
    texts = [" ".join(prose(100)) for _ in range(10)]
    texts += [" ".join(prose(100) + items[0][:13]), " ".join(prose(30) + items[1] + items[2][3:18]), " ".join(items[6]),
              " ".join(prose(100) + items[3][:12]), "", "Ä" + " ".join(prose(300) + items[7]).upper()]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for r in bench.collect():
        w = word.findall((r.text or "").lower()) if r.item_id is not None else []
        n = min(13, len(w))
        for at in range(len(w) - n + 1):
            if n:
                windows[tuple(w[at : at + n])].add(str(r.item_id))
    got = {r.doc_id: r for r in find_benchmark(frame(shared, texts), bench).collect()}
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    for i, t in enumerate(texts):
        w = word.findall(lower(t))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for at in range(len(w) - n + 1):
                if (key := tuple(w[at : at + n])) in windows:
                    hit |= set(range(at, at + n))
                    found |= windows[key]
        r = got[i]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (len(w), len(hit), len(found), sha)
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
        assert sum(len(word.findall(lower(t[s.start : s.end]))) for s in r.spans) == len(hit)
    assert sum(r.n_hit > 0 for r in got.values()) == 4


def test_find_benchmark_in_blocks(shared, prose, monkeypatch):
    items = [" ".join(prose(20)) for _ in range(8)]
    docs = frame(shared, [" ".join(prose(9)) + " " + t for t in items] + [None])
    bench = shared.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    whole = sorted(find_benchmark(docs, bench).drop("fp").collect())
    monkeypatch.setattr("tallyloom.llm.decontaminate.BLOCK_CHARS", 1000)
    assert sorted(find_benchmark(docs, bench).drop("fp").collect()) == whole
    assert find_benchmark(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert find_benchmark(docs.limit(0), bench).count() == 0
    assert find_benchmark(edges(shared, prose), bench).count() == 9


def test_interleave(shared, prose):
    sources = ["a"] * 300 + ["b"] * 150 + [None] * 37 + [f"s{i}" for i in range(40)]
    texts = [" ".join(prose(3)) + "é" for _ in sources]
    got = interleave(frame(shared, texts, sources), shards=8).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(got) == 527 and sorted(slots) == list(range(8)) and set(map(len, slots.values())) <= {65, 66}
    for source, n in (("a", 300), ("b", 150), (None, 37)):
        share = Counter(r.shard for r in got if r.source == source)
        # The 40 sources of one row each, which lie at random, shift the cuts by a few rows.
        assert all(abs(share[s] - n / 8) <= 6 for s in range(8))


def test_interleave_edges(shared, prose):
    got = interleave(edges(shared, prose), shards=4).collect()
    assert len(got) == 9 and sum(r.size == 1 for r in got) == 3
    assert interleave(edges(shared, prose).limit(0), shards=4).count() == 0
