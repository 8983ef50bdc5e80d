"""Operators 3, 5, 8 and 10 and the registration of the queries."""

import base64
import bz2
import gzip
import itertools
import lzma
import math
import re
import textwrap
import time
import zlib
from collections import Counter
from urllib.parse import quote, unquote_to_bytes

import __spark_entry__ as entry
import corpus_pipeline
from tallyloom.llm import licences
from tallyloom.llm.language import identify
from tallyloom.llm.licences import TEMPLATES, background, scan_licences
from tallyloom.llm.secrets_scan import KINDS, find_secrets, scan, scan_layers
from tallyloom.llm.url_rules import DEVIATIONS, MIN_LABELS, judge

DOCS = "doc_id bigint, text string, lang string"
SECRET = "password=hunter2secret"


def plain_scan(text):
    return sorted(
        (m.start(), k, m.end())
        for k, (_, pattern, group, least) in enumerate(KINDS)
        for m in pattern.finditer(text) if len(m[group]) >= least
    )


def test_scan_agrees_with_the_patterns():
    for text in ("", SECRET, "Token: \"abc\" API-key apikey='0123456'", "x AKIA" + "A" * 16 + " " + "0af" * 9,
                 "secret: token: abcdefg", "ſecret=abcdefgh", "AKIAB " * 3):
        assert scan(text) == plain_scan(text)


def test_layers_map_to_the_original():
    inner = base64.b64encode(SECRET.encode()).decode()
    packed = base64.b64encode(zlib.compress(f"x {SECRET} y".encode())).decode()
    for text in (f"a {quote(SECRET)} b", f"a {inner} b", f"a {packed} b", f"a {base64.b64encode(inner.encode()).decode()} b",
                 "a " + "".join(f"\\u{ord(c):04x}" for c in SECRET) + " b"):
        base, found, layers, _ = scan_layers(text)
        assert base == [] and len(found) == 1 and layers >= 2
        begin, kind, end = found[0]
        assert kind == 0 and begin >= 2 and end <= len(text) - 2
    assert scan_layers("%25%32%35" * 3)[2] < 10


def test_base64_beside_separators_and_in_lines():
    inner = base64.b64encode(SECRET.encode()).decode()
    bare = inner.rstrip("=")
    for text, begin, end in (
        (f"DATA={inner}", 5, 35), (f"https://h.io/?d={inner}&x=1", 16, 46), (f"see io/x/{inner}", 9, 39),
        (f"x-{inner}", 2, 32), (f"x_{inner}", 2, 32), (f"{bare}-x", 0, 32), (f"/{bare}/x", 1, 33),
        (f"https://h.io/?d={quote(bare)}%3D%3D", 16, 46),
    ):
        found = scan_layers(text)[1]
        assert any(kind == 0 and a == begin and end - 2 <= b <= len(text) for a, kind, b in found), text
    assert (0, 0, 41) in scan_layers(f"password={inner}")[1] and len(scan_layers(f"password={inner}")[1]) > 1
    words = " ".join(f"{i * i * 7919:x}" for i in range(200))
    packed = base64.b64encode(gzip.compress(f"{words} {SECRET} {words}".encode())).decode()
    across = base64.b64encode(f"{'a ' * 22}{SECRET} {words}".encode()).decode()
    for whole in (packed, across):
        for end in ("\n", "\r\n"):
            lines = [whole[i : i + 76] for i in range(0, len(whole), 76)]
            text = end.join(["Some words before", *lines, "words after it"])
            found = scan_layers(text)[1]
            assert [kind for _, kind, _ in found] == [0] and len("Some words before") < found[0][0] < found[0][2]
            assert found[0][2] <= len(text) - len("words after it")


def test_compressed_runs_unfold_up_to_a_bound(monkeypatch):
    packed = [base64.b64encode(zlib.compress(f"{i} {SECRET}{i} {'x ' * 300}".encode())).decode() for i in range(3)]
    text = f"a {packed[0]} b {packed[1]} c {packed[2]}"
    assert [len(x) if isinstance(x, list) else x for x in scan_layers(text)[1:]] == [3, 2, 0]
    monkeypatch.setattr("tallyloom.llm.secrets_scan.MAX_INFLATED", 1300)
    monkeypatch.setattr("tallyloom.llm.secrets_scan.MORE_INFLATED", 0)
    # The last is read in windows instead, which end inside its words.
    monkeypatch.setattr("tallyloom.llm.secrets_scan.WINDOW", 100)
    monkeypatch.setattr("tallyloom.llm.secrets_scan.OVERLAP", 40)
    base, found, layers, oversize = scan_layers(text)
    assert (len(found), layers, oversize) == (3, 2, 1)
    assert found[2] == (text.index(packed[2]), 0, len(text))


ENCODERS = {
    "base64": lambda b: base64.b64encode(b), "url": lambda b: "".join(f"%{x:02X}" for x in b).encode(),
    "quote": lambda b: quote(b, safe="").encode(), "hex": lambda b: "".join(f"\\x{x:02x}" for x in b).encode(),
}
PACKERS = {
    "gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress,
    "members": lambda b: gzip.compress(b[:9]) + gzip.compress(b[9:]), "cut": lambda b: gzip.compress(b + bytes(range(256)) * 40)[:-40],
    "wide": lambda b: b.decode().encode("utf-16"), "nul": lambda b: gzip.compress(b"\0" + b + b" \0"),
}


def plain_layers(data):
    """All that comes of some bytes by trying every decoder on the whole of it, again and again."""
    decoders = [
        lambda b: base64.b64decode(b, validate=True), unquote_to_bytes, lambda b: bytes.fromhex(b.decode().replace("\\x", "")),
        gzip.decompress, zlib.decompress, bz2.decompress, lzma.decompress, lambda b: zlib.decompressobj(47).decompress(b),
        lambda b: b.decode("utf-16").encode() if b[:2] in (b"\xff\xfe", b"\xfe\xff") else b"",
    ]
    seen, waiting = set(), [data]
    while waiting:
        layer = waiting.pop()
        if layer in seen or not layer or len(seen) > 3000:
            continue
        seen.add(layer)
        for decode in decoders:
            try:
                waiting.append(decode(layer))
            except (ValueError, OSError, EOFError, zlib.error, lzma.LZMAError):
                pass
    return seen


def test_random_nestings_agree_with_a_plain_decoder(prose):
    rng = prose.rng
    for n in range(400):
        secret = (f"password=hunter{n:05}", "AKIA" + "Q" * 16 + f"{n:04}", f"{n:024x} " + "x" * 20)[n % 3].encode()
        data = b"some words " + secret + b" more of them"
        for _ in range(rng.randrange(1, 5)):
            if rng.random() < 0.5:
                # The plain decoder can't take anything around an encoded text away.
                name = rng.choice([p for p in PACKERS if b" words " in data or p not in ("cut", "nul")])
                data = PACKERS[name](data)
                if name != "wide" and rng.random() < 0.4:
                    data = gzip.compress(data)
            data = ENCODERS[rng.choice(["base64", *ENCODERS])](data)
        if len(data) > 60_000:
            continue
        wanted = {k for layer in plain_layers(data) for _, k, _ in plain_scan(layer.decode("utf-8", "replace"))}
        assert n % 3 in wanted
        text = f"before it {data.decode()} after it"
        _, found, _, oversize = scan_layers(text)
        inside = [(a, k, b) for a, k, b in found if k == n % 3]
        assert inside and oversize == 0, (n, text[:80])
        assert all(10 <= a < b <= len(text) - 9 for a, _, b in inside)


def test_chains_and_bombs_take_linear_time():
    began = time.process_time()
    for text in ("%" + "25" * 100_000, "&#38;" + "#38;" * 50_000, "\\x5c" + "x5c" * 60_000, "%25%32%35" * 20_000):
        assert scan_layers(text + " end")[2] < 20
    for n in (3, 15, 16, 40):
        found = scan_layers("%" + "25" * n + "41KIA" + "B" * 20)[1]
        assert [f for f in found if f[1] == 1] == [(0, 1, 26 + 2 * n)]
    quine = base64.b64encode(gzip.compress(gzip.compress(b"\0" * 40_000_000 + SECRET.encode()))).decode()
    assert scan_layers(f"a {quine} b")[1:] == ([(2, 0, 2 + len(quine))], 1, 1)
    assert time.process_time() - began < 60


def test_find_secrets_edges(shared):
    rows = [(1, None, None), (None, SECRET, None), (2, "", "en"), (3, "é" * 50_000 + SECRET, "en")]
    got = {r.doc_id: r for r in find_secrets(shared.createDataFrame(rows, DOCS)).collect()}
    assert (got[1].n_assign, got[2].spans, got[None].n_assign) == (0, "", 1)
    assert got[3].spans == f"assign:50000:{50000 + len(SECRET)}"
    kinds = "spans string, doc_id bigint, text string, n_assign int, layer string"
    empty = find_secrets(shared.createDataFrame([], kinds))
    assert empty.count() == 0 and empty.columns[0] == "doc_id"
    twice = find_secrets(shared.createDataFrame([("x", 1, SECRET, 9, ""), ("x", 1, SECRET, 9, "")], kinds)).collect()
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0].n_assign == 1


def test_language(shared, prose):
    letters = {"xx": "abcdé", "yy": "mnopü", "zz": "rstuñ"}
    rows = []
    for i in range(240):
        lang = ("xx", "yy", "zz")[i % 3]
        words = ["".join(prose.rng.choice(letters[lang]) for _ in range(5)) for _ in range(prose.rng.randint(3, 60))]
        rows.append((i, " ".join(words), lang))
    rows += [(1000, None, "xx"), (1001, "12 34 !", "xx"), (1002, "", None), (None, "abcd abcd", None)]
    got = {r.doc_id: r for r in identify(shared.createDataFrame(rows, DOCS)).collect()}
    held = [r for r in got.values() if r.language.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert len(held) > 50 and all(r.language.lang_pred == r.lang and 0 < r.language.score <= 1 for r in held)
    assert not any(r.language.rejected for r in held)
    assert all((got[i].language.lang_pred, got[i].language.score) == ("und", 0.0) for i in (1000, 1001, 1002))
    nothing = identify(shared.createDataFrame([(0, "abc", None)], DOCS)).first()
    assert nothing.language.lang_pred == "und"


def test_language_rejects_what_it_did_not_learn(shared, prose):
    rng = prose.rng

    def syllables():
        return [rng.choice("bcdfglmnprst") + rng.choice("aeiou") + rng.choice(("", "n", "r", "s")) for _ in range(30)]

    def text(parts):
        return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(40, 300)))

    known, unlearned = {lang: syllables() for lang in ("xx", "yy", "zz")}, syllables()
    rows = [(i, text(known[lang]), lang) for i, lang in enumerate(["xx", "yy", "zz"] * 120)]
    # An odd labelled text must not open the bound for all.
    rows += [(i, text(list("abcdefghijklmnopqrstuvwxyz")), "xx") for i in (360,)]
    rows += [(1000 + i, text(unlearned), None) for i in range(40)]
    rows += [(2000 + i, text(list("abcdefghijklmnopqrstuvwxyz")), None) for i in range(40)]
    rows += [(3000 + i, text(list("бвгджзклмнпрстаеиоу")), None) for i in range(40)]
    got = [(r.doc_id, r.lang, r.language) for r in identify(shared.createDataFrame(rows, DOCS)).collect()]
    held = [told for i, _, told in got if i < 360 and told.held_out]
    assert len(held) > 80 and sum(told.rejected for told in held) <= len(held) // 50
    assert all(told.rejected for i, _, told in got if i >= 1000)


def test_url_rules(shared):
    urls = {
        1: ("https://A.Example.com/en/1", "a.example.com", "/en/1", "example.com/en/", "block"),
        2: ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        3: ("http://x.net/es/q?z#k", "x.net", "/es/q", "net/es/", "block"),
        4: ("http://x.org?u=http://y.com/", "x.org", "", None, "allow"),
        5: (None, "", "", None, "allow"),
        6: ("no scheme", "", "", None, "allow"),
        7: ("http://com/a", "com", "/a", "com/", "allow"),
        8: ("http://notcom", "notcom", "", None, "allow"),
    }
    rows = [(i, u[0]) for i, u in urls.items()] + [(100 + i, f"http://h{i % 5}.org/{'spam' if i % 2 else 'ham'}/{i}") for i in range(200)]
    labels = [(100 + i, 0 if i % 2 else 1, 0) for i in range(200)] + [(None, 0, 1), (5, None, None)]
    got = {r.page_id: r for r in judge(
        shared.createDataFrame(rows, "page_id bigint, url string"),
        shared.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    ).collect()}
    for i, want in urls.items():
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want[1:]
    assert all(got[100 + i].verdict == ("block" if i % 2 else "allow") for i in range(200))


def brute_mined(urls, support, lift):
    """{url: confidence of its surest rule} by counting every combination of tokens of every labelled URL."""
    urls_of = Counter()
    blocks_of = Counter()
    labelled = [(tokens, block) for tokens, block in urls if block is not None]
    rate, least = sum(b for _, b in labelled) / len(labelled), max(MIN_LABELS, math.ceil(support * len(labelled)))
    for tokens, block in labelled:
        for n in range(1, len(tokens) + 1):
            for items in itertools.combinations(sorted(tokens), n):
                urls_of[items] += 1
                blocks_of[items] += block
    sure = {}
    for items, n in urls_of.items():
        p, z = blocks_of[items] / n, DEVIATIONS
        low = (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        if n >= least and p >= lift * rate and low > rate:
            sure[frozenset(items)] = p
    return [max((p for items, p in sure.items() if items <= tokens), default=None) for tokens, _ in urls]


def test_mined_rules_agree_with_brute_force(shared, prose):
    rng = prose.rng
    rows, labels, urls = [], [], []
    for i in range(900):
        host, section, word, other = rng.choice("abc"), rng.choice(["news", "win"]), rng.choice(["x", "y", "z"]), rng.choice(["p", "q"])
        twin = "/t-u" if host == "a" else ""  # two tokens always together
        url = f"http://{host}.org/{section}/{word}/{other}{twin}/{i}"
        bad = {("win", "x"): 0.9, ("news", "z"): 0.55}.get((section, word), 0.15) + (0.1 if host == "b" else 0)
        block = int(rng.random() < bad) if i % 3 else None
        tokens = {"host0:org", f"host1:{host}", f"path:{section}", f"path:{word}", f"path:{other}", "path:#", "end:"}
        tokens |= {"path:t", "path:u"} if twin else set()
        rows.append((i, url, "clash", 1.0))
        urls.append((frozenset(tokens), block))
        if block is not None:
            labels.append((i, 1 - block, 0))
            if i % 2:
                labels.append((i, 1, 0))  # a second, milder one
    pages = shared.createDataFrame(rows, "page_id bigint, url string, tokens string, mined double").repartition(4)
    found = judge(pages, shared.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), rules=(), support=0.02)
    got = {r.page_id: r for r in found.collect()}
    wanted = brute_mined(urls, 0.02, 1.2)
    assert sum(w is not None for w in wanted) > 200 and None in wanted
    for i, confidence in enumerate(wanted):
        assert (got[i].mined is None) == (confidence is None) and got[i].verdict == ("allow" if confidence is None else "block")
        assert confidence is None or abs(got[i].mined - confidence) < 1e-9


def test_rules_of_tokens_beyond_a_basket(shared, prose):
    """Every URL has over ten tokens that block more often than u or v alone; u and v together block nearly always."""
    rng = prose.rng
    rows, labels, urls = [], [], []
    for i in range(500):
        words = {f"w{w}" for w in "abcdefghijklmnop" if rng.random() < 0.7}
        hits = {t for t in "uv" if rng.random() < 0.4}
        block = int(rng.random() < {2: 0.95, 1: 0.04, 0: 0.7}[len(hits)])
        rows.append((i, f"http://h.org/{'/'.join(sorted(words | hits))}/{i}"))
        labels.append((i, 1 - block, 0))
        urls.append((frozenset(words | hits), block))
    found = judge(
        shared.createDataFrame(rows, "page_id bigint, url string"), shared.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
        rules=(), support=0.12,
    )
    got = {r.page_id: r.mined for r in found.collect()}
    wanted = brute_mined(urls, 0.12, 1.2)
    assert sum(w is not None for w in wanted) > 40
    for i, confidence in enumerate(wanted):
        assert (got[i] is None) == (confidence is None) and (confidence is None or abs(got[i] - confidence) < 1e-9)


def test_long_urls_labelled_often_end_soon(shared):
    long = "http://spam.example.org/" + "/".join(f"w{chr(97 + i % 26)}{'x' * i}" for i in range(30))
    rows = [(i, long) for i in range(60)] + [(100 + i, f"{long}/{i}?k{i % 7}=1") for i in range(60)]
    # Each lacks one of the parts, so that no two tokens are in the very same URLs.
    parts = long[7:].split("/")
    rows += [(200 + i, "http://" + "/".join(p for n, p in enumerate(parts) if n != 1 + i % 30) + f"/{i}") for i in range(60)]
    rows += [(300 + i, f"http://h{i}.com/a{i}") for i in range(200)]
    labels = [(i, 0, 0) for i, _ in rows if i < 300] + [(300 + i, 1, 0) for i in range(200)]
    began = time.time()
    found = judge(
        shared.createDataFrame(rows, "page_id bigint, url string"), shared.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
        rules=(),
    ).collect()
    assert all(r.verdict == ("block" if r.page_id < 300 else "allow") for r in found) and len(found) == len(rows)
    assert time.time() - began < 90


def test_url_filter_edges(shared):
    kinds, labelled = "page_id bigint, url string, host int, token string", "doc_id bigint, quality int, toxic int"
    none = shared.createDataFrame([], kinds), shared.createDataFrame([], labelled)
    assert judge(*none).count() == 0
    rows = [(1, "http://a.com/x", 1, None), (1, "http://a.com/x", 1, None), (None, "http://b.net/es/", None, ""), (2, None, None, None), (3, "", 0, "")]
    found = judge(shared.createDataFrame(rows, kinds), none[1])
    assert sorted((r.page_id or 0, r.host, r.verdict) for r in found.collect()) == [
        (0, "b.net", "block"), (1, "a.com", "allow"), (1, "a.com", "allow"), (2, "", "allow"), (3, "", "allow")]


def test_licences(shared, prose):
    rows = [(i, "\n".join(" ".join(prose(20)) for _ in range(4)), "en") for i in range(60)]
    rows += [(100 + i, " ".join(prose(20)) + f"\n{text}\n", "en") for i, (_, text) in enumerate(TEMPLATES)]
    rows += [(500, None, None), (501, "", "en")]
    got = {r.doc_id: r for r in scan_licences(shared.createDataFrame(rows, DOCS)).collect()}
    assert all(got[i].n_licence == 0 for i in [*range(60), 500, 501])
    assert all(got[100 + i].confirmed == family for i, (family, _) in enumerate(TEMPLATES))


def test_licence_model_sees_every_paragraph(shared):
    """8,100 texts, each of a length or of template words of its own: all are in the model's rows, copies once."""
    known = sorted({w for _, text in TEMPLATES for w in re.findall("[a-z]+", text.lower())} - {"license", "licensed", "permission", "permitted"})
    known = [w for w in known if not re.search("licen|copyright|gnu|spdx|redistribut|permission", w)][:90]
    texts = [f"{a} zzz {b}" for a in known for b in known if a <= b] + [f"{a} qqq {b} qqq" for a in known for b in known if a <= b]
    texts = [t for t in texts if "rights" not in t and "commons" not in t][:8100]
    rows = [(i, t, "en") for i, t in enumerate(texts)] + [(9000, "The GNU General Public License\n\nthe zzz of\nthe zzz of", "en")]
    told = background(shared.createDataFrame(rows, DOCS), "doc_id", "text")
    sets = {(frozenset(t.split()) & set(known), len(t.split()).bit_length()) for t in texts}
    got = told.filter("NOT beside").collect()
    assert len(sets) > 6000 and len(got) >= len(sets) and len({r.features for r in got}) == len(got)


def test_licence_texts_are_cut_once(shared, monkeypatch):
    """The texts are cut into words once; a paragraph's vector has the words, pairs, length and cue a plain reading finds."""
    def split(text):
        return [w for w in re.split(r"[\W_]+", text.lower()) if w]

    texts = [
        "The terms\r\nof the zzz\r\r\n\n12 34\nfoo", "the\nof\n\n \t\nand the 12\n 99 \nwork of the work", "---\nthe terms\n---", "\n\n", None,
        "Permission\nis HEREBY\ngranted", "gnu\npublic license", "the work is Licensed", "GNU general\npublic", "\u212a the \u0130 of\n\u03a3\u03a3 work", "the " * 70,
    ]
    cuts, told = [], []
    monkeypatch.setattr(licences, "paragraphs", lambda *a, kept=licences.paragraphs: cuts.append(a) or kept(*a))
    docs = shared.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOCS)
    assert scan_licences(docs).count() == len(texts) and len(cuts) == 1
    vectors = licences._vectors(shared)
    for text in texts:
        for block in re.split(r"(?>\r\n|[\r\n])(?:[^\S\r\n]*+(?>\r\n|[\r\n]))+", text or ""):
            lines = re.split(r"\r\n|[\r\n]", block)
            for part in [block] + (lines if len(lines) > 1 else []):
                if re.search(r"[^\W\d_]", part):
                    words = split(part)
                    signs = {f"#{i}" for i in range(max(len(words), 1).bit_length())}
                    grams = {*words, *map(" ".join, itertools.pairwise(words)), *signs} & set(vectors.vocabulary)
                    cue = re.search("(?ia:licen[sc]|copyright|creative commons|gnu |spdx|redistribut|rights reserved|permission)", part)
                    told.append((tuple(sorted(grams)), bool(cue)))
    got = licences._told(docs, "doc_id", "text").select("features", "cue").collect()
    assert sorted((tuple(sorted(vectors.vocabulary[i] for i in r.features.indices)), r.cue) for r in got) == sorted(told)


def test_licences_wrapped(shared, prose):
    rows = [(i, "\n".join(" ".join(prose(20)) for _ in range(4)), "en") for i in range(60)]
    long = [(family, text) for family, text in TEMPLATES if len(text) > 140]
    assert {family for family, _ in long} >= {"gpl", "mit", "bsd"}
    for i, (_, text) in enumerate(long):
        for j, end in enumerate(("\n", "\r\n")):
            notice = end.join(textwrap.wrap(text, 70))
            rows.append((100 + 2 * i + j, end.join([" ".join(prose(20)), "", notice, " \t", " ".join(prose(20))]), "en"))
    rows.append((300, "Released under the MIT License.\n\n" + "\n".join(textwrap.wrap(long[-1][1], 70)), "en"))
    got = {r.doc_id: r for r in scan_licences(shared.createDataFrame(rows, DOCS)).collect()}
    assert all(got[i].n_licence == 0 and got[i].n_paragraphs == 1 for i in range(60))
    for i, (family, _) in enumerate(long):
        for row in (got[100 + 2 * i], got[101 + 2 * i]):
            assert (row.n_paragraphs, row.n_licence, row.n_confirmed, row.confirmed) == (3, 1, 1, family), row
            assert (row.found[0].at, row.found[0].line) == (1, None)
    assert (got[300].n_paragraphs, got[300].n_confirmed) == (2, 2)


def test_queries_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "decontamination", "mixture", "shards"]
