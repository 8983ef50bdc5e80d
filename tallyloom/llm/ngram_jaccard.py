"""N-gram Jaccard join that uses relations between the sets to skip work.

Two texts link when their sets of word n-grams have a Jaccard similarity of at least ``percent``
per cent. The join is exact and never forms the pairs of a group of near copies:

1. Equal sets become one class. Only classes are joined.
2. Every class keeps ``e + e/3 + 1`` n-grams, the smallest by hash, where ``e`` is the most n-grams
   a partner may lack; a partner has at least ``e/3 + 1`` of them. It is listed under the ``e + 1``
   rarest of these, so a common passage is hardly ever a key, and two partners share a list.
3. Lists are cut into blocks of one set size, sorted by position. Blocks whose sizes or positions
   rule out a link are skipped whole; of others the scan stops at the last position that may do.
4. In a list of more than ``LIST_ROWS`` sets, every set is compared with one leader only, the set
   with the fewest n-grams of its own in the list or, to have few leaders, in the lists of that set. The answers of a set follow from those of the
   leader: the difference of two sets is told by their differences from the leader. Sets linked
   to the leader are connected already. Any other set can only link to a set with which it shares
   a difference, so these, which are few and mostly of one set alone, are joined in place of the
   sets, by the same rule of rarest first and the same bounds on positions.
5. The pairs left are compared n-gram by n-gram, and components of the links are found.

Sets hold 64-bit hashes of n-grams; classes are told apart by a 128-bit digest of the set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.words import SPACE, find_words, gram_hashes, pieces, word_hashes
from tallyloom.llm.workspace import Workspace

# Longer lists are joined by way of their leader.
LIST_ROWS = 24


def ngram_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of every text; one for the whole of a shorter text."""
    for first, last, data, bounds in pieces(column):
        starts, ends, at = find_words(data, bounds, SPACE)
        hashed = word_hashes(data, starts, ends, lower=True)
        grams = gram_hashes(hashed, words)
        for row in range(last - first):
            begin, end = int(at[row]), int(at[row + 1])
            if end - begin >= words:
                found = np.sort(grams[begin : end - words + 1])
                yield found[np.append(True, found[1:] != found[:-1])]
            else:
                yield gram_hashes(hashed[begin:end], end - begin)[: end - begin]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def _lacks(n: Column | int, percent: int) -> Column | int:
    """The most n-grams of a set of n that a partner may lack."""
    return F.floor(n * (100 - percent) / 100) if isinstance(n, Column) else n * (100 - percent) // 100


def _kept(n: Column | int, percent: int) -> Column | int:
    """How many of the smallest hashes of a set of n are kept."""
    most = _lacks(n, percent)
    return most + (F.floor(most / 3) if isinstance(n, Column) else most // 3) + 1


def _needs(n: Column, m: Column, percent: int) -> Column:
    """The fewest n-grams that sets of n and m have in common if they link."""
    return F.ceil((n + m) * percent / (100 + percent))


def _summaries(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, fp, n, digest, rare): hash of the text, set size, digest, and the smallest hashes."""

    def summarise(batches):
        for batch in batches:
            sets = list(ngram_sets(batch.column(1), words))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                _lists([s[: _kept(len(s), percent)] for s in sets]),
            ], ["doc_id", "fp", "n", "digest", "rare"])

    return docs.mapInArrow(summarise, "doc_id bigint, fp bigint, n bigint, digest binary, rare array<bigint>")


def _full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, n, grams) of the wanted (node, doc_id, digest), made again from the texts."""

    def build(batches):
        for batch in batches:
            sets = list(ngram_sets(batch.column(2), words))
            right = [
                i for i, (s, d) in enumerate(zip(sets, batch.column(1).to_pylist()))
                if hashlib.blake2b(s.tobytes(), digest_size=16).digest() == d
            ]
            sets = [sets[i] for i in right]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(right, pa.int64())),
                pa.array([len(s) for s in sets], pa.int64()), _lists(sets),
            ], ["node", "n", "grams"])

    texts = docs.join(wanted, "doc_id").select("node", "digest", "text")
    return texts.mapInArrow(build, "node bigint, n bigint, grams array<bigint>")


def _index(space: Workspace, classes: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, p, own, place): the lists of the ``e + 1`` rarest of the kept n-grams.

    ``place`` counts the rarer ones of the same set, ``own`` those no other class keeps. The counts are
    written first: the join can then split an n-gram that very many sets hold.
    """
    kept = classes.select("node", "n", F.explode("rare").alias("token"))
    counts = kept.groupBy("token").count().filter("count > 1").withColumnRenamed("token", "_token")
    shared = space.pin(counts, "shared")
    spread = kept.join(shared, F.col("token") == F.col("_token"))
    ordered = spread.groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("count", "token"))).alias("tokens")
    ).withColumn("p", _kept(F.col("n"), percent)).withColumn("own", F.col("p") - F.size("tokens"))
    listed = ordered.select("node", "n", "p", "own", F.posexplode("tokens").alias("i", "t"))
    return listed.select(
        F.col("t.token").alias("token"), "node", "n", "p", "own",
        (F.col("own") + F.col("i")).alias("place"),
    ).filter(F.col("place") <= _lacks(F.col("n"), percent))


def _led(listed: DataFrame) -> DataFrame:
    """(a, b): every set of the long lists with its leaders.

    Any set will do as the leader of a list. Following a list's leader to the leaders of the lists that
    it is in itself, twice, leaves a family of near copies with few.
    """
    best = listed.groupBy("node").agg(F.min("leader").alias("best")).select(F.col("node").alias("_node"), "best")
    heads = listed.select("leader").distinct().withColumn("head", F.col("leader.node"))
    for _ in range(2):
        heads = heads.join(best, F.col("leader.node") == F.col("_node")).select("head", F.col("best").alias("leader"))
    heads = heads.select("head", F.col("leader.node").alias("a"))
    led = listed.select(F.col("leader.node").alias("head"), F.col("node").alias("b")).distinct().join(heads, "head")
    return led.filter("a <> b").select("a", "b")


def _short_list_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of the lists, by blocks of one size sorted by place."""
    block = rows.groupBy("token", "n", "p").agg(
        F.sort_array(F.collect_list(F.struct("place", "node"))).alias("sets")
    )
    small = block.select("token", *[F.col(c).alias(f"{c}1") for c in ("n", "p", "sets")])
    large = block.select(F.col("token").alias("_token"), *[F.col(c).alias(f"{c}2") for c in ("n", "p", "sets")])
    n1, n2 = F.col("n1"), F.col("n2")
    common = _needs(n1, n2, percent)
    # The fewest of the kept n-grams that both have; what comes before the first one is lacking.
    least = F.least(F.col("p1") - (n1 - common), F.col("p2") - (n2 - common))
    reach = (n1 <= n2) & (n2 * percent <= n1 * 100)
    first = lambda sets, p: F.col(p) - F.col(sets)[0]["place"] >= least
    near = small.join(
        large, (F.col("token") == F.col("_token")) & reach & first("sets1", "p1") & first("sets2", "p2")
    ).withColumn("least", least)
    one = near.withColumn("x", F.explode("sets1")).filter("p1 - x.place >= least")
    two = one.withColumn("y", F.explode("sets2")).filter("p2 - y.place >= least")
    apart = two.filter("n1 < n2 OR x.node < y.node")
    return apart.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def _compare(space: Workspace, docs: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, percent: int):
    """(a, b, n1, n2, g1, g2, common, linked) of the pairs (a, b), and the tables it reads."""
    pairs = space.pin(pairs.distinct(), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = classes.join(nodes, "node").select("node", "doc_id", "digest")
    sets = space.pin(_full_sets(docs, wanted, words).dropDuplicates(["node"]), "sets")
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("n1"), F.col("grams").alias("g1"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("grams").alias("g2"))
    both = pairs.join(two, "b").join(one, "a")
    common = F.size(F.array_intersect("g1", "g2"))
    enough = F.col("common") * (100 + percent) >= (F.col("n1") + F.col("n2")) * percent
    return both.withColumn("common", common).withColumn("linked", enough), (pairs, sets)


def _led_pairs(space: Workspace, compared: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets in the lists of one leader that may link, by their differences from it.

    ``compared`` holds (a, b) = (leader, set) and both sets. A set not linked to the leader links
    to no set with which it shares no difference: the two together would differ by more.
    """
    most = F.floor(F.col("n2") * (100 - percent) / percent)
    differing = compared.select(
        "a", F.col("b").alias("node"), F.col("n2").alias("n"), "linked", most.alias("most"),
        F.array_union(F.array_except("g2", "g1"), F.array_except("g1", "g2")).alias("diff"),
    )
    rows = space.pin(differing.select("*", F.size("diff").alias("d")).filter("d > 0"), "differences")
    spread = rows.select("a", "node", "n", "d", "linked", "most", F.explode("diff").alias("token"))
    count = spread.groupBy("a", "token").agg(F.count("*").alias("count")).filter("count > 1")
    count = count.withColumnsRenamed({"a": "_a", "token": "_token"})
    shared = spread.join(count, (F.col("a") == F.col("_a")) & (F.col("token") == F.col("_token")))
    ordered = shared.groupBy("a", "node", "n", "d", "linked", "most").agg(
        F.sort_array(F.collect_list(F.struct("count", "token"))).alias("tokens")
    )
    placed = ordered.select("*", F.posexplode("tokens").alias("i", "t")).select(
        "a", F.col("t.token").alias("token"), "node", "n", "d", "linked",
        (F.col("d") - F.size("tokens") + F.col("i")).alias("place"), "most",
    ).filter("place <= most")
    lists = space.pin(placed.drop("most"), "difference-lists")
    y = lists.filter("NOT linked").drop("linked")
    z = lists.select(*[F.col(c).alias(f"{c}2") for c in lists.columns])
    apart = F.col("d") + F.col("d2") - (F.col("n") + F.col("n2") - 2 * _needs(F.col("n"), F.col("n2"), percent))
    rest = F.least(F.col("d") - F.col("place"), F.col("d2") - F.col("place2"))
    found = y.join(
        z, (F.col("a") == F.col("a2")) & (F.col("token") == F.col("token2"))
        & (F.col("linked2") | (F.col("node") < F.col("node2"))) & (2 * rest >= apart),
    )
    pairs = space.pin(
        found.select(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b")).distinct(),
        "led-pairs",
    )
    space.drop(rows, lists)
    return pairs


def jaccard_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id, fp, group_id) of every row of ``docs``.

    Letters A-Z are lower-cased; words are runs of anything but ASCII white space.
    ``component_id`` is the smallest id reachable by links, the row's own included; ``class_id``
    the smallest id with an equal set; ``fp`` a hash of the text. ``group_id`` numbers the components of one
    call and tells two of them apart that have one smallest id. Other columns of ``docs`` are not read.

    - A null or wordless text has an empty set, is linked with nothing and is its own component.
    - A text of fewer words than ``words`` has one n-gram, the whole of it.
    - A row with a null id has null groups and links nothing.
    - Repeated rows are returned as often as they come; rows with one id but different texts are
      sets of their own, each in its component.
    - An empty table gives an empty table.
    """
    space = Workspace(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("binary").alias("text"),
        F.xxhash64(F.col(text_col).cast("string")).alias("fp"),
    )
    summaries = _summaries(texts, words, percent).withColumn("row", F.monotonically_increasing_id())
    heavy = space.pin(summaries, "sets")
    rows = space.pin(heavy.drop("rare"), "rows")
    real = rows.filter("n > 0 AND doc_id IS NOT NULL")
    texts = texts.filter("doc_id IS NOT NULL")
    # min_by would keep long arrays in the aggregate; ids alone are joined back.
    classes = real.groupBy("digest").agg(F.min(F.struct("doc_id", "row")).alias("least")).select(
        "digest", F.col("least.doc_id").alias("class_id"), F.col("least.row").alias("node")
    )
    classes = space.pin(classes, "classes")
    members = heavy.join(classes.select("node"), F.col("row") == F.col("node")).select("node", "n", "rare")
    index = space.pin(_index(space, members, percent), "index")
    lists = index.groupBy("token").agg(
        F.count("*").alias("rows"), F.min(F.struct("own", "node")).alias("leader")
    ).filter("rows > 1").withColumnRenamed("token", "_token")
    listed = space.pin(index.join(lists, F.col("token") == F.col("_token")).drop("_token"), "lists")
    space.drop(index, heavy)
    wanted = classes.select("node", F.col("class_id").alias("doc_id"), "digest")

    compared, held = _compare(space, texts, wanted, _led(listed.filter(F.col("rows") > LIST_ROWS)), words, percent)
    compared = space.pin(compared, "led")
    space.drop(*held)
    led_pairs = _led_pairs(space, compared, percent)
    short = _short_list_pairs(listed.filter(F.col("rows") <= LIST_ROWS), percent)
    checked, held = _compare(space, texts, wanted, short.union(led_pairs), words, percent)
    links = compared.filter("linked").select("a", "b").union(checked.filter("linked").select("a", "b"))
    roots = space.pin(components(space, links), "roots")
    space.drop(listed, compared, led_pairs, *held)

    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("class_id").alias("component_id"))
    labels = rooted.join(least, "root").select(F.col("digest").alias("_digest"), "class_id", "component_id", "root")
    linked = real.join(labels, F.col("digest") == F.col("_digest")).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "class_id", "fp", F.col("root").alias("group_id")
    )
    alone = rows.filter("n = 0 OR doc_id IS NULL").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"),
        "fp", F.col("row").alias("group_id"),
    )
    return linked.union(alone)
