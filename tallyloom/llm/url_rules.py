"""URL filter by given rules and by association rules that FP-growth mines from labelled URLs.

A URL is a set of tokens: host labels with their place from the right and the words in them, path words, the kind
of its ending, query keys. Labelled URLs, each once, are transactions of their tokens and their label.

Tokens that occur in the very same labelled URLs are one token, as no rule could tell them apart. Of a URL
``BASKET`` tokens at most, those of the highest lift, go into its transaction, so that FP-growth makes at most 2^BASKET
combinations of one URL, however long it is and however often it or a like one is labelled. What a cut transaction
hides is grown token by token over whole token sets, level by level, so no combination that can be a rule is missed.
All combinations found are candidates: their URLs are counted exactly, over whole token sets, by an inverted index.

A rule is kept by its support and by its confidence against the base rate of the labels: the lower end of the Wilson
interval of its confidence must lie above the rate. Of two rules the longer goes if the shorter one is in it and at
least as sure. The same index finds the rules all of whose tokens a page has. All of it is DataFrame operations.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.workspace import Workspace

# Given rules: host, path, verdict. The longest that fits decides.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

# Tables of as many rows at most are sent to every task; larger ones are joined by a shuffle.
SENT_ROWS = 100_000
# A rule needs as many labelled URLs at least.
MIN_LABELS = 20
# FP-growth sees as many tokens of a URL; combinations of longer ones are grown by levels.
BASKET = 10
# Half the width of the interval of a confidence, in standard deviations.
DEVIATIONS = 2.58
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(host: str, path: str) -> Column:
    below = (F.col("host") == host) | F.endswith(F.col("host"), F.lit(f".{host}"))
    return below & F.startswith(F.col("path"), F.lit(path))


def given_rule(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest given rule that fits host and path, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, what in reversed(ordered):
        rule = F.when(_fits(host, path), F.lit(host + path)).otherwise(rule)
        verdict = F.when(_fits(host, path), F.lit(what)).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL; numbers in paths are one token, whatever their value."""
    labels = F.reverse(F.split(host, r"\."))
    hosts = F.transform(labels, lambda x, i: F.concat(F.lit("host"), i.cast("string"), F.lit(":"), x))
    # Only labels of several words: one alone is a token with its place already.
    parted = F.flatten(F.transform(F.filter(labels, lambda x: x.contains("-")), lambda x: F.split(x, "-+")))
    parts = F.transform(F.filter(parted, lambda x: x != ""), lambda x: F.concat(F.lit("part:"), x))
    words = F.filter(F.split(path, "[/._-]+"), lambda x: x != "")
    paths = F.transform(words, lambda x: F.when(x.rlike("^[0-9]+$"), "path:#").otherwise(F.concat(F.lit("path:"), x)))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "[&;]"), lambda x: x != ""), lambda x: F.concat(F.lit("key:"), F.element_at(F.split(x, "="), 1)))
    end = F.array(F.concat(F.lit("end:"), F.regexp_extract(path, r"(/|\.[A-Za-z0-9]+)?$", 1)))
    return F.array_distinct(F.concat(hosts, parts, paths, end, keys))


def _small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= SENT_ROWS else table


def _surely_above(found: str, of: str, rate: str) -> Column:
    """Whether the lower end of the Wilson interval of found / of lies above a rate."""
    n, z = F.col(of).cast("double"), DEVIATIONS
    share = F.col(found) / n
    centre = share + z * z / (2 * n)
    spread = z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    return (centre - spread) / (1 + z * z / n) > F.col(rate)


def _indexed(rules: DataFrame, classes: DataFrame) -> DataFrame:
    """``rules`` (rule_id, tokens, ...) with ``anchor``: of a rule's tokens that of the fewest labelled URLs."""
    counts = classes.filter(F.col("token") == F.col("as")).select("token", "n")
    rarest = rules.select("rule_id", F.explode("tokens").alias("token")).join(_small(counts), "token").groupBy("rule_id").agg(
        F.min_by("token", F.struct("n", "token")).alias("anchor")
    )
    return rules.join(rarest, "rule_id")


def _met(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(..., tokens, rule_id, confidence, needs) of every set (..., tokens) and every rule all of whose tokens it has.

    An inverted index: a rule is listed under its anchor alone, so a set meets the rules of its tokens, and those
    whose other tokens it lacks go where they meet.
    """
    index = rules.select("rule_id", "confidence", F.col("tokens").alias("needs"), F.col("anchor").alias("token"))
    met = sets.withColumn("token", F.explode("tokens")).join(_small(index), "token").drop("token")
    return met.filter(F.size(F.array_except("needs", "tokens")) == 0)


def _matches(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(..., rule_id, confidence) of every set (..., tokens) and every rule all of whose tokens it has."""
    return _met(sets, rules).drop("needs", "tokens")


def _grown(space: Workspace, whole: DataFrame, classes: DataFrame, least: int, blocked: int, rate: float) -> DataFrame | None:
    """(tokens) of every combination in a set (set_id, block, tokens) of over ``BASKET`` tokens that may be a rule.

    Level by level, each counted over all sets. Left out is only what cannot be a rule, nor any longer combination
    with it: too few URLs or blocked ones; as many URLs as without one of its tokens, or one within it whose URLs are
    all blocked, as the shorter combination is as sure then.
    """
    counts = F.count("*").alias("n"), F.sum("block").alias("b"), F.max("long").alias("long")
    sets = space.pin(whole.withColumn("long", F.size("tokens") > BASKET), "whole-sets")

    def hopeful(found: DataFrame) -> DataFrame:
        # The best that a longer one could do: all of its blocked URLs, and no others beyond the least number.
        told = found.filter(F.col("long") & (F.col("n") >= least) & (F.col("b") >= blocked)).withColumn("rate", F.lit(rate))
        told = told.withColumn("best", F.greatest("b", F.lit(least)))
        return told.filter(_surely_above("b", "best", "rate")).select("tokens", "n", "b")

    single = sets.select("block", "long", F.explode("tokens").alias("token")).groupBy("token").agg(*counts)
    level = space.pin(hopeful(single.withColumn("tokens", F.array("token"))), "level")
    levels = []
    while not level.isEmpty():
        levels.append(level.select("tokens"))
        grows = space.pin(level.filter("n > b").withColumn("rule_id", F.monotonically_increasing_id()), "growing")
        index = _indexed(grows.withColumn("confidence", F.lit(None).cast("double")), classes)
        after = F.filter("tokens", lambda t: t > F.element_at("needs", -1))
        longer = _met(sets, index).select("block", "long", "needs", F.explode(after).alias("token"))
        longer = hopeful(longer.groupBy("needs", "token").agg(*counts).withColumn("tokens", F.concat("needs", F.array("token"))))
        # Every combination of one token less must be there, with more URLs.
        parts = F.transform("tokens", lambda t: F.array_remove("tokens", t))
        less = grows.select(F.col("tokens").alias("part"), F.col("n").alias("of"))
        sound = longer.withColumn("part", F.explode(parts)).join(_small(less), "part").filter(F.col("of") > F.col("n"))
        sound = sound.groupBy("tokens").agg(F.first("n").alias("n"), F.first("b").alias("b"), F.count("*").alias("parts"))
        level = space.pin(sound.filter(F.col("parts") == F.size("tokens")).drop("parts"), "level")
    return reduce(DataFrame.union, levels) if levels else None


class Mined(NamedTuple):
    """Rules (rule_id, tokens, anchor, confidence, ...) and the token that each token counts as (token, as)."""

    rules: DataFrame
    classes: DataFrame


def mine(space: Workspace, labelled: DataFrame, support: float, lift: float) -> Mined:
    """Rules for block from (url, tokens, block boolean), one row for each URL.

    A rule's tokens are in ``support`` of the URLs and ``MIN_LABELS`` of them at least; its confidence is ``lift`` times
    the base rate and surely above that.
    """
    urls = space.pin(labelled.select(F.xxhash64("url", "tokens").alias("set_id"), "tokens", F.col("block").cast("bigint").alias("block")), "urls")
    n, blocked = urls.agg(F.count("*"), F.coalesce(F.sum("block"), F.lit(0))).first()
    least, rate = max(MIN_LABELS, math.ceil(support * n)), blocked / max(n, 1)

    # Tokens of enough URLs, at most tokens of a URL / support; equal sums over their URLs' hashes: the same URLs.
    listed = urls.select("set_id", "block", F.explode("tokens").alias("token"))
    told = listed.groupBy("token").agg(
        F.count("*").alias("n"), F.sum("block").alias("b"), F.sum(F.col("set_id").cast("decimal(38,0)")).alias("x"),
        F.sum(F.xxhash64("set_id").cast("decimal(38,0)")).alias("y"),
    ).filter(F.col("n") >= least)
    classes = space.pin(told.withColumn("as", F.min("token").over(Window.partitionBy("n", "x", "y"))).select(
        "token", "as", "n", (F.col("b") / F.col("n")).alias("share")
    ), "token-classes")
    sets = listed.join(_small(classes), "token").groupBy("set_id", "block", F.col("as").alias("token")).agg(F.max("share").alias("share"))
    sets = space.pin(sets, "token-sets")

    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("s"), "token"))), 1, BASKET)
    baskets = sets.groupBy("set_id", "block").agg(best.alias("best")).select(F.concat(
        F.transform("best", lambda x: x["token"]), F.when(F.col("block") == 1, F.array(F.lit("label:block"))).otherwise(F.array().cast("array<string>"))
    ).alias("items"))
    baskets = space.pin(baskets, "baskets")
    # A rule of such confidence and support has at least so many blocked URLs.
    few = max(1, math.ceil(least * rate * lift))
    kept = baskets.count()
    model = FPGrowth(minSupport=min(1.0, few / max(kept, 1)), minConfidence=0.0).fit(baskets)
    found = model.freqItemsets.filter(F.array_contains("items", "label:block") & (F.size("items") > 1))
    found = found.select(F.array_sort(F.array_remove("items", "label:block")).alias("tokens"))

    whole = sets.groupBy("set_id", "block").agg(F.array_sort(F.collect_set("token")).alias("tokens"))
    # Dealt out evenly: a few small files of sets meet many rules.
    whole = whole.repartition(int(space.spark.conf.get("spark.sql.shuffle.partitions")))
    # Transactions that were cut hide combinations, or some of their URLs; those are grown by levels.
    if not whole.filter(F.size("tokens") > BASKET).isEmpty():
        grown = _grown(space, whole, classes, least, few, rate)
        found = found if grown is None else found.union(grown).distinct()
    rules = space.pin(found.withColumn("rule_id", F.monotonically_increasing_id()), "candidates")

    candidates = _indexed(rules, classes).withColumn("confidence", F.lit(None).cast("double"))
    counted = _matches(whole, candidates).groupBy("rule_id").agg(F.count("*").alias("n_labelled"), F.sum("block").alias("n_blocked"))
    sure = counted.withColumn("confidence", F.col("n_blocked") / F.col("n_labelled")).withColumn("rate", F.lit(rate)).filter(
        (F.col("n_labelled") >= least) & (F.col("confidence") >= lift * rate) & _surely_above("n_blocked", "n_labelled", "rate")
    )
    sure = space.pin(candidates.drop("confidence").join(sure.drop("rate"), "rule_id"), "sure-rules")
    # A rule within another one is found by its anchor, which the other must have.
    shorter = sure.select(F.col("tokens").alias("part"), F.col("confidence").alias("part_sure"), F.col("anchor").alias("token"))
    longer = sure.select("rule_id", "tokens", "confidence", F.explode("tokens").alias("token"))
    beaten = longer.join(shorter, "token").filter(
        (F.size("tokens") > F.size("part")) & (F.col("part_sure") >= F.col("confidence"))
        & (F.size(F.array_except("part", "tokens")) == 0)
    ).select("rule_id").distinct()
    return Mined(space.pin(sure.join(beaten, "rule_id", "left_anti"), "rules"), classes.select("token", "as"))


def judge(
    pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
    support: float = 0.01, lift: float = 1.2,
    id_col: str = "page_id", url_col: str = "url", label_id_col: str = "doc_id",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined, n_tokens) of every row of ``pages``.

    A label blocks if it is toxic or of quality 0; it belongs to the page with its id. ``rule`` and
    ``verdict`` are those of the longest given rule that fits, else null and the mined rules': block if
    all tokens of one are in the URL, allow if of none. ``mined`` is the confidence of the surest.

    - A null URL or one without :// has empty host and path, no rule and no tokens, and is allowed.
    - An id with several labels blocks if one of them does, a URL if one of its ids does; null labels and null ids
      tell nothing.
    - Repeated rows are returned as often as they come. Without labels nothing is mined: allow.
    - An empty table gives an empty table; other columns, whatever their names, are not read.
    """
    space = Workspace(pages.sparkSession)
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), url.alias("url"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    real = F.coalesce(F.instr("url", "://") > 0, F.lit(False))
    none = F.array().cast("array<string>")
    rows = rows.withColumn("tokens", F.when(real, tokens_of(F.col("url"), F.col("host"), F.col("path"))).otherwise(none))
    verdicts = labels.select(
        F.col(label_id_col).cast("bigint").alias("page_id"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"), F.coalesce(F.col("quality") == 0, F.lit(False)).alias("poor"),
        (F.col("toxic").isNotNull() | F.col("quality").isNotNull()).alias("known"),
    ).filter("known").groupBy("page_id").agg(F.max(F.col("toxic") | F.col("poor")).alias("block"))
    labelled = rows.filter(F.size("tokens") > 0).join(verdicts, "page_id").groupBy("url", "tokens").agg(F.max("block").alias("block"))
    mined = mine(space, labelled, support, lift)

    # Distinct token sets are looked up once, however many pages have one; only those with a rule come back.
    keyed = rows.withColumn("set_id", F.when(F.size("tokens") > 0, F.xxhash64("tokens")))
    sets = keyed.filter("set_id IS NOT NULL").select("set_id", "tokens").distinct().select("set_id", F.explode("tokens").alias("token"))
    known = sets.join(_small(mined.classes), "token").groupBy("set_id").agg(F.collect_set("as").alias("tokens"))
    hits = _matches(known, mined.rules)
    blocked = space.pin(hits.groupBy("set_id").agg(F.max("confidence").alias("mined")), "blocked-sets")
    rule, verdict = given_rule(rules)
    told = F.when(F.col("mined").isNotNull(), "block").otherwise("allow")
    return keyed.join(_small(blocked), "set_id", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, told).alias("verdict"), "mined",
        F.size("tokens").alias("n_tokens"),
    )
