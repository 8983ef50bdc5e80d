"""Licence families of paragraphs by a trained classifier, confirmed by comparison with templates.

Paragraphs are runs of lines up to a blank one. Each is judged whole, as notices are often wrapped,
and each of its lines alone, as a notice of one line may stand in running text. A vector tells which words and pairs of
neighbours of the templates a paragraph holds, and its length by powers of two; it goes into a
multinomial logistic regression over the licence families and ``unknown``. That is trained on the
templates, on pieces of them, on every paragraph of the corpus that holds no word like licence, and on the
beginning of each of these beside a template. Paragraphs of one vector are one row, so that the
whole corpus is a table of short rows. Texts are cut into words once: the lines' words, those of no template left
empty, make up the paragraph's, and all that follows reads the vectors. The bound for ``unknown`` is calibrated on the quarter of those
paragraphs that training did not see: a family's probability must be above what unknown
paragraphs reach. A prediction is confirmed if the paragraph holds enough of the words of one of
the family's templates. Everything is DataFrame and Spark ML operations.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.workspace import Workspace

# Licence notices by family, as they stand in files and on pages.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("apache", "SPDX-License-Identifier: Apache-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "This software is released under the BSD 3-Clause License."),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("proprietary", "All rights reserved. No part of this work may be reproduced without written permission."),
)

UNKNOWN = "unknown"
# What the unknown paragraphs weigh together at most, a template being some rows of weight 3; those beside templates, a fifth.
UNKNOWN_WEIGHT = 15_000
# Lengths are told apart up to this power of two.
LENGTHS = 16
# A quarter of the vectors is kept for the calibration.
PARTS = 4
# Share of a template's words that a paragraph must hold to confirm it.
CONFIRM = 0.6
# Words of a paragraph's beginning that stand beside a template.
BESIDE = 12

LINE_END = r"\r\n|[\n\r]"
# Atomic, so that the two characters of one line end are not taken for two.
BLANK_LINES = r"(?>\r\n|[\n\r])(?:[^\S\r\n]*+(?>\r\n|[\n\r]))+"
KEY = ["id_key", "fp"]

# No cue holds a line end, so a paragraph has one if a line of it has.
_CUES = ("licens", "licenc", "copyright", "creative commons", "gnu ", "spdx", "redistribut", "rights reserved", "permission")


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _templates(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(t).alias("template")) for f, t in TEMPLATES])
    table = spark.range(0, 1, 1, 1).select(F.explode(rows).alias("t")).select("t.*")
    return table.withColumn("words", _words(F.col("template")))


def _key(id_col: str, text_col: str) -> list[Column]:
    """Columns that tell texts apart; repeated rows share them and have the same finds."""
    return [F.xxhash64(F.col(id_col)).alias("id_key"), F.xxhash64(F.col(text_col).cast("string")).alias("fp")]


def paragraphs(docs: DataFrame, id_col: str, text_col: str, known: list[str]) -> DataFrame:
    """(id_key, fp, at, line, cue, k, words): paragraphs that hold a letter, and their lines if they have several.

    ``at`` is the number of the paragraph and ``line`` that of the line in it, from 0; null for a whole paragraph.
    ``words`` has an empty string for every word that is none of the ``known``; ``k`` is a number of a template, taken by hash.
    """
    def number(text: Column) -> Column:
        return F.pmod(F.xxhash64(text), F.lit(len(TEMPLATES))).cast("int").alias("k")

    def read(line: Column) -> Column:
        words = F.transform(_words(line["low"]), lambda w: F.when(w.isin(known), w).otherwise(F.lit("")))
        cue = reduce(or_, [F.contains(line["low"], F.lit(c)) for c in _CUES])
        return F.struct(
            line["line"].alias("line"), cue.alias("cue"), number(line["text"]), words.alias("words"), line["text"].rlike(r"\p{L}").alias("lettered")
        )

    blocks = docs.select(
        *_key(id_col, text_col), F.posexplode(F.split(F.col(text_col).cast("string"), BLANK_LINES)).alias("at", "block"),
    ).filter(F.col("block").rlike(r"\p{L}"))
    lowered = F.transform(
        F.split("block", LINE_END), lambda text, i: F.struct(i.alias("line"), text.alias("text"), F.lower(text).alias("low"))
    )
    lines = blocks.select("id_key", "fp", "at", number(F.col("block")), F.transform(lowered, read).alias("lines"))
    whole = F.array(F.struct(
        F.lit(None).cast("int").alias("line"), F.exists("lines", lambda x: x["cue"]).alias("cue"), F.col("k"),
        F.flatten(F.transform("lines", lambda x: x["words"])).alias("words"), F.lit(True).alias("lettered"),
    ))
    lettered = F.filter("lines", lambda x: x["lettered"])
    parts = lines.select("id_key", "fp", "at", F.explode(F.when(F.size("lines") > 1, F.concat(whole, lettered)).otherwise(whole)).alias("part"))
    return parts.select("id_key", "fp", "at", "part.line", "part.cue", "part.k", "part.words")


def _notices(finds: DataFrame) -> DataFrame:
    """(id_key, fp, found): the finds of every text without fragments of one notice.

    Lines that a template confirms stay. A whole paragraph stays unless a confirmed line has its family; a
    paragraph that stays takes the place of its unconfirmed lines of the family, a confirmed one of all of them.
    """
    alone = F.col("line").isNotNull()
    by_paragraph = finds.groupBy(*KEY, "at").agg(
        F.collect_list(F.struct("at", "line", "family", "score", "confirmed")).alias("told"),
        F.collect_set(F.when(alone & F.col("confirmed"), F.col("family"))).alias("sure"),
        F.max(F.when(~alone, F.struct("family", "confirmed"))).alias("whole"),
    )
    stays = F.coalesce(~F.array_contains("sure", F.col("whole.family")), F.lit(False))
    kept = by_paragraph.withColumn("stays", stays).withColumn("told", F.filter("told", lambda x: F.when(
        x["line"].isNull(), F.col("stays")
    ).otherwise(x["confirmed"] | ~F.col("stays") | ~(F.col("whole.confirmed") | (F.col("whole.family") == x["family"])))))
    return kept.groupBy(*KEY).agg(F.array_sort(F.flatten(F.collect_list("told"))).alias("found"))


def _vectors(spark: SparkSession) -> CountVectorizerModel:
    """From ``grams`` to ``features``: words and pairs of neighbours of the templates, a fixed table of a few rows, and lengths."""
    grams = _grams(_templates(spark)).select(F.explode("grams")).distinct().collect()
    vocabulary = sorted(row[0] for row in grams if not row[0].startswith("#")) + [f"#{i}" for i in range(LENGTHS + 1)]
    return CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features").setBinary(True)


def _known(vectors: CountVectorizerModel) -> list[str]:
    return [gram for gram in vectors.vocabulary if " " not in gram and not gram.startswith("#")]


def _grams(table: DataFrame) -> DataFrame:
    """Adds ``has``, the distinct words of ``words`` that are not empty, and ``grams``.

    Those are the same words, pairs of neighbours and, as signs that no word has, the powers of two up to the length.
    """
    def ahead(word: Column, i: Column) -> Column:
        following = F.get("words", i + 1)
        return F.when((word != "") & (following != ""), F.concat(word, F.lit(" "), following)).otherwise(word)

    power = F.least(F.floor(F.log2(F.greatest(F.size("words"), F.lit(1)).cast("double"))), F.lit(LENGTHS)).cast("int")
    signs = F.transform(F.sequence(F.lit(0), power), lambda i: F.concat(F.lit("#"), i.cast("string")))
    # A word, or a word and the next.
    runs = table.withColumn("runs", F.array_distinct(F.filter(F.transform("words", ahead), lambda w: w != "")))
    has = runs.withColumn("has", F.array_distinct(F.transform("runs", lambda w: F.substring_index(w, " ", 1))))
    return has.withColumn("grams", F.concat("has", F.filter("runs", lambda w: F.contains(w, F.lit(" "))), signs)).drop("runs")


def _told(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_key, fp, at, line, cue, k, has, first, features) of paragraphs and lines; ``first`` are the beginning's words."""
    vectors = _vectors(docs.sparkSession)
    parts = vectors.transform(_grams(paragraphs(docs, id_col, text_col, _known(vectors))))
    return parts.select(*KEY, "at", "line", "cue", "k", "has", F.slice("words", 1, BESIDE).alias("first"), "features")


def _background(told: DataFrame) -> DataFrame:
    spark = told.sparkSession
    plain = told.filter(~F.col("cue"))
    numbered = _templates(spark).withColumn("k", F.monotonically_increasing_id().cast("int")).withColumnRenamed("words", "notice")
    beside = plain.select("k", "first").distinct().join(F.broadcast(numbered), "k").select("family", F.concat("notice", "first").alias("words"))
    return plain.select(F.lit(UNKNOWN).alias("family"), F.lit(False).alias("beside"), "features").union(
        _vectors(spark).transform(_grams(beside)).select("family", F.lit(True).alias("beside"), "features")
    ).distinct()


def background(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(family, beside, features): every paragraph without a cue as unknown, and its beginning beside a template.

    Rows alike are one, so copies of a paragraph count once.
    """
    return _background(_told(docs, id_col, text_col))


def _pieces(templates: DataFrame) -> DataFrame:
    """(family, words): templates whole and without their ends."""
    n = F.size("words")
    cuts = F.array(
        F.col("words"), F.slice("words", 1, F.greatest(F.lit(3), n - 2)), F.slice("words", F.least(F.lit(3), n), n),
        F.slice("words", 1, F.greatest(F.lit(4), (n * 2 / 3).cast("int"))),
    )
    return templates.select("family", F.explode(cuts).alias("words"))


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_paragraphs, n_licence, n_confirmed, families, confirmed, best_score, found) of every row.

    ``found`` lists the paragraphs told as a licence, or lines of them: number of the paragraph, of the line in it
    (null for the whole), family, probability and whether a template confirms it; ``families`` and ``confirmed`` are their distinct families, sorted.

    - A null or letterless text has no paragraphs and no finds.
    - A row with a null id is judged like others. Repeated rows are returned as often as they come.
    - Equal scores take the family first by name. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    space = Workspace(spark)
    templates = _templates(spark)
    vectors = _vectors(spark)
    parts = space.pin(_told(docs, id_col, text_col), "told")
    rows = _background(parts).withColumn("part", F.pmod(F.xxhash64("features"), F.lit(PARTS)))
    rows = space.pin(rows, "background")
    unseen = rows.filter(~F.col("beside") & (F.col("part") == 0)).select("features")
    seen = rows.filter(F.col("beside") | (F.col("part") > 0))
    counts = {row["beside"]: row["count"] for row in seen.groupBy("beside").count().collect()}
    weight = min(counts.get(False, 0), UNKNOWN_WEIGHT)
    each = F.when(F.col("beside"), weight / 5 / max(counts.get(True, 0), 1)).otherwise(weight / max(counts.get(False, 0), 1))
    names = sorted({family for family, _ in TEMPLATES}) + [UNKNOWN]
    number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("family")).cast("double") - 1
    pieces = vectors.transform(_grams(_pieces(templates)))
    training = seen.select("features", number.alias("label"), each.alias("weight")).union(
        pieces.select("features", number.alias("label"), F.lit(3.0).alias("weight"))
    )
    regression = LogisticRegression(
        maxIter=40, regParam=1e-4, weightCol="weight", family="multinomial", predictionCol=""
    )
    model = regression.fit(training)

    def scored(table: DataFrame) -> DataFrame:
        """Adds ``family`` and ``score`` of the likeliest family other than unknown."""
        given = model.transform(table)
        chances = F.slice(vector_to_array("probability"), 1, len(names) - 1)
        score = F.array_max("chances")
        family = F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position("chances", score).cast("int"))
        # A filter on what explode makes stays above it, and so does not compute the scores twice.
        best = given.withColumn("chances", chances).withColumn(
            "best", F.explode(F.array(F.struct(family.alias("family"), score.alias("score"))))
        )
        return best.select(*table.columns, "best.family", "best.score")

    highest = scored(unseen).agg(F.max("score")).first()[0] or 0.0
    bound = min(max(0.5, 1.1 * highest), 0.9)
    space.drop(rows)

    told = scored(parts.select(*KEY, "at", "line", "has", "features")).filter(F.col("score") >= bound).drop("features")
    # A fixed table of a few rows. All its words are known ones.
    near = told.join(F.broadcast(templates.select("family", F.col("words").alias("template"))), "family")
    alike = F.size(F.array_intersect("has", "template")) / F.size(F.array_distinct("template"))
    finds = near.groupBy(*KEY, "at", "line", "family", "score").agg((F.max(alike) >= CONFIRM).alias("confirmed"))
    finds = space.pin(finds, "finds")
    space.drop(parts)
    notices = _notices(finds)
    every = docs.select(
        *_key(id_col, text_col), F.col(id_col).cast("bigint").alias("doc_id"),
        F.size(F.filter(
            F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), BLANK_LINES), lambda p: p.rlike(r"\p{L}")
        )).alias("n_paragraphs"),
    )
    none = F.array().cast("array<struct<at: int, line: int, family: string, score: double, confirmed: boolean>>")
    found = F.coalesce("found", none)
    sure = F.filter("found", lambda x: x["confirmed"])
    return every.join(notices, KEY, "left").withColumn("found", found).select(
        "doc_id", "n_paragraphs", F.size("found").alias("n_licence"), F.size(sure).alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct("found.family")), ",").alias("families"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("confirmed"),
        F.array_max("found.score").alias("best_score"), "found",
    )
