"""A training corpus from documents: language, near copies, benchmark passages, mixture, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet and
reads again as the next stage's documents. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.decontaminate import find_benchmark
from tallyloom.llm.language import identify
from tallyloom.llm.mixing import mix
from tallyloom.llm.ngram_jaccard import jaccard_groups
from tallyloom.llm.sharding import interleave
from tallyloom.llm.workspace import Workspace, free_name


def _fp(text: str = "text"):
    return F.xxhash64(F.col(text).cast("string"))


def _told(docs: DataFrame, told: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with (doc_id, fp, ...), null ids with null ids; the other columns have names of their own."""
    doc_id, fp = free_name(docs.columns, "told_id"), free_name(docs.columns, "told_fp")
    renamed = told.withColumnsRenamed({"doc_id": doc_id, "fp": fp})
    return docs.join(renamed, F.col("doc_id").eqNullSafe(F.col(doc_id)) & (_fp() == F.col(fp)), how)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those the language model rejects."""
    into = free_name(docs.columns, "language")
    return identify(docs, into=into).filter(~F.col(into)["rejected"]).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group; five words, a similarity of 0.8.

    Documents without words or id stay; of repeated rows one stays. Unlike texts of one id are
    documents of their own, each in its group; of alike ones that with the smallest hash stays.
    """
    leader, leading, text_fp = (free_name(docs.columns, name) for name in ("leader_id", "leader_fp", "text_fp"))
    groups = jaccard_groups(docs, words=5, percent=80).filter("doc_id = component_id AND n_shingles > 0")
    leaders = groups.groupBy("group_id").agg(F.min(F.struct("doc_id", "fp")).alias("least")).select(
        F.col("least.doc_id").alias(leader), F.col("least.fp").alias(leading)
    )
    worded = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    same = (F.col("doc_id") == F.col(leader)) & (F.col(text_fp) == F.col(leading))
    real = docs.filter(worded).withColumn(text_fp, _fp())
    kept = real.join(leaders, same, "left_semi").dropDuplicates(["doc_id", text_fp])
    return kept.select(*docs.columns).union(docs.filter(~worded))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold too much of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_benchmark(docs, benchmark)
    clean = found.filter("NOT contaminated").select("doc_id", "fp").distinct()
    return _told(docs, clean, "left_semi").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, a part of one if it is half or more of it."""
    copies, copy, fp = (free_name(docs.columns, name) for name in ("copies", "copy", "once_fp"))
    share = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0)
    took = mix(docs).groupBy("doc_id", "fp").agg(F.sum(share).cast("int").alias(copies)).filter(F.col(copies) > 0)
    # Repeated rows have shared their copies out already.
    once = docs.withColumn(fp, _fp()).dropDuplicates(["doc_id", fp]).drop(fp)
    numbered = _told(once, took, "inner").withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return numbered.select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return interleave(docs, shards=16)


STAGES = [
    ("language", language), ("near_copies", near_copies), ("decontamination", decontamination),
    ("mixture", mixture), ("shards", shards),
]

# The language model cannot be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark)
    docs = before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        following = space.pin(stage(spark, docs, sf_dir), name)
        if docs is not before:
            space.drop(docs)
        docs = following
    return STAGES[-1][1](spark, docs, sf_dir)
