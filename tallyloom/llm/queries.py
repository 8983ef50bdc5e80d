"""One query per operator over whole tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.decontaminate import find_benchmark
from tallyloom.llm.exact_top_k import top_scores
from tallyloom.llm.hard_negatives import hard_negatives
from tallyloom.llm.language import identify
from tallyloom.llm.licences import scan_licences
from tallyloom.llm.mixing import mix
from tallyloom.llm.near_vectors import near_vectors
from tallyloom.llm.ngram_jaccard import jaccard_groups
from tallyloom.llm.secrets_scan import find_secrets
from tallyloom.llm.sharding import interleave
from tallyloom.llm.substring_dedup import remove_repeats
from tallyloom.llm.token_alignment import alignment_counts
from tallyloom.llm.url_rules import judge


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(_table(spark, sf_dir, "documents"), words=3, percent=90).drop("fp", "group_id")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), window=50).drop("removed")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"), cosine=0.93)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = identify(_table(spark, sf_dir, "documents"))
    return told.select("doc_id", "language.held_out", "language.lang_pred", "language.score", "language.rejected")


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0).drop("fp")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_benchmark(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=13, percent=5
    ).drop("fp", "items", "spans")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave(_table(spark, sf_dir, "documents"), shards=16).drop("source")


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(_table(spark, sf_dir, "documents"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers  # only this query needs its files

    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment_counts(_table(spark, sf_dir, "documents"), a, b)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", shifted))


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_scores(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_substring_dedup, op3_secret_scan, op4_embedding_near_dedup,
        op5_language_id, op6_source_mix, op7_benchmark_decontamination, op8_url_filter,
        op9_sharding, op10_licence_scan, op11_tokenizer_alignment, op12_hard_negatives,
        op13_exact_top_k,
    )
}
