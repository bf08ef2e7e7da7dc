"""One query per operator over the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.llm import (
    byte_bpe,
    chunk_bpe,
    decontaminate,
    license_scan,
    lm_score,
    near_dedup,
    prefix_trie,
    quality_classifier,
    quality_rules,
    sql,
    substring_dedup,
    token_counts,
    url_filter,
    whitening,
)
from aforo.llm.registry import ORACLE, QUERIES, query, table  # noqa: F401

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op8_byte_bpe")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(RANKS)
    return byte_bpe.encode(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN, digest=True)


@query("op9_near_dedup", sql.NEAR_DEDUP)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf, "documents"))


@query("op10_substring_dedup", sql.REPEATED_PASSAGES)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    judged = substring_dedup.repeated_passages(table(spark, sf, "documents"))
    return judged.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op3_decontamination")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op4_quality")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    scored = quality_classifier.score(documents, quality_model(spark, documents, sf))
    return scored.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def remainder(key: str, n: int) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def quality_model(spark: SparkSession, documents: DataFrame, sf: str) -> quality_classifier.Model | float:
    labels = table(spark, sf, "labels")
    return quality_classifier.fit(documents, labels.where(remainder("doc_id", 3) != 1))


RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


@query("op1_url_filter", sql.URL_FILTER)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "action string, rule string")
    judged = url_filter.filter_urls(table(spark, sf, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op6_token_counts")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(RANKS)
    counted = token_counts.lengths(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)
    return token_counts.limits(counted)


@query("op5_quality_rules")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf, "documents")).drop("js_chars", "js_common")


@query("op7_lm_score")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    train = F.coalesce(remainder("doc_id", 5) != 1, F.lit(True))
    return lm_score.lm_scores(documents, train)


@query("op2_license_scan")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    """Documents have no paths: the source and groups of keys are taken as directories, every tenth file as LICENSE."""
    name = F.when(F.col("doc_id") % 10 == 0, "LICENSE").otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    group = lambda n: F.floor(F.col("doc_id") / n).cast("string")
    path = F.concat_ws("/", "source", group(1000), group(100), name)
    return license_scan.scan_licenses(table(spark, sf, "documents").withColumn("path", path))


@query("op12_whitening")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings"))


@query("op11_prefix_trie", sql.PREFIX_TRIE)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations rebuilt with up to eight first turns of the first of their group of five."""
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"), splice=(5, 9))


@query("op13_chunk_bpe")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    codec = chunk_bpe.Codec(public_tokenizers.path("byte_bpe_50k.json"))
    return chunk_bpe.encode(table(spark, sf, "documents"), codec, digest=True)
