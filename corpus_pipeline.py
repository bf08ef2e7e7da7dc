"""The corpus pipeline: quality, near-duplicates, repeated passages, benchmark leaks, encoding.

Every stage takes all documents that its predecessor kept and returns the columns of ``documents``; the last one
returns a row per document with its number of tokens and digests of its ids and of the text they decode to.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.llm import byte_bpe, decontaminate, near_dedup, quality_classifier, substring_dedup
from aforo.llm.common import Staging, text_md5
from aforo.llm.queries import quality_model
from aforo.operators.joins import lookup_join

ID, TEXT = "doc_id", "text"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# The quality model is fitted here, so SQL cannot give the rows; tests compare with a brute-force version.
ORACLE_SQL = None


def _key() -> Column:
    """The key as a value that is equal to itself where it is NULL, too."""
    return F.struct(F.col(ID).cast("long").alias("id"))


def _on(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Semi or anti join with staged (gone, text_md5): a key alone may be NULL or repeated over different texts."""
    return lookup_join(docs, rows, [(_key(), "gone"), (text_md5(TEXT), "text_md5")], how)


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    rows = rows.select(_key().alias("gone"), "text_md5").distinct()
    return _on(docs, Staging(docs.sparkSession, "gone").table(rows, "rows"), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled ones among them, gives 0.5 or more."""
    return quality_classifier.passing(docs, quality_model(spark, docs, sf_dir), TEXT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: that of the least key, NULL last, then of the least digest.

    Documents without words are in no group and all stay.
    """
    judged = near_dedup.groups(docs, ID, TEXT)
    out = _without(docs, judged.where("NOT first"))
    # Rows equal in key and text are first together; of them the least by the other columns stays.
    first = judged.where("first AND n_shingles > 0").groupBy(_key().alias("gone"), "text_md5").count()
    equal = Staging(spark, "equal").table(first.where("count > 1").select("gone", "text_md5"), "rows")
    if equal.isEmpty():
        return out
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    least = _on(out, equal, "left_semi").groupBy(_key().alias("__key"), text_md5(TEXT).alias("__text")).agg(F.min(columns).alias("__row"))
    return _on(out, equal, "left_anti").unionByName(least.select("__row.*"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds; the words that stay are joined by one space."""
    judged = substring_dedup.repeated_passages(docs, ID, TEXT).where("n_removed > 0")
    changed = judged.select(_key().alias("changed"), "text_md5", F.col("kept").cast("string").alias("__kept"))
    changed = Staging(spark, "changed").table(changed.dropDuplicates(["changed", "text_md5"]), "texts")
    joined = lookup_join(docs, changed, [(_key(), "changed"), (text_md5(TEXT), "text_md5")], "left")
    return joined.select(
        *[
            F.coalesce("__kept", TEXT).alias(TEXT)
            if c == TEXT
            else F.when(F.col("__kept").isNotNull(), F.length("__kept").cast("long")).otherwise(F.col(c)).alias(c)
            if c == "n_chars"
            else F.col(f"`{c}`")
            for c in docs.columns
        ]
    )


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontaminate.leaks(docs, benchmark, ID, TEXT, digest=True))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    ranks = byte_bpe.read_ranks(RANKS)
    return byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, ID, TEXT, digest=True)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs, stage = spark.read.parquet(f"{sf_dir}/documents.parquet"), Staging(spark, "pipeline")
    for name, apply in STAGES:
        docs = stage.table(apply(spark, docs, sf_dir), name)
    return docs
