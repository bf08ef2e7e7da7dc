"""Token totals and quantiles for every context limit, from an exact histogram of encoded lengths.

Documents are aggregated by their encoded length. Suffix sums over the histogram, within ranges of lengths and over the
ranges, give what a limit cuts off, keeps whole and uses in total.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aforo.llm.common import CACHE_WORDS, Staging, give_back, id_and_text, tidied

RANGE = 1024


class _Counts(dict):
    """Pre-token -> number of its ids."""

    def __init__(self, encoding: tiktoken.Encoding):
        super().__init__()
        self.encoding = encoding

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = n = len(self.encoding._encode_single_piece(word))
        return n


def lengths(df: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key and ``n_tokens`` of each row's whole text; 0 for a NULL or empty one."""
    compiled = regex.compile(pattern)

    @tidied
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        counts = _Counts(encoding)
        for batch in batches:
            texts = ((v.as_py() or b"").decode("utf-8", "replace") for v in batch.column(1))
            sums = [sum(map(counts.__getitem__, compiled.findall(t))) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.int64())], names=["id", "n_tokens"])
        give_back()

    return id_and_text(df, key, text).mapInArrow(count, "id long, n_tokens long").withColumnRenamed("id", key)


def limits(lengths: DataFrame, length: str = "n_tokens", width: int = RANGE) -> DataFrame:
    """One row per distinct length L, taken as a context limit.

    ``documents`` of that length, ``longer`` documents, ``total_tokens`` of all documents, ``kept_tokens`` that a cut at L
    leaves, ``cut_tokens`` it removes, ``whole_tokens`` in documents that fit, ``share`` of documents that fit:
    the least L with a share of q or more is the exact q-quantile of the lengths. NULL lengths are left out.
    An empty input gives no rows.

    The suffix sums run within ranges of ``width`` lengths, and over one row per range. The histogram is staged, so that
    the texts behind ``lengths`` are encoded once.
    """
    stage = Staging(lengths.sparkSession, "lengths")
    histogram = (
        lengths.where(F.col(length).isNotNull())
        .groupBy(F.col(length).cast("long").alias("context_limit"))
        .agg(F.count("*").alias("documents"))
        .withColumn("range", F.floor(F.col("context_limit") / width))
        .withColumn("tokens", F.col("context_limit") * F.col("documents"))
    )
    histogram = stage.table(histogram, "histogram")
    after = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = histogram.groupBy("range").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
    ranges = ranges.select(
        "range",
        F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
        F.sum("d").over(whole).alias("d_all"),
        F.sum("t").over(whole).alias("t_all"),
    )
    within = (
        Window.partitionBy("range").orderBy(F.desc("context_limit")).rowsBetween(Window.unboundedPreceding, -1)
    )
    longer = F.col("d_after") + F.coalesce(F.sum("documents").over(within), F.lit(0))
    longer_tokens = F.col("t_after") + F.coalesce(F.sum("tokens").over(within), F.lit(0))
    summed = histogram.join(ranges, "range").withColumns({"longer": longer, "longer_tokens": longer_tokens})
    cut = F.col("longer_tokens") - F.col("longer") * F.col("context_limit")
    return summed.select(
        "context_limit",
        "documents",
        "longer",
        F.col("t_all").alias("total_tokens"),
        (F.col("t_all") - cut).alias("kept_tokens"),
        cut.alias("cut_tokens"),
        (F.col("t_all") - F.col("longer_tokens")).alias("whole_tokens"),
        ((F.col("d_all") - F.col("longer")) / F.col("d_all")).alias("share"),
    )


def at_limits(summed: DataFrame, wanted: Sequence[int]) -> DataFrame:
    """Totals for given context limits, whether a document has that length or not, from the rows of ``limits``.

    One row per limit: ``context_limit``, ``kept_tokens``, ``cut_tokens``, ``whole_tokens``, ``share`` of documents that fit.
    Between two lengths the kept tokens grow by the longer documents with every token. One pass, one row before it is unfolded.
    """
    least = lambda w: F.max(
        F.when(F.col("context_limit") <= w, F.struct("context_limit", "longer", "kept_tokens", "whole_tokens", "share"))
    )
    all_ = F.max(F.col("documents") + F.col("longer"))
    answers = []
    for w in wanted:
        below, zero = least(w), F.lit(0).cast("long")
        kept = F.when(below.isNull(), all_ * w).otherwise(below["kept_tokens"] + below["longer"] * (w - below["context_limit"]))
        answers.append(
            F.struct(
                F.lit(w).cast("long").alias("context_limit"),
                kept.cast("long").alias("kept_tokens"),
                (F.max("total_tokens") - kept).cast("long").alias("cut_tokens"),
                F.coalesce(below["whole_tokens"], zero).alias("whole_tokens"),
                F.coalesce(below["share"], F.lit(0.0)).alias("share"),
            )
        )
    found = summed.agg(F.count("*").alias("n"), F.array(*answers).alias("answers")).where("n > 0")
    return found.select(F.explode("answers").alias("a")).select("a.*")


def quantiles(summed: DataFrame, shares: Sequence[float]) -> DataFrame:
    """(share, length): the least length that the given share of documents does not exceed, exact, from ``limits``."""
    answers = [
        F.struct(F.lit(float(q)).alias("share"), F.min(F.when(F.col("share") >= q, F.col("context_limit"))).alias("length"))
        for q in shares
    ]
    found = summed.agg(F.count("*").alias("n"), F.array(*answers).alias("answers")).where("n > 0")
    return found.select(F.explode("answers").alias("a")).select("a.*")
