"""Delimited text whose quoted fields hold line ends, read in splits.

A split cannot tell by itself whether it begins inside quotes. One scan adds up the quotes of every split; the parity of
all splits before one says how it begins. With that each split assembles its records alone, but for the pieces at its ends, which
are few and are put together by file.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aforo.session import staged

register_pickle_by_value(sys.modules[__name__])

RECORD, HEAD, TAIL = 0, 1, 2
PIECES = "file string, start long, kind int, value string"
LONGEST_RECORD = 1 << 20
# Text that one task reads at least, whatever the size of the splits.
TASK_BYTES = 16 << 20


def tasks_for(spark: SparkSession, paths: str | Sequence[str]) -> int:
    """Tasks that the files are worth, from their listing: small splits are many, but share them."""
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    tasks = spark.sparkContext.defaultParallelism
    size = files.coalesce(tasks).agg(F.sum("length")).first()[0] or 0
    return max(tasks, size // TASK_BYTES)


def _lines(spark: SparkSession, paths: str | Sequence[str], tasks: int) -> DataFrame:
    """(file, start, value): lines with the split they are in. A carriage return stays at the end of its line.

    A task reads its splits one after the other.
    """
    text = spark.read.text(paths if isinstance(paths, str) else list(paths), lineSep="\n").coalesce(tasks)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def split_parity(spark: SparkSession, paths: str | Sequence[str], tasks: int | None = None) -> DataFrame:
    """(file, start, inside, open, odd_lines) per split: whether it begins inside quotes, whether it ends inside, and
    how many of its lines hold an odd number of quotes."""
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    splits = _lines(spark, paths, tasks or tasks_for(spark, paths)).groupBy("file", "start").agg(
        F.bit_xor(odd).alias("odd"), F.sum(odd).cast("long").alias("odd_lines")
    )
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("odd").over(before)
    return splits.select(
        "file", "start", ((total - F.col("odd")) % 2 == 1).alias("inside"), (total % 2 == 1).alias("open"), "odd_lines"
    )


def _assembled(batches: Iterator[pa.RecordBatch], inside: dict[str, frozenset[int]], longest: int) -> Iterator[pa.RecordBatch]:
    """Records of the splits, and their first and last pieces where a record reaches over the end of one."""
    split, pending, opened, size, first = None, [], False, 0, False
    rows: list[tuple] = []

    def ended() -> None:
        if pending:  # what a split leaves open goes on in the next one
            rows.append((*split, HEAD if first else TAIL, "\n".join(pending)))

    def made() -> pa.RecordBatch:
        columns = list(zip(*rows))
        rows.clear()
        types = [pa.string(), pa.int64(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["file", "start", "kind", "value"]
        )

    for batch in batches:
        for file, start, line in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (file, start) != split:
                ended()
                split, pending, size = (file, start), [], 0
                opened = first = start in inside.get(file, ())
            pending.append(line)
            size += len(line)
            if size > longest:
                raise ValueError(f"malformed record: more than {longest} characters from {pending[0][:80]!r} in {file}")
            opened ^= line.count('"') % 2 == 1
            if not opened:
                value = "\n".join(pending)
                rows.append((*split, HEAD if first else RECORD, value if first else value.rstrip("\r")))
                pending, size, first = [], 0, False
        if rows:
            yield made()
    ended()
    if rows:
        yield made()


def read_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    longest: int = LONGEST_RECORD,
    parity: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """The records of the files in one column ``value``; empty lines outside quotes are no records.

    A quote that is never closed fails the job, as does a record of more than ``longest`` characters.
    """
    tasks = tasks or tasks_for(spark, paths)
    # What is staged here is read in splits of the same size as the text, so the tasks share these as well.
    parity = (staged(split_parity(spark, paths, tasks), "parity") if parity is None else parity).coalesce(tasks)
    last = Window.partitionBy("file").orderBy(F.desc("start"))
    broken = parity.withColumn("place", F.row_number().over(last)).where("place = 1 AND open")
    if found := broken.take(1):
        raise ValueError(f"malformed file: a quote is not closed in {found[0]['file']}")
    # Where splits begin inside quotes, a number each: at most as many as Spark's own list of splits on the driver.
    begun = parity.where("inside").groupBy("file").agg(F.collect_list("start").alias("starts"))
    inside = {r["file"]: frozenset(r["starts"]) for r in begun.collect()}

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _assembled(batches, inside, longest)

    pieces = staged(_lines(spark, paths, tasks).mapInArrow(assemble, PIECES), "records").coalesce(tasks)
    # A tail begins a record that goes on through heads of the next splits. A split without any end of a record is one head.
    order = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    ends = pieces.where(F.col("kind") != RECORD)
    numbered = ends.withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    parts = F.array_sort(F.collect_list(F.struct("start", "kind", "value")))
    joined = numbered.groupBy("file", "record").agg(F.array_join(parts["value"], "\n").alias("value"))
    whole = joined.select(F.regexp_replace("value", "\r$", "").alias("value"))
    return pieces.where(F.col("kind") == RECORD).select("value").unionByName(whole).where("value != ''")
