"""Discovery of source files and positional headers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.operators.ledger import keep_latest_year

SAMPLE_MARK = "sample"


def file_name(path: Column | str = "path") -> Column:
    col = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(col, "/"), -1)


def file_year(name: Column | str = "file_name") -> Column:
    """Second ``_`` token of the file name without its extension."""
    col = F.col(name) if isinstance(name, str) else name
    return F.regexp_extract(col, r"^[^_]*_([^_.]*)", 1)


def trade_paths(
    spark: SparkSession,
    root: str,
    sample: bool = False,
    prefixes: Sequence[str] = ("import", "export"),
    extension: str = ".zip",
) -> DataFrame:
    """Files below ``root`` by name prefix and extension, as (trade_type, file_name, path, length, modified).

    ``sample`` takes the files with ``sample`` in the name and leaves the others, or the other way
    round. Only the listing is read: the content column is pruned.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{extension}")
        .load(root)
        .select("path", "length", F.col("modificationTime").alias("modified"))
        .withColumn("file_name", file_name())
    )
    trade = F.regexp_extract("file_name", f"^({'|'.join(prefixes)})", 1)
    marked = F.col("file_name").contains(SAMPLE_MARK)
    return (
        listed.withColumn("trade_type", trade)
        .filter((F.col("trade_type") != "") & (marked if sample else ~marked))
        .select("trade_type", "file_name", "path", "length", "modified")
    )


def latest_files(paths: DataFrame) -> DataFrame:
    """Files of the greatest year over all trade types together."""
    return keep_latest_year(paths, file_year())


def sanitize_names(names: Sequence[str | None]) -> list[str]:
    """Header texts to column names: blanks dropped, trimmed, other runs than letters and digits
    to ``_``."""
    present = [n.strip() for n in names if n is not None and n.strip()]
    return [re.sub("[^0-9a-zA-Z]+", "_", n) for n in present]


def read_manifest(spark: SparkSession, path: str) -> list[str]:
    """Column names from a text file, one per line in file order; a few hundred at most."""
    files = spark.read.text(path, wholetext=True).take(2)
    if len(files) > 1:
        raise ValueError(f"more than one file of names in {path}")
    return sanitize_names(files[0]["value"].splitlines() if files else [])


def apply_manifest(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Assign column names by position; a different number of columns is an error."""
    clean = sanitize_names(names)
    if len(clean) != len(df.columns):
        raise ValueError(f"{len(clean)} names for {len(df.columns)} columns")
    return df.toDF(*clean)
