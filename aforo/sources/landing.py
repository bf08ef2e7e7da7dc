"""Ingest manifest: which archives were landed, and how many rows of each period they hold.

An archive is known by path, length and time of change. A run unpacks the archives that are new or replaced, and of
the others only those that hold rows of a period that must be loaded again, since periods are loaded whole.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.operators.ledger import COUNT, PERIOD, TRADE
from aforo.sinks.tables import replace_table

VERSION = ["path", "length", "modified"]
SCHEMA = f"path string, length long, modified timestamp, {TRADE} string, {PERIOD} string, {COUNT} long"


def read_manifest_table(spark: SparkSession, path: str) -> DataFrame:
    """The manifest; empty where none was written yet."""
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def new_archives(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """Archives that no run has landed as they are now."""
    return found.join(manifest.select(*VERSION).distinct(), VERSION, "left_anti")


def unchanged(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """The manifest's rows of archives that are still there as they were landed."""
    return manifest.join(found.select(*VERSION), VERSION, "left_semi")


def counted(archives: DataFrame, facts: Mapping[str, DataFrame]) -> DataFrame:
    """Manifest rows of the archives: rows per table and period of ``facts``, which name their archive in ``path``.

    An archive without rows has one row without a period, so that it counts as landed.
    """
    rows = archives.select(*VERSION, F.lit(None).cast("string").alias(TRADE), F.lit(None).cast("string").alias(PERIOD),
                           F.lit(0).cast("long").alias(COUNT))
    for trade, df in facts.items():
        counts = df.groupBy("path", PERIOD).agg(F.count("*").alias(COUNT))
        # Few archives beside few periods: the manifest grows with their product, not with the rows.
        found = archives.select(*VERSION).join(counts, "path").withColumn(TRADE, F.lit(trade))
        rows = rows.unionByName(found.select(*rows.columns))
    return rows


def manifest_ledger(*manifests: DataFrame) -> DataFrame:
    """Incoming rows per table and period, added up over all archives."""
    rows = manifests[0]
    for more in manifests[1:]:
        rows = rows.unionByName(more)
    return rows.where(F.col(PERIOD).isNotNull()).groupBy(TRADE, PERIOD).agg(F.sum(COUNT).alias(COUNT))


def archives_of(manifest: DataFrame, periods: DataFrame) -> DataFrame:
    """(path) of the archives that hold rows of the listed periods."""
    return manifest.join(periods.select(TRADE, PERIOD), [TRADE, PERIOD], "left_semi").select("path").distinct()


def write_manifest(manifest: DataFrame, path: str) -> None:
    replace_table(manifest, path)
