"""Catalog and path tables: refresh, append, replacement of periods, materialized results; deletes are in ``deletes``."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from aforo.functions.timestamps import timestamps_to_text
from aforo.session import drop_path, move_path

PERIOD = "period_id"


def spread_by(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of one partition value together before a partitioned write.

    Adaptive execution splits a value that holds much and merges those that hold little, so a
    period with a third of all rows is still written by many tasks.
    """
    return df.hint("rebalance", *columns)


def refresh_table(df: DataFrame, name: str, path: str | None = None, partitions: Sequence[str] = ()) -> None:
    """Replace the whole content of a catalog table that ``df`` does not read.

    ``path`` keeps the files outside the warehouse, ``partitions`` are the table's partition columns.
    """
    writer = (spread_by(df, *partitions) if partitions else df).write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(name)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Drop and rebuild a table from a plan, then read it back."""
    refresh_table(df, name, path)
    return df.sparkSession.table(name)


def append_table(
    df: DataFrame, path: str, partition: str | None = PERIOD, text_times: bool = False, spread: bool = True
) -> None:
    """Append facts to a Parquet table, partitioned by period.

    ``spread`` off leaves rows in the tasks that have them, for a frame whose periods lie together already.
    """
    if text_times:
        df = timestamps_to_text(df)
    if partition is None:
        df.write.mode("append").parquet(path)
    else:
        (spread_by(df, partition) if spread else df).write.mode("append").partitionBy(partition).parquet(path)


def replace_periods(df: DataFrame, path: str, partition: str = PERIOD, spread: bool = True) -> None:
    """Write the periods of ``df`` in place of what the table holds for them.

    Delete and insert are one job; periods that ``df`` does not contain are not touched. ``spread`` off leaves rows in
    the tasks that have them, for a frame whose periods lie together already.
    """
    (
        (spread_by(df, partition) if spread else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def partition_path(path: str, column: str, value: str) -> str:
    """The folder of one partition of a path table, with the value escaped as Spark escapes it."""
    escaped = SparkSession.active()._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)
    return f"{path}/{column}={escaped}"


def replace_table(df: DataFrame, path: str) -> None:
    """Write a small path table anew; until the last step the old one can be read."""
    spark, new = df.sparkSession, f"{path}_{uuid.uuid4().hex}"
    df.write.parquet(new)
    drop_path(spark, path)
    move_path(spark, new, path)


def register_path(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A catalog table over a path table, with the partitions and columns that it holds now."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path, "parquet")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Name plans so that SQL can use them; nothing is computed."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
