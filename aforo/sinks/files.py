"""File sinks: delimited text, report exports, one folder per country, JSON lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from aforo.operators.relational import sample_head
from aforo.operators.series import COUNTRY, country_list
from aforo.sinks.tables import spread_by


FORMATS = ("parquet", "csv")


def _save(writer: DataFrameWriter, path: str, fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"{fmt!r} is none of {', '.join(FORMATS)}")
    writer = writer.mode("overwrite")
    writer.parquet(path) if fmt == "parquet" else writer.options(sep=";", header="true", escape='"').csv(path)


def write_csv(df: DataFrame, path: str, **options: str) -> None:
    """``;`` text without header."""
    (
        df.write.mode("overwrite")
        .options(sep=";", header="false", escape='"')
        .options(**options)
        .csv(path)
    )


def export_reports(reports: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> None:
    """One folder per named report, as Parquet or as ``;`` text with a header."""
    for name, df in reports.items():
        _save(df.write, f"{root}/{name}", fmt)


def export_by_country(
    df: DataFrame, everything: DataFrame, root: str, country: str = COUNTRY, first: str = "all", fmt: str = "parquet"
) -> None:
    """One folder per country in lower case and one for all, from a single write in either format.

    The partition column ``serie`` names the folder, the country column stays in the rows.
    """
    parts = df.withColumn("serie", F.lower(country)).unionByName(
        everything.withColumn("serie", F.lit(first))
    )
    _save(spread_by(parts, "serie").write.partitionBy("serie"), root, fmt)


def write_country_list(df: DataFrame, path: str, country: str = COUNTRY) -> None:
    """``all`` and the countries as JSON, in one file; bounded by the country dimension."""
    country_list(df, country).coalesce(1).write.mode("overwrite").json(path)


def write_sample(df: DataFrame, path: str, order_key: str, n: int = 100) -> None:
    """The first ``n`` records as a text file, for trial runs."""
    sample_head(df, order_key, n).select("value").coalesce(1).write.mode("overwrite").text(path)
