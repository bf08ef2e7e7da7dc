"""Code dimensions, currency rate files and the open-data catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_dimension(
    spark: SparkSession, path: str, code: str, label: str, code_type: str = "int"
) -> DataFrame:
    """``code;label`` file with header, quotes allowed."""
    return (
        spark.read.schema(f"`{code}` {code_type}, `{label}` string")
        .options(sep=";", header="true", encoding="UTF-8", escape='"', mode="FAILFAST")
        .csv(path)
    )


def read_dimensions(
    spark: SparkSession, folder: str, names: Sequence[str], prefix: str = "aduana_codigos_"
) -> dict[str, DataFrame]:
    """The dimension files ``<prefix><name>.csv`` of a folder, by name."""
    return {
        n: read_dimension(spark, f"{folder}/{prefix}{n}.csv", "code", "name") for n in names
    }


def _rate_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str,
    date_format: str,
    decimal_comma: bool,
    extension: str,
) -> DataFrame:
    raw = (
        spark.read.schema("day string, rate string")
        .options(sep=sep, header="false", pathGlobFilter=f"Indicador_*.{extension}")
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    code = F.regexp_extract(F.col("_metadata.file_name"), r"^[^_]*_([^_.]*)", 1)
    rate = F.translate("rate", ",", ".") if decimal_comma else F.col("rate")
    return raw.select(
        code.alias("currency_code"),
        F.try_to_date(F.trim("day"), date_format).alias("currency_date"),
        F.trim(rate).try_cast("double").alias("to_clp"),
        F.col("rate").alias("raw"),
    ).filter(F.col("currency_date").isNotNull())


def read_rates(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ";",
    date_format: str = "yyyy-MM-dd",
    decimal_comma: bool = False,
    extension: str = "csv",
) -> DataFrame:
    """One rate file per currency as (currency_code, currency_date, to_clp).

    The currency comes from the file name ``Indicador_<code>``. Title lines, the header and lines
    without a date are dropped; a date without a rate stays with NULL, and so does one whose rate is
    no number, which :func:`rate_rejects` lists.
    """
    return _rate_lines(spark, paths, sep, date_format, decimal_comma, extension).drop("raw")


def rate_rejects(
    spark: SparkSession,
    paths: str | Sequence[str],
    sep: str = ";",
    date_format: str = "yyyy-MM-dd",
    decimal_comma: bool = False,
    extension: str = "csv",
) -> DataFrame:
    """Rates that are written but are no number, as (currency_code, currency_date, raw)."""
    lines = _rate_lines(spark, paths, sep, date_format, decimal_comma, extension)
    written = F.trim("raw") != ""
    return lines.filter(written & F.col("to_clp").isNull()).drop("to_clp")


# Fields of a package that the flattening needs; resources are open and come from the data unless
# a schema is given.
def package_schema(resource: T.StructType) -> T.StructType:
    text = T.StringType()
    organization = T.StructType().add("id", text).add("name", text).add("title", text)
    return (
        T.StructType()
        .add("id", text)
        .add("name", text)
        .add("title", text)
        .add("notes", text)
        .add("organization", organization)
        .add("resources", T.ArrayType(resource))
    )


def read_catalogue(
    spark: SparkSession,
    path: str,
    resource: T.StructType | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Saved search pages ``{"result": {"results": [...]}}`` as one row per package.

    Without ``resource`` the schema is inferred, which reads the pages once more.
    """
    reader = spark.read.option("multiLine", str(multiline).lower())
    if resource is not None:
        results = T.ArrayType(package_schema(resource))
        page = T.StructType().add("result", T.StructType().add("results", results))
        reader = reader.schema(page)
    return (
        reader.json(path)
        .select(F.explode("result.results").alias("package"))
        .select("package.*")
    )
