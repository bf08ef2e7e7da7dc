"""Cleaned tables kept up to date by period.

A cleaned table is partitioned by period like the facts it is made from. Beside it lies a state: what each period
was built from, as a stamp of the facts' files of the period and of everything else that goes in (dimensions, rules). A
refresh compares stamps and rebuilds the periods whose stamp changed, so a load of one month rewrites one month, a
changed dimension all of them, and a run that follows a failed one what that one left undone.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.operators.ledger import PERIOD
from aforo.operators.relational import row_digest
from aforo.session import drop_path, staged
from aforo.sinks.tables import partition_path, replace_periods, replace_table

STATE = f"{PERIOD} string, stamp string, version string"


def _sum_of(digests: list[Column]) -> Column:
    """Text of sums of row digests: the same for the same rows in any order, with their copies counted."""
    sums = [F.coalesce(F.sum(d.cast("decimal(38,0)")), F.lit(0)).cast("string") for d in digests]
    return F.concat_ws("/", F.count("*").cast("string"), *sums)


def table_digest(df: DataFrame) -> str:
    """A digest of a small table's columns and rows."""
    return f"{df.schema.simpleString()}:{df.agg(_sum_of(row_digest(df)).alias('digest')).first()['digest']}"


def version_of(dims: Mapping[str, DataFrame], rules: object = "") -> str:
    """One digest of all that a cleaned table depends on beside its facts."""
    parts = [f"{name}={table_digest(dims[name])}" for name in sorted(dims)]
    return "\n".join([*parts, repr(rules)])


def period_stamps(spark: SparkSession, path: str, period: str = PERIOD) -> DataFrame:
    """(period, stamp) of a partitioned path table: its files' names, sizes and times, from listings alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    named = files.select(F.col(period).cast("string").alias(PERIOD), "path", "length", "modificationTime")
    return named.groupBy(PERIOD).agg(_sum_of(row_digest(named)).alias("stamp"))


def _state(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(STATE).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STATE)


def _stamps(spark: SparkSession, path: str) -> dict[str, str]:
    """The stamps of a table that may not be there yet; one entry a month."""
    try:
        return {r[PERIOD]: r["stamp"] for r in period_stamps(spark, path).collect()}
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNRESOLVED_COLUMN.WITH_SUGGESTION", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return {}


def changed_periods(state: DataFrame, stamps: DataFrame, version: str) -> DataFrame:
    """(period, action): ``build`` what is new or made from something else, ``remove`` what the facts lack."""
    now = stamps.select(PERIOD, F.col("stamp").alias("now"))
    both = state.join(now, PERIOD, "full")
    same = (F.col("stamp") == F.col("now")) & (F.col("version") == F.sha2(F.lit(version), 256))
    action = F.when(F.col("now").isNull(), "remove").when(~F.coalesce(same, F.lit(False)), "build")
    return both.select(PERIOD, action.alias("action")).where("action IS NOT NULL")


def refresh_cleaned(
    spark: SparkSession,
    facts: str,
    build: Callable[[DataFrame], DataFrame],
    path: str,
    version: str,
    state: str | None = None,
    spread: bool = True,
) -> DataFrame:
    """Bring the cleaned table at ``path`` up to date with the facts at the path ``facts``; returns the changed periods.

    ``build`` makes rows from those of some periods, with the period kept and none from two periods together. The periods are calendar months, so their list may
    pass through the driver; the facts' other periods are not read and the table's others not written. The state is
    written last: after a failure the next refresh does the same periods again.

    With ``spread`` off rows are written by the tasks that made them. That suits a ``build`` that looks at one row at a
    time: its tasks read the facts by period, so each holds few periods and no shuffle need bring them together.
    """
    state = state or f"{path}_state"
    stamps = staged(period_stamps(spark, facts), "stamps")
    changed = staged(changed_periods(_state(spark, state), stamps, version), "changed")
    listed = {r[PERIOD]: r["action"] for r in changed.collect()}
    rebuilt = [p for p, action in listed.items() if action == "build"]
    if rebuilt:
        rows = spark.read.parquet(facts).where(F.col(PERIOD).cast("string").isin(rebuilt))
        before = _stamps(spark, path)
        replace_periods(build(rows), path, spread=spread)
        after = _stamps(spark, path)
        # A period that no longer gives rows was not written, so its old rows are still there.
        listed |= {p: "remove" for p in rebuilt if p in before and before[p] == after.get(p)}
    for period, action in listed.items():
        if action == "remove":
            drop_path(spark, partition_path(path, PERIOD, period))
    if listed:
        replace_table(stamps.withColumn("version", F.sha2(F.lit(version), 256)).coalesce(1), state)
    return changed
