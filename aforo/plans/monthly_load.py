"""Incremental load by period: new periods are added, incomplete ones replaced."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.operators.ledger import (
    TRADE,
    compare_ledgers,
    incoming_ledger,
    load_plan,
    loaded_ledger,
    only_periods,
)
from aforo.session import staged
from aforo.sinks.tables import replace_periods


@dataclass(frozen=True)
class LoadResult:
    periods: DataFrame
    loaded: Mapping[str, bool]

    @property
    def any_loaded(self) -> bool:
        return any(self.loaded.values())


def plan_load(
    spark: SparkSession, paths: Mapping[str, str], like: Mapping[str, DataFrame], incoming: DataFrame
) -> DataFrame:
    """The periods to load or replace, from the ledger of what comes in; ``like`` has the tables' columns.

    A table whose path holds nothing yet counts as empty. The list is staged before any write, since the
    writes change what it is derived from.
    """
    tables = {t: _existing(spark, path, like[t]) for t, path in paths.items()}
    return staged(load_plan(compare_ledgers(loaded_ledger(tables), incoming)), "load-plan")


def load_periods(paths: Mapping[str, str], incoming: Mapping[str, DataFrame], periods: DataFrame) -> LoadResult:
    """Write the planned periods of every table in place of what it holds for them."""
    loaded = {}
    for trade, path in paths.items():
        loaded[trade] = not periods.filter(F.col(TRADE) == trade).isEmpty()
        if loaded[trade]:
            replace_periods(only_periods(incoming[trade], periods, trade), path)
    return LoadResult(periods, loaded)


def incremental_load(
    spark: SparkSession, paths: Mapping[str, str], incoming: Mapping[str, DataFrame]
) -> LoadResult:
    """Bring each table at ``paths[trade]`` up to date with ``incoming[trade]``. Running it again changes nothing."""
    return load_periods(paths, incoming, plan_load(spark, paths, incoming, incoming_ledger(incoming)))


def _existing(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0)


def refresh_reports_if(result: LoadResult, rebuild) -> bool:
    """Run ``rebuild`` only when the load wrote rows."""
    if result.any_loaded:
        rebuild()
    return result.any_loaded
