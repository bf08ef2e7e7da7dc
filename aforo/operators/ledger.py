"""Load ledgers: rows per trade table and period, and what they say about loading."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aforo.functions.text import rstrip_ws
from aforo.operators.joins import lookup_join

TRADE, PERIOD, COUNT = "trade_type", "period_id", "num_records"


def with_trade(df: DataFrame, name: str, column: str = TRADE) -> DataFrame:
    return df.withColumn(column, F.lit(name))


def incoming_ledger(tables: Mapping[str, DataFrame], period: str = PERIOD) -> DataFrame:
    """Rows per trade table and period."""
    parts = [
        df.groupBy(F.col(period).alias(PERIOD))
        .agg(F.count("*").alias(COUNT))
        .select(F.lit(name).alias(TRADE), PERIOD, COUNT)
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def loaded_ledger(tables: Mapping[str, DataFrame], period: str = PERIOD) -> DataFrame:
    """Like :func:`incoming_ledger`, with trailing blanks of the stored period removed.

    Only the counted groups are trimmed, not every row.
    """
    counted = incoming_ledger(tables, period)
    return counted.groupBy(TRADE, rstrip_ws(PERIOD).alias(PERIOD)).agg(F.sum(COUNT).alias(COUNT))


def period_order(period: str = PERIOD) -> list[Column]:
    """Sort keys for the unpadded period text: year and month as numbers."""
    return [
        F.split_part(F.col(period), F.lit("-"), F.lit(n)).try_cast("int") for n in (1, 2)
    ]


def sorted_ledger(df: DataFrame) -> DataFrame:
    return df.orderBy(TRADE, *period_order())


def compare_ledgers(loaded: DataFrame, incoming: DataFrame) -> DataFrame:
    """Full outer join of the two ledgers: ``num_records_loaded`` and ``num_records_incoming``."""
    left = loaded.withColumnRenamed(COUNT, f"{COUNT}_loaded")
    right = incoming.withColumnRenamed(COUNT, f"{COUNT}_incoming")
    return left.join(right, [TRADE, PERIOD], "full")


def periods_to_load(compared: DataFrame) -> DataFrame:
    """Periods that are in the source and not in the table."""
    return compared.filter(F.col(f"{COUNT}_loaded").isNull()).select(TRADE, PERIOD)


def periods_to_replace(compared: DataFrame) -> DataFrame:
    """Periods on both sides whose counts differ; a period only in the table is left alone."""
    differ = F.col(f"{COUNT}_loaded") != F.col(f"{COUNT}_incoming")
    return compared.filter(differ).select(TRADE, PERIOD)


def load_plan(compared: DataFrame) -> DataFrame:
    """New and incomplete periods from one pass, with ``action`` load or replace."""
    loaded, incoming = F.col(f"{COUNT}_loaded"), F.col(f"{COUNT}_incoming")
    action = F.when(loaded.isNull(), F.lit("load")).when(loaded != incoming, F.lit("replace"))
    return (
        compared.withColumn("action", action)
        .filter(F.col("action").isNotNull())
        .select(TRADE, PERIOD, "action")
    )


def only_periods(
    facts: DataFrame, periods: DataFrame, trade: str | None = None, period: str = PERIOD
) -> DataFrame:
    """Facts of the listed periods.

    Periods are the months of dates; the list is broadcast if its size, which is checked, allows it.
    """
    wanted = periods if trade is None else periods.filter(F.col(TRADE) == F.lit(trade))
    on = [(period, PERIOD)]
    return lookup_join(facts, wanted.select(PERIOD).distinct(), on, "left_semi")


def keep_latest_year(df: DataFrame, year: Column | str) -> DataFrame:
    """Rows of the greatest year of the whole frame; years taken from file names are text."""
    col = F.col(year) if isinstance(year, str) else year
    latest = df.agg(F.max(col).alias("latest")).scalar()
    return df.filter(col == latest)
