"""Report rows to gap-free monthly price series per country and for all countries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.fixed_values import ALL_COUNTRIES
from aforo.functions.amounts import quintal_prices, to_quintal
from aforo.functions.text import rstrip_ws
from aforo.operators.series import (
    COUNTRY,
    MONTH,
    date_bounds,
    fill_months,
    monthly_all,
    monthly_by_country,
    monthly_from_state,
    monthly_state,
)
from aforo.operators.ledger import PERIOD
from aforo.plans.cleaned_tables import refresh_cleaned
from aforo.session import staged

UNIT_PRICES = ("precio_fob_usd", "precio_fob_cad", "precio_cif_usd", "precio_cif_cad")


def _priced(report: DataFrame, cif_cad_rate: str | None = None) -> DataFrame:
    """Non-seed report rows with quintals and their prices."""
    rows = report.filter(F.col("is_siembra") == 0).withColumns(
        {COUNTRY: rstrip_ws(COUNTRY), "quintal": to_quintal("CANT_MERC_MOD")}
    )
    return quintal_prices(rows, "PRE_UNIT_MOD", "PRE_UNIT_CIF", cif_cad_rate=cif_cad_rate)


def country_prices(report: DataFrame, cif_cad_rate: str | None = None) -> DataFrame:
    """Non-seed report rows to one row per month and country."""
    return monthly_by_country(_priced(report, cif_cad_rate), "quintal", UNIT_PRICES)


def filled_series(monthly: DataFrame, label: str = ALL_COUNTRIES) -> tuple[DataFrame, DataFrame]:
    """(series per country, series over all countries) of a staged monthly aggregate, every month filled."""
    everything = monthly_all(monthly, label)
    limits = date_bounds(monthly, MONTH)
    return fill_months(monthly, bounds=limits), fill_months(everything, bounds=limits)


def price_series(report: DataFrame, label: str = ALL_COUNTRIES) -> tuple[DataFrame, DataFrame]:
    """(series per country, series over all countries), every month filled.

    The monthly aggregate is staged: it is small, and the grid, its limits and both series use it.
    """
    return filled_series(staged(country_prices(report), "monthly-country"), label)


def refresh_series(
    spark: SparkSession,
    cleaned: str,
    report: Callable[[DataFrame], DataFrame],
    path: str,
    version: str,
    label: str = ALL_COUNTRIES,
) -> tuple[DataFrame, DataFrame]:
    """The price series from a state of sums and counts at ``path`` that follows the cleaned table by period.

    ``report`` makes report rows from cleaned rows with their period kept. Only periods whose cleaned rows changed are
    reported and added up again; ``version`` stands for rates and rules, which change all of them.
    """

    def summed(rows: DataFrame) -> DataFrame:
        return monthly_state(_priced(report(rows)), "quintal", UNIT_PRICES, also=[PERIOD])

    refresh_cleaned(spark, cleaned, summed, path, version)
    return filled_series(staged(monthly_from_state(spark.read.parquet(path)), "monthly-country"), label)
