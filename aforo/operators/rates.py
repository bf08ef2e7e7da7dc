"""Daily and monthly currency rates."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aforo.functions.keys import month_start
from aforo.operators.joins import lookup_join

CODE, DAY, CLP = "currency_code", "currency_date", "to_clp"


def daily_mean(df: DataFrame, code: str = CODE, day: str = DAY, value: str = CLP) -> DataFrame:
    """Mean per code and day; only combinations that occur, NULL values ignored, NULL keys dropped."""
    return (
        df.filter(F.col(code).isNotNull() & F.col(day).isNotNull())
        .groupBy(code, day)
        .agg(F.avg(value).alias(value))
    )


def ffill(df: DataFrame, code: str = CODE, day: str = DAY, value: str = CLP) -> DataFrame:
    """NULL takes the last value before it, by code in date order; leading NULLs stay.

    Expects one row per code and day, as :func:`daily_mean` gives. A window partition then holds at
    most one row per calendar day, however many observations lie behind it.
    """
    w = Window.partitionBy(code).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.last(value, ignorenulls=True).over(w))


def forecast_rates(
    df: DataFrame,
    codes: Sequence[str],
    as_of: date | Column | None = None,
    horizon: int = 730,
    short_horizon: int = 30,
    lag_days: int = 45,
    code: str = CODE,
    day: str = DAY,
    value: str = CLP,
) -> DataFrame:
    """Append a daily NULL grid for every code, from the last date of the whole table on.

    ``horizon`` days if the last date is ``lag_days`` or more before ``as_of``, else
    ``short_horizon``. The NULLs are meant to be filled by :func:`ffill`.
    """
    if as_of is None:
        as_of = F.current_date()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of)
    last = df.agg(F.max(day).alias("last_day")).filter("last_day is not null")
    days = F.when(F.col("last_day") <= F.date_sub(as_of, lag_days), horizon).otherwise(short_horizon)
    grid = last.select(
        F.explode(F.sequence("last_day", F.date_add("last_day", days))).alias(day)
    ).select(
        F.explode(F.array(*[F.lit(c) for c in codes])).alias(code),
        day,
        F.lit(None).cast("double").alias(value),
    )
    return df.select(code, day, value).unionByName(grid)


def cross_rates(
    df: DataFrame, codes: Sequence[str], code: str = CODE, day: str = DAY, value: str = CLP
) -> DataFrame:
    """Add ``to_<code>`` for every code: the row's value over that code's value of the same day.

    Days on which any of the codes has no row are dropped. Expects one row per code and day, so
    a window partition holds one row per currency.
    """
    w = Window.partitionBy(day)
    present, rates = F.lit(True), {}
    for c in codes:
        own = F.col(code) == F.lit(c)
        present = present & F.coalesce(F.max(F.when(own, F.lit(True))).over(w), F.lit(False))
        divisor = F.max(F.when(own, F.col(value))).over(w)
        rates[f"to_{c}"] = F.col(value) / F.nullif(divisor, F.lit(0.0))
    return (
        df.withColumns({**rates, "__present": present}).filter("__present").drop("__present")
    )


def currency_converter(
    raw: DataFrame, codes: Sequence[str], as_of: date | None = None, **horizons: int
) -> DataFrame:
    """Raw rates to the daily converter table: forecast, daily mean, forward fill, cross rates."""
    daily = daily_mean(forecast_rates(raw, codes, as_of, **horizons))
    return cross_rates(ffill(daily), codes)


def monthly_rates(
    df: DataFrame,
    rates: Sequence[str],
    codes: Sequence[str] | None = None,
    code: str = CODE,
    day: str = DAY,
) -> DataFrame:
    """Mean of each rate by code and month.

    ``codes`` keeps the listed ones only, which bounds the result by codes times calendar months.
    """
    if codes is not None:
        df = df.filter(F.col(code).isin(list(codes)))
    return df.groupBy(code, month_start(day).alias("currency_month")).agg(
        *[F.avg(r).alias(r) for r in rates]
    )


def with_monthly_rates(
    facts: DataFrame,
    converter: DataFrame,
    codes: Sequence[str],
    rates: Sequence[str],
    month: str,
    code: str = CODE,
) -> DataFrame:
    """Left join of facts with the monthly means of the daily converter table.

    The joined side holds at most ``len(codes)`` rows per calendar month (the date type ends
    with the year 9999), which bounds what is broadcast without counting it.
    """
    monthly = monthly_rates(converter, rates, codes).withColumnRenamed(CODE, "rate_code")
    on = [(code, "rate_code"), (month, "currency_month")]
    return lookup_join(facts, monthly, on, "left", small=True)
