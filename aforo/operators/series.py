"""Monthly series by country, the all-country series, gap filling and chart feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH, COUNTRY, QUANTITY = "fecha_month", "pais_nombre_origen", "cantidad_quintal"
PRICES = (
    "precio_fob_usd_quintal",
    "precio_fob_cad_quintal",
    "precio_cif_usd_quintal",
    "precio_cif_cad_quintal",
)


def monthly_by_country(
    df: DataFrame,
    quantity: str,
    prices: Sequence[str],
    month: str = MONTH,
    country: str = COUNTRY,
    names: Sequence[str] = PRICES,
    quantity_name: str = QUANTITY,
) -> DataFrame:
    """Sum of quantity and unweighted mean of each price by month and country; NULL keys dropped."""
    return (
        df.filter(F.col(month).isNotNull() & F.col(country).isNotNull())
        .groupBy(month, country)
        .agg(
            F.coalesce(F.sum(quantity), F.lit(0)).alias(quantity_name),
            *[F.avg(p).alias(n) for p, n in zip(prices, names, strict=True)],
        )
    )


def monthly_state(
    df: DataFrame,
    quantity: str,
    prices: Sequence[str],
    also: Sequence[str] = (),
    month: str = MONTH,
    country: str = COUNTRY,
    names: Sequence[str] = PRICES,
    quantity_name: str = QUANTITY,
) -> DataFrame:
    """What :func:`monthly_by_country` is made from, in a form that can be added up: sums and counts.

    ``also`` are columns to group by besides, such as the period by which the state is stored.
    """
    return (
        df.filter(F.col(month).isNotNull() & F.col(country).isNotNull())
        .groupBy(*also, month, country)
        .agg(
            F.coalesce(F.sum(quantity), F.lit(0)).alias(quantity_name),
            *[F.sum(p).alias(f"{n}_sum") for p, n in zip(prices, names, strict=True)],
            *[F.count(p).alias(f"{n}_count") for p, n in zip(prices, names, strict=True)],
        )
    )


def monthly_from_state(
    state: DataFrame,
    month: str = MONTH,
    country: str = COUNTRY,
    names: Sequence[str] = PRICES,
    quantity_name: str = QUANTITY,
) -> DataFrame:
    """The rows of :func:`monthly_by_country` from any number of states."""
    return state.groupBy(month, country).agg(
        F.sum(quantity_name).alias(quantity_name),
        *[(F.sum(f"{n}_sum") / F.nullif(F.sum(f"{n}_count"), F.lit(0))).alias(n) for n in names],
    )


def monthly_all(
    df: DataFrame,
    label: str,
    month: str = MONTH,
    country: str = COUNTRY,
    quantity: str = QUANTITY,
    prices: Sequence[str] = PRICES,
) -> DataFrame:
    """One row per month over all countries: sum of quantity, prices weighted by quantity.

    NULL prices and quantities count as 0; a month without weight gives NULL prices.
    """
    q = F.coalesce(F.col(quantity), F.lit(0))
    weight = F.nullif(F.sum(q), F.lit(0))
    out = df.groupBy(month).agg(
        F.sum(q).alias(quantity),
        *[(F.sum(F.coalesce(F.col(p), F.lit(0)) * q) / weight).alias(p) for p in prices],
    )
    return out.select(month, F.lit(label).alias(country), quantity, *prices)


def date_bounds(df: DataFrame, day: str) -> DataFrame:
    """One row with the first and the last date."""
    return df.agg(F.min(day).alias("date_from"), F.max(day).alias("date_to"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def fill_months(
    df: DataFrame,
    month: str = MONTH,
    country: str = COUNTRY,
    quantity: str = QUANTITY,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Every country gets every month between the first and the last; new rows carry quantity 0.

    ``bounds`` (``date_from``, ``date_to``) gives other limits than those of ``df``. Existing rows
    outside the limits stay, as do several rows of one month.
    """
    limits = date_bounds(df, month) if bounds is None else bounds
    # Two scalar subqueries bring the limits in, so no join without keys is needed.
    first = limits.select("date_from").scalar()
    last = limits.select("date_to").scalar()
    grid = (
        distinct_values(df, country)
        .withColumns({"__first": first, "__last": last})
        .select(
            country,
            F.explode(F.sequence("__first", "__last", F.expr("interval 1 month"))).alias(month),
        )
    )
    missing = grid.join(df.select(country, month), [country, month], "left_anti")
    filled = df.unionByName(missing, allowMissingColumns=True)
    return filled.withColumn(quantity, F.coalesce(F.col(quantity), F.lit(0)))


def country_list(df: DataFrame, country: str = COUNTRY, first: str = "all") -> DataFrame:
    """``first`` and then the distinct countries in lower case, in alphabetical order."""
    names = df.select(F.lower(country).alias("country"), F.lit(1).alias("rank")).distinct()
    head = df.sparkSession.range(1).select(F.lit(first).alias("country"), F.lit(0).alias("rank"))
    return head.unionByName(names).orderBy("rank", "country").select("country")


def by_country(df: DataFrame, name: str, country: str = COUNTRY) -> DataFrame:
    return df.filter(F.col(country) == F.lit(name))


def _capitalized(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 1 << 30)))


def chart_feed(
    df: DataFrame,
    all_label: str,
    month: str = MONTH,
    country: str = COUNTRY,
    quantity: str = QUANTITY,
    fob: str = PRICES[0],
    cif: str = PRICES[2],
) -> DataFrame:
    """Bar value and label, two price lines with ``$`` labels and the chart title, per country."""

    def dollars(c: str) -> Column:
        return F.concat(F.lit("$"), F.translate(F.format_number(c, 0), ",", ""))

    key = F.when(F.col(country) == F.lit(all_label), F.lit("all")).otherwise(F.lower(country))
    title = F.concat(F.lit("Pais: "), _capitalized(F.element_at(F.split(key, "_"), -1)))
    return df.select(
        title.alias("title"),
        F.col(month),
        F.col(quantity),
        F.format_number(quantity, 0).alias("cantidad_label"),
        F.col(fob),
        dollars(fob).alias("precio_fob_label"),
        F.col(cif),
        dollars(cif).alias("precio_cif_label"),
    )
