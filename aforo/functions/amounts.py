"""Amounts written as locale text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_amount(
    amount: Column | str, keep_sign: bool = True, precision: int = 15, scale: int = 2
) -> Column:
    """Locale amount text to decimal.

    The decimal comma becomes a dot and everything but digits, dots and (with ``keep_sign``) minus
    is removed. NULL and text without any digit left count as 0; text that still is no number, such
    as ``1.234.5``, gives NULL and shows up in :func:`amount_rejects`.
    """
    col = F.col(amount) if isinstance(amount, str) else amount
    stray = r"[^0-9.\-]+" if keep_sign else "[^0-9.]+"
    kept = F.regexp_replace(F.replace(col.cast("string"), F.lit(","), F.lit(".")), stray, "")
    filled = F.coalesce(F.nullif(kept, F.lit("")), F.lit("0"))
    return filled.try_cast(f"decimal({precision},{scale})")


def clean_amounts(df: DataFrame, columns: list[str], suffix: str = "_MOD", **kw) -> DataFrame:
    """Add ``<column><suffix>`` for every amount column; the raw text stays."""
    return df.withColumns({f"{c}{suffix}": clean_amount(c, **kw) for c in columns})


def amount_rejects(df: DataFrame, columns: list[str], suffix: str = "_MOD") -> DataFrame:
    """One row: the number of malformed values per cleaned column (cleaning only nulls those)."""
    return df.agg(
        *[F.count_if(F.col(f"{c}{suffix}").isNull()).alias(f"{c}_rejects") for c in columns]
    )


def unit_price_cif(amount: Column | str, quantity: Column | str) -> Column:
    """``amount / quantity``, NULL where the quantity is 0."""
    num = F.col(amount) if isinstance(amount, str) else amount
    den = F.col(quantity) if isinstance(quantity, str) else quantity
    return num / F.nullif(den, F.lit(0).cast("int"))


def quintal_prices(
    df: DataFrame,
    fob_unit: str,
    cif_unit: str,
    to_usd: str = "to_usd",
    to_cad: str = "to_cad",
    cif_cad_rate: str | None = None,
) -> DataFrame:
    """Prices per 100 kg in usd and cad, FOB and CIF.

    ``cif_cad_rate`` names another rate column for the CIF price in cad, for comparison with figures
    that were computed with the usd rate.
    """
    rates: Mapping[str, tuple[str, str]] = {
        "precio_fob_usd": (fob_unit, to_usd),
        "precio_fob_cad": (fob_unit, to_cad),
        "precio_cif_usd": (cif_unit, to_usd),
        "precio_cif_cad": (cif_unit, cif_cad_rate or to_cad),
    }
    return df.withColumns(
        {
            name: F.col(unit).cast("double") * F.col(rate) * F.lit(100.0)
            for name, (unit, rate) in rates.items()
        }
    )


def to_quintal(quantity: Column | str) -> Column:
    """Kilograms to whole quintals, halves rounded to the even number."""
    col = F.col(quantity) if isinstance(quantity, str) else quantity
    return F.bround(col.cast("double") / F.lit(100.0), 0)
