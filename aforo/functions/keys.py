"""Date keys, period keys, record keys and code columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "Unknown"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def integer_text(c: Column | str, kind: T.DataType | None = None) -> Column:
    """Text of an integer that may have been stored as ``123.0`` or as a double, which prints ``1.23E7``.

    ``kind`` is the column's type where it is known: the text of an integer needs no rule and text no exponent, and
    every rule left out keeps the generated code of a wide row short.
    """
    col = _col(c)
    if isinstance(kind, T.IntegralType):
        return col.cast("string")
    text = F.trim(col if isinstance(kind, T.StringType) else col.cast("string"))
    plain = F.when(col.cast("string").contains(".0"), F.regexp_replace(text, r"\.0+$", "")).otherwise(text)
    if isinstance(kind, (T.StringType, T.DecimalType)):
        return plain
    number = text.try_cast("decimal(38,10)")
    whole = number.try_cast("decimal(38,0)")
    written_out = text.rlike(r"^-?[0-9.]+E[0-9]+$") & (number == whole)
    return F.when(written_out, whole.cast("string")).otherwise(plain)


def whole_number(c: Column | str) -> Column:
    """Number or numeric text to bigint, decimals cut off; NULL for other text."""
    col = _col(c)
    return F.coalesce(col.try_cast("bigint"), col.try_cast("double").try_cast("bigint"))


def parse_ddmmyyyy(c: Column | str, first_eight: bool = False, strict: bool = False) -> Column:
    """Date from a DDMMYYYY number without leading zero, as number or text.

    ``first_eight`` looks at the first eight characters only. A value that is no date gives NULL,
    or fails the job with ``strict``.
    """
    number = whole_number(c)
    if first_eight:
        number = F.substring(number.cast("string"), 1, 8).try_cast("bigint")
    # Taken apart as a number: much cheaper per row than a pattern on padded text.
    day, month, year = (
        F.try_divide(number - number % scale, F.lit(scale)).cast("int") % size
        for scale, size in ((1_000_000, 1_000_000), (10_000, 100), (1, 10_000))
    )
    zero = F.lit(0)
    date = F.when(
        number.between(1_010_001, 31_129_999) & (year > 0),
        F.try_make_timestamp_ntz(year, month, day, zero, zero, zero).cast("date"),
    )
    if strict:
        failed = F.raise_error(F.concat(F.lit("no date: "), _col(c).cast("string")))
        date = F.when(_col(c).isNotNull() & date.isNull(), failed.cast("date")).otherwise(date)
    return date


def period_id(date: Column | str) -> Column:
    """``year-month`` with the month not padded: ``2021-1``."""
    return F.concat(F.year(_col(date)).cast("string"), F.lit("-"), F.month(_col(date)).cast("string"))


def month_start(date: Column | str) -> Column:
    return F.trunc(_col(date), "MM")


def reference_id(
    document: Column | str, item: Column | str, unknown: str = UNKNOWN, schema: T.StructType | None = None
) -> Column:
    """``document-item``; a missing, empty or zero document and a missing item become ``Unknown``.

    ``schema`` gives the types of columns that are named, see :func:`integer_text`.
    """
    doc = F.coalesce(integer_text(document, kind_of(document, schema)), F.lit(""))
    doc = F.regexp_replace(doc, "^0?$", unknown)
    return F.concat(doc, F.lit("-"), F.coalesce(integer_text(item, kind_of(item, schema)), F.lit(unknown)))


def kind_of(c: Column | str, schema: T.StructType | None) -> T.DataType | None:
    """The type of a column that is given by name; None where it is not known."""
    return schema[c].dataType if schema is not None and isinstance(c, str) else None


def fill_code(c: Column | str, sentinel: int) -> Column:
    """Missing code to its sentinel, stored ``5.0`` to 5; text that is no number stays NULL."""
    rounded = F.bround(_col(c).try_cast("double"), 0).try_cast("int")
    return F.when(_col(c).isNull(), F.lit(sentinel)).otherwise(rounded)


def fill_codes(df: DataFrame, sentinels: Mapping[str, int]) -> DataFrame:
    return df.withColumns({name: fill_code(name, value) for name, value in sentinels.items()})


def normalize_tariff(c: Column | str, kind: T.DataType | None = None) -> Column:
    """Tariff code as 8-digit text: a stored ``.0`` goes, a lost leading zero comes back."""
    return F.regexp_replace(integer_text(c, kind), "^(.{7})$", "0$1")


def currency_code(c: Column | str, codes: Mapping[int, str], other: str = "other") -> Column:
    """Currency number to currency code."""
    out: Column | None = None
    for number, code in codes.items():
        hit = _col(c) == F.lit(number)
        out = F.when(hit, F.lit(code)) if out is None else out.when(hit, F.lit(code))
    return F.lit(other) if out is None else out.otherwise(F.lit(other))


def drop_undated(df: DataFrame, *date_keys: str) -> DataFrame:
    """Keep rows with a date key."""
    return df.dropna(subset=list(date_keys))


def only_digits(c: Column | str) -> Column:
    return _col(c).cast("string").rlike("^[0-9]+$")


def numeric_aduana(df: DataFrame, code: str) -> DataFrame:
    """Keep rows whose code is written with digits only, so the sentinel -1 goes as well."""
    return df.filter(only_digits(code))
