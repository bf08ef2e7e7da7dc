"""Text columns: descriptions, trimming, keyword predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _joined(columns: Sequence[Column | str], separator: str) -> Column:
    # concat_ws would drop the separator next to a NULL.
    parts: list[Column] = []
    for c in columns:
        parts += [F.lit(separator), F.coalesce(_col(c).cast("string"), F.lit(""))]
    return F.concat(*parts[1:])


def full_description(*columns: Column | str) -> Column:
    """The columns with single spaces between; NULL reads as empty text."""
    return _joined(columns, " ")


def unit_label(currency: Column | str, unit: Column | str) -> Column:
    """``currency / unit``."""
    return _joined([currency, unit], " / ")


def rstrip_ws(c: Column | str) -> Column:
    """Right trim that also removes tabs and line ends."""
    return F.regexp_replace(_col(c), r"\s+$", "")


def strip_line_ends(c: Column | str) -> Column:
    """Every CR and LF removed, then trimmed on both sides."""
    return F.trim(F.translate(_col(c), "\r\n", ""))


def contains_any(c: Column | str, words: Sequence[str], stored_upper: bool = False) -> Column:
    """Case-blind: any of the upper-case ``words`` occurs. NULL text gives NULL.

    ``stored_upper`` says that the column is upper-case already: the bare column can then be tested by the scan.
    """
    upper = _col(c) if stored_upper else F.upper(_col(c))
    return reduce(lambda a, b: a | b, [upper.contains(w) for w in words])


def contains_none(c: Column | str, words: Sequence[str], stored_upper: bool = False) -> Column:
    """Case-blind: none of the words occurs. NULL text gives NULL, so a filter drops the row."""
    return reduce(lambda a, b: a & b, [~contains_any(c, [w], stored_upper) for w in words])


def starts_with_any(c: Column | str, prefixes: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [_col(c).startswith(p) for p in prefixes])


def oil_flag(c: Column | str, word: str, yes: str, no: str, stored_upper: bool = False) -> Column:
    """``yes`` where the word occurs, else ``no`` (also for NULL text)."""
    return F.when(contains_any(c, [word], stored_upper), F.lit(yes)).otherwise(F.lit(no))


def is_seed(
    description: Column | str, quantity: Column | str, patterns: Sequence[str], below: int
) -> Column:
    """1 where the description shows one of the spellings or the quantity is small, else 0."""
    hit = contains_any(description, patterns) | (_col(quantity) < F.lit(below))
    return F.when(hit, F.lit(1)).otherwise(F.lit(0))


UPPER = "_UP"


def upper_columns(columns: Sequence[str]) -> dict[str, Column]:
    """The columns in upper case, named for :func:`match_column`, to be stored with a table."""
    return {f"{c}{UPPER}": F.upper(_col(c)) for c in columns}


def match_column(df: DataFrame, name: str) -> tuple[str, bool]:
    """The column that case-blind rules look at: the stored upper-case one where the table has it."""
    return (f"{name}{UPPER}", True) if f"{name}{UPPER}" in df.columns else (name, False)


def exclude_keywords(df: DataFrame, words: Mapping[str, Sequence[str]]) -> DataFrame:
    """Keep rows where no column shows one of its words; a NULL column drops its row."""
    for name, listed in words.items():
        column, stored = match_column(df, name)
        df = df.filter(contains_none(column, listed, stored))
    return df


def exclude_codes(df: DataFrame, code: str | Column, codes: Sequence[str]) -> DataFrame:
    """Keep rows whose code is not listed; a NULL code drops its row."""
    return df.filter(~_col(code).isin(list(codes)))


def all_to_string(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
