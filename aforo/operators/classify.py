"""Product classes by tariff prefix or name keyword."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aforo.functions.text import contains_any, match_column, starts_with_any
from aforo.operators.relational import distinct_rows


@dataclass(frozen=True)
class ProductClass:
    name: str
    prefixes: tuple[str, ...]
    words: tuple[str, ...]

    def matches(self, code: Column, product: Column, stored_upper: bool = False) -> Column:
        """True on a match; a NULL code or name is no match, on its own side only."""
        return starts_with_any(code, self.prefixes) | contains_any(product, self.words, stored_upper)


def in_any_class(classes: Sequence[ProductClass], code: Column, product: Column, stored_upper: bool = False) -> Column:
    """The condition for a filter: on bare columns the scan can test its prefixes."""
    return reduce(lambda a, b: a | b, [c.matches(code, product, stored_upper) for c in classes])


def product_types(
    classes: Sequence[ProductClass], code: Column, product: Column, stored_upper: bool = False
) -> Column:
    """Array with the names of all classes a row belongs to."""
    hits = [F.when(c.matches(code, product, stored_upper), F.lit(c.name)) for c in classes]
    return F.array_compact(F.array(*hits))


def classify(
    df: DataFrame,
    classes: Sequence[ProductClass],
    code: Column | str,
    product: str,
    tag: str,
    leave_out: Sequence[str] = (),
) -> DataFrame:
    """Rows of any class, identical rows once, one output row per class in ``tag``.

    The same rows as a UNION of one branch per class and rule, from a single scan. Rows without
    a class go before the distinct, so only classified rows are shuffled; a row of two classes
    is shuffled once. The distinct combines within each map task first, so many copies of one row do
    not meet in one reducer. ``leave_out`` are columns that the rules use and the result does not hold.
    """
    key = F.col(code) if isinstance(code, str) else code
    column, stored = match_column(df, product)
    name = F.col(column)
    kept = df.filter(in_any_class(classes, key, name, stored))
    tagged = kept.withColumn(tag, product_types(classes, key, name, stored)).drop(*leave_out)
    return distinct_rows(tagged).withColumn(tag, F.explode(tag))
