"""Joins of a large fact side with a lookup side whose size is checked first."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aforo.session import staged

MAX_LOOKUP_ROWS = 200_000
MAX_LOOKUP_BYTES = 64 << 20

On = Sequence[tuple[Column | str, str]]


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_LOOKUP_ROWS, max_bytes: int = MAX_LOOKUP_BYTES
) -> bool:
    """True when the whole frame is within both bounds.

    Counts first, which reads no column that no filter needs, and measures the columns of varying
    width only where the count is within the bound. Each step adds up in the map tasks and brings
    back one number.
    """
    if df.count() > max_rows:
        return False
    varying = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
        for f in df.schema.fields
        if not isinstance(f.dataType, (T.NumericType, T.DateType, T.TimestampType, T.BooleanType))
    ]
    if not varying:
        return True
    size = df.agg(F.sum(reduce(lambda a, b: a + b, varying).cast("long")).alias("size")).first()
    return (size["size"] or 0) <= max_bytes


def row_salt(df: DataFrame, salts: int) -> Column:
    """A bucket per row from the row's own values, so a retried task gives the same bucket."""
    hashable = [
        F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)
    ]
    return F.pmod(F.xxhash64(*hashable), F.lit(salts)).cast("int")


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    on: On,
    how: str = "left",
    small: bool | None = None,
    salts: int | None = None,
) -> DataFrame:
    """Equi join of ``fact`` with ``lookup``: left, inner, left_semi or left_anti.

    ``on`` pairs a fact column (name or expression) with a lookup column; the lookup's key columns do
    not appear in the result. ``small`` states a bound that is known already; None checks it here.
    For a lookup that is itself an aggregate, check its input instead: that reads a few rows only.

    A lookup within the bound is broadcast, so the fact side is not shuffled. A larger one is joined
    by shuffle, where adaptive execution splits the partition of a hot key. ``salts`` spreads keys
    ahead of that: each fact row falls in one of ``salts`` buckets by its own values and the lookup
    is repeated once per bucket, so it suits lookups that are large but not huge. The result is
    the same in all three ways.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = {right: f"__key_{i}" for i, (_, right) in enumerate(on)}
    kept = [c for c in lookup.columns if c not in keys]
    if how in ("left_semi", "left_anti"):
        kept = []
    side = lookup.select(
        *[F.col(f"`{name}`").alias(alias) for name, alias in keys.items()],
        *[F.col(f"`{c}`") for c in kept],
    )
    if small is None:
        small = fits_broadcast(side)
    conditions = [
        (F.col(left) if isinstance(left, str) else left) == F.col(keys[right]) for left, right in on
    ]
    if small:
        side = F.broadcast(side)
    elif salts:
        fact = fact.withColumn("__salt", row_salt(fact, salts))
        side = side.withColumn("__slot", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        conditions.append(F.col("__salt") == F.col("__slot"))
    out = fact.join(side, reduce(lambda a, b: a & b, conditions), how)
    return out.drop("__salt", "__slot", *keys.values())


def reduced_join(fact: DataFrame, reduced: DataFrame, on: On, small: bool) -> DataFrame:
    """Left join with a lookup that was aggregated by the join key.

    Adaptive execution splits a hot key only where the join itself asked for both shuffles. That of an
    aggregate lies below it, so a lookup too large to broadcast is staged and read back first.
    """
    return lookup_join(fact, reduced if small else staged(reduced, "lookup"), on, "left", small)
