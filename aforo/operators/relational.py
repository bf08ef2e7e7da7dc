"""Scans with projection, predicate, order and top n; conditional delete; type enforcement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _condition(where: Column | str) -> Column:
    return F.expr(where) if isinstance(where, str) else where


def scan(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
    top: int | None = None,
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Select, filter, order and limit. Order and limit together keep only ``top`` rows per task."""
    if where is not None:
        df = df.filter(_condition(where))
    if order_by:
        df = df.orderBy(*order_by)
    if top is not None:
        df = df.limit(top)
    return df.select(*columns) if columns else df


def run_query(spark: SparkSession, query: str, **args) -> DataFrame:
    """A query with named parameters and frames: ``{name}`` for frames, ``:name`` for values."""
    frames = {k: v for k, v in args.items() if isinstance(v, DataFrame)}
    values = {k: v for k, v in args.items() if k not in frames}
    return spark.sql(query, args=values or None, **frames)


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column a frame lacks is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def row_digest(df: DataFrame, seeds: Sequence[int] = (0, 1)) -> list[Column]:
    """64 bits of hash over all columns per seed, without turning any of them into text."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return [F.xxhash64(F.lit(seed), *columns) for seed in seeds]


def distinct_rows(df: DataFrame, digest: Sequence[Column] | None = None) -> DataFrame:
    """Distinct rows of a wide frame, grouped by a digest of 16 bytes instead of by all columns.

    Within a digest rows are compared as a whole, so two rows that share one both stay. Copies collapse in the map
    tasks already. Columns of type map cannot be compared; doubles are compared by their bits.
    """
    digest = row_digest(df) if digest is None else list(digest)
    keys = [f"__digest_{i}" for i in range(len(digest))]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    grouped = df.select(*[d.alias(k) for d, k in zip(digest, keys)], row.alias("__row")).groupBy(*keys)
    rows = grouped.agg(F.collect_set("__row").alias("__rows"))
    return rows.select(F.explode("__rows").alias("__row")).select("__row.*")


def delete_where(df: DataFrame, where: Column | str) -> DataFrame:
    """What a DELETE leaves: rows for which the predicate is false or NULL."""
    return df.filter(~F.coalesce(_condition(where), F.lit(False)))


def display_list(
    df: DataFrame,
    key: str,
    label: str,
    where: Column | str | None = None,
    order_by: str | None = "label",
) -> DataFrame:
    """Distinct (key, label) pairs, filtered, in the order of ``key`` or ``label``."""
    if where is not None:
        df = df.filter(_condition(where))
    out = df.select(key, label).distinct()
    if order_by is None:
        return out
    return out.orderBy(key, label) if order_by == "id" else out.orderBy(label, key)


def sample_head(df: DataFrame, order_key: str | Column, n: int = 100) -> DataFrame:
    """The first ``n`` rows by an explicit key."""
    return df.orderBy(order_key).limit(n)


def typed(c: Column, type_name: str) -> Column:
    """Text to the type, NULL on failure; integers may be stored as ``5.0`` and keep all 64 bits."""
    if type_name in ("int", "integer", "bigint", "long"):
        rounded = F.round(c.try_cast("decimal(38,10)"), 0).try_cast(type_name)
        return F.coalesce(c.try_cast(type_name), rounded)
    return c.try_cast(type_name)


def enforce_types(
    df: DataFrame, spec: Mapping[str, str], not_null: Sequence[str] = ()
) -> DataFrame:
    """Cast the landed text columns; a NULL in a ``not_null`` column fails the job."""
    out = {c: typed(F.col(c), t) for c, t in spec.items()}
    for c in not_null:
        value = out.get(c, F.col(c))
        out[c] = F.when(value.isNull(), F.raise_error(F.lit(f"{c} is NULL"))).otherwise(value)
    return df.withColumns(out)


def type_rejects(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """One row: per column, values that are present and do not fit the type."""
    return df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & typed(F.col(c), t).isNull()).alias(f"{c}_rejects")
            for c, t in spec.items()
        ]
    )
