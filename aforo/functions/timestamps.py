"""Timestamps: parsing text, time zones, text form on write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def parse_ts(c: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, else ``yyyy-MM-dd``, else NULL; a wall clock without zone."""
    col = F.col(c) if isinstance(c, str) else c
    parsed = F.coalesce(
        F.try_to_timestamp(col, F.lit(DATETIME_FORMAT)),
        F.try_to_timestamp(col, F.lit(DATE_FORMAT)),
    )
    return parsed.cast("timestamp_ntz")


def convert_tz(
    df: DataFrame, columns: Sequence[str], from_tz: str, to_tz: str, fmt: str | None = None
) -> DataFrame:
    """Express the columns in ``to_tz``, as wall clock or, with ``fmt``, as text.

    Text and timestamps without zone are wall clocks in ``from_tz``; text goes through
    :func:`parse_ts`, so text that is no date becomes NULL. A timestamp with zone is a moment
    already and ``from_tz`` does not apply to it.
    """
    out = {}
    for name in columns:
        kind = df.schema[name].dataType
        naive = parse_ts(name) if isinstance(kind, T.StringType) else F.col(name).cast("timestamp_ntz")
        # The cast shows a moment in the session's zone.
        zone = F.current_timezone() if isinstance(kind, T.TimestampType) else F.lit(from_tz)
        moved = F.convert_timezone(zone, F.lit(to_tz), naive)
        out[name] = F.date_format(moved, fmt) if fmt else moved
    return df.withColumns(out)


def timestamps_to_text(df: DataFrame, fmt: str = DATETIME_FORMAT) -> DataFrame:
    """Every timestamp column as text, as tables with text landing columns expect."""
    names = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    ]
    return df.withColumns({n: F.date_format(n, fmt) for n in names}) if names else df
