"""Column helpers for inputs whose schema is not under our control."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pick(df: DataFrame, names: Iterable[str], type_name: str = "string") -> Column:
    """First existing column of ``names``, cast leniently; a typed null if none exists."""
    for name in names:
        if name in df.columns:
            return F.col(name).try_cast(type_name)
    return F.lit(None).cast(type_name)


def is_timestamp(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType))


def not_blank(column: Column) -> Column:
    """True for non-null, non-empty text; never null."""
    return column.isNotNull() & (column != "")


def parse_bound(value: str | None) -> Column | None:
    """ISO-8601 text as a typed timestamp literal, so range filters can be pushed down."""
    if value is None or not value.strip():
        return None
    text = value.strip().replace("Z", "+00:00")
    return F.lit(text).cast("timestamp")


def in_time_range(column: Column, start: str | None, end: str | None) -> Column:
    """Half-open range ``[start, end)``; a missing bound leaves that side open."""
    keep = F.lit(True)
    lower, upper = parse_bound(start), parse_bound(end)
    if lower is not None:
        keep = keep & (column >= lower)
    if upper is not None:
        keep = keep & (column < upper)
    return keep


# Partition columns by which tables may be laid out: name and type per unit of time.
PERIODS = {"day": ("event_date", "date"), "hour": ("event_hour", "timestamp")}


def period(moment: Column, unit: str) -> Column:
    """Begin of the day or hour of a time."""
    return F.date_trunc(unit, moment).cast(PERIODS[unit][1])


def in_periods(df: DataFrame, start: str | None, end: str | None) -> Column:
    """The partitions of ``df`` that may hold rows of the range ``[start, end)``; true for tables laid out otherwise."""
    keep = F.lit(True)
    lower, upper = parse_bound(start), parse_bound(end)
    for unit, (name, kind) in PERIODS.items():
        if name not in df.columns or df.schema[name].dataType.simpleString() != kind:
            continue
        if lower is not None:
            keep = keep & (F.col(name) >= period(lower, unit))
        if upper is not None:
            keep = keep & (F.col(name) <= period(upper, unit))
    return keep


def code_list(text: str | Iterable[str]) -> list[str]:
    """``"ru, ng"`` (or an iterable) as clean upper-case codes."""
    parts = text.split(",") if isinstance(text, str) else text
    return [p.strip().upper() for p in parts if p.strip()]
