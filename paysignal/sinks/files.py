"""File exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysignal.functions.columns import PERIODS, in_periods, in_time_range, is_timestamp


def write_partitioned(df: DataFrame, path: str, by: list[str], file_format: str = "parquet",
                      mode: str = "overwrite") -> None:
    """Write partitioned by ``by``. The rebalance hint gathers each partition value
    into few files and lets adaptive execution split a value that is too big for one task."""
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).format(file_format).save(path)


def write_consolidated(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    write_partitioned(df, path, ["event_date"], "parquet", mode)


def time_of(df: DataFrame, time_column: str) -> Column:
    """The time of a row; text that is no time becomes null."""
    if is_timestamp(df, time_column):
        return F.col(time_column)
    return F.try_to_timestamp(F.regexp_replace(F.col(time_column).cast("string"), " UTC$", ""))


def _cut(buckets: DataFrame, wanted: int) -> tuple[int | None, int] | None:
    """The bucket in which row number ``wanted`` lies, and the rows before it; None if there are fewer rows. ``buckets``
    has a row per bucket, null first."""
    so_far = F.sum("n").over(Window.orderBy(F.asc_nulls_first("bucket")).rowsBetween(Window.unboundedPreceding, 0))
    found = buckets.withColumn("upto", so_far).filter(F.col("upto") >= wanted).orderBy("upto").first()
    return (found["bucket"], found["upto"] - found["n"]) if found else None


def first_rows(df: DataFrame, moment: Column, ties: list[str], n: int) -> DataFrame:
    """The first ``n`` rows by time and ``ties``, rows without a time before all others.

    Counts per hour and then per second of one hour find the second that holds the last of them. Earlier rows are
    taken as they are, by as many tasks as read them; only the rows of that second are ranked.
    """
    counted = F.count(F.lit(1)).alias("n")
    hour, second = (F.unix_seconds(F.date_trunc(unit, moment).cast("timestamp")) for unit in ("hour", "second"))
    cut = _cut(df.groupBy(hour.alias("bucket")).agg(counted), n)
    if cut is None:
        return df
    at, before = cut
    if at is None:  # rows without a time are enough
        return df.filter(moment.isNull()).orderBy(*ties).limit(n)
    last, own = _cut(df.filter(hour == F.lit(at)).groupBy(second.alias("bucket")).agg(counted), n - before)
    earlier = df.filter(moment.isNull() | (second < F.lit(last)))
    ranked = df.filter(second == F.lit(last)).orderBy(moment, *ties).limit(n - before - own)
    return earlier.unionByName(ranked)


def select_export(df: DataFrame, time_column: str = "event_time", start: str | None = None,
                  end: str | None = None, limit: int = 0) -> DataFrame:
    """Whole rows of an optional half-open time range, the first ``limit`` of them if given.
    A row whose time does not parse lies in no range. Of a table laid out by day or hour only the partitions of the range
    are read; the partition column is no part of the export."""
    picked = df
    if start or end:
        picked = df.filter(in_time_range(time_of(df, time_column), start, end) & in_periods(df, start, end))
    picked = picked.drop(*(n for n, _ in PERIODS.values() if n != time_column))
    if limit > 0:
        ties = [c for c in ("payment_id",) if c in df.columns and c != time_column]
        picked = first_rows(picked, time_of(df, time_column), ties, limit)
    return picked


def export_by_day(df: DataFrame, path: str, time_column: str = "event_time", file_format: str = "json",
                  mode: str = "overwrite") -> None:
    """Write under ``year=/month=/day=``; rows whose time does not parse are left out."""
    if file_format not in ("json", "parquet"):
        raise ValueError(f"unsupported export format: {file_format}")
    moment = time_of(df, time_column)
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    dated = df.withColumns({n: F.date_format(moment, p) for n, p in parts.items()}).dropna(subset=list(parts))
    write_partitioned(dated, path, list(parts), file_format, mode)


def write_result(df: DataFrame, root: str, name: str, file_format: str = "parquet", mode: str = "overwrite") -> str:
    """Write one named result set as Parquet or CSV with header; returns its path."""
    if file_format not in ("parquet", "csv"):
        raise ValueError(f"unsupported result format: {file_format}")
    out = f"{root.rstrip('/')}/{name}"
    writer = df.write.mode(mode)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(out)
    return out
