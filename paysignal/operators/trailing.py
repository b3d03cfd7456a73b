"""Trailing event-time features per key, exact and linear in the input.

A feature at time ``t`` looks at the rows of its key in the whole-second range
``[t - seconds, t]``, peers included, so it depends on (key, second) only. That
allows the work to be cut into groups whose size does not grow with the data:

* time is divided into buckets and each row is also placed, as context, in the
  following buckets its trailing range reaches;
* rows are pre-aggregated to one row per (key, bucket, second), so no window
  group holds more than the seconds of one bucket plus the longest range;
* counts and sums are differences of two running totals;
* distinct counts are running totals as well: each value is present in runs of
  occurrences at most ``seconds`` apart, so the number present at ``t`` is the
  number of runs opened up to ``t`` minus the runs closed before ``t - seconds``.

A busy key is therefore spread over its buckets, seconds and values in every
shuffle, and no frame is ever rescanned per row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Trailing:
    name: str
    kind: str  # "count" (non-null values), "distinct" (non-null values) or "mean"
    column: str
    seconds: int

    def __post_init__(self) -> None:
        if self.kind not in ("count", "distinct", "mean"):
            raise ValueError(f"unknown kind of trailing feature: {self.kind}")


def _summand(rows: DataFrame, name: str) -> Column:
    """The values of a mean: exact sums for whole numbers, flags and decimals, doubles otherwise.
    NaN counts as null, since it would spoil the running totals."""
    kind = rows.schema[name].dataType
    if isinstance(kind, T.DecimalType):
        return F.col(name)
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return F.col(name).cast("long")
    value = F.col(name).try_cast("double")
    return F.when(~F.isnan(value), value)


def _buckets(second: Column, reach: Column, size: int) -> Column:
    """The bucket of ``second`` and every later one whose rows can still look back at it."""
    first = F.floor(second / size)
    last = F.floor((second + reach) / size)
    return F.explode(F.sequence(first, last))


def _distinct_runs(rows: DataFrame, key: str, second: str, specs: dict[int, Trailing], size: int) -> DataFrame:
    """Per value, the seconds where a run of nearby occurrences opens or closes."""
    tags = F.array(
        *[
            F.struct(
                F.lit(i).alias("spec"),
                F.lit(s.seconds).cast("long").alias("reach"),
                F.col(s.column).cast("string").alias("value"),
            )
            for i, s in specs.items()
        ]
    )
    values = (
        rows.select(key, second, F.inline(tags))
        .filter(F.col("value").isNotNull())
        .withColumn("bucket", _buckets(F.col(second), F.col("reach"), size))
        .groupBy(key, "bucket", "spec", "reach", "value")
        .agg(F.sort_array(F.collect_set(second)).alias("seconds"))
    )
    reach = F.col("reach")

    def mark(sec: Column, index: Column) -> Column:
        since_last = sec - F.get("seconds", index - 1)
        until_next = F.get("seconds", index + 1) - sec
        return F.struct(
            sec.alias(second),
            F.coalesce(since_last > reach, F.lit(True)).cast("long").alias("opens"),
            F.coalesce(until_next > reach, F.lit(True)).cast("long").alias("closes"),
        )

    marks = F.filter(F.transform("seconds", mark), lambda m: (m["opens"] + m["closes"]) > 0)
    return values.select(key, "bucket", "spec", F.inline(marks))


def trailing_features(
    rows: DataFrame,
    key: str,
    second: str,
    specs: list[Trailing],
    bucket_seconds: int | None = None,
) -> DataFrame:
    """One row per (key, second) with one column per spec.

    ``second`` is a long column of epoch seconds. Counts come out as integers,
    means as doubles (null without a value in range). A bucket holds
    ``bucket_seconds``, by default six times the longest range.
    """
    indexed = dict(enumerate(specs))
    distinct = {i: s for i, s in indexed.items() if s.kind == "distinct"}
    summed = {i: s for i, s in indexed.items() if s.kind != "distinct"}
    longest = max(s.seconds for s in specs)
    bucket_seconds = bucket_seconds or 6 * longest
    zero = F.lit(0).cast("long")

    value = {i: _summand(rows, s.column) if s.kind == "mean" else F.col(s.column) for i, s in summed.items()}
    present = {i: v.isNotNull().cast("long") for i, v in value.items()}
    measures: dict[str, Column] = {f"n{i}": p for i, p in present.items()}
    for i, s in summed.items():
        if s.kind == "mean":
            measures[f"v{i}"] = F.coalesce(value[i], zero)
    run_columns = [f"{side}{i}" for i in distinct for side in ("o", "c")]

    parts = rows.select(
        key,
        _buckets(F.col(second), F.lit(longest), bucket_seconds).alias("bucket"),
        F.col(second),
        *[c.alias(n) for n, c in measures.items()],
        *[zero.alias(n) for n in run_columns],
    )
    if distinct:
        runs = _distinct_runs(rows, key, second, distinct, bucket_seconds)
        flags = [
            F.when(F.col("spec") == i, F.col(source)).otherwise(zero).alias(f"{side}{i}")
            for i in distinct
            for side, source in (("o", "opens"), ("c", "closes"))
        ]
        parts = parts.unionByName(
            runs.select(key, "bucket", second, *[zero.alias(n) for n in measures], *flags)
        )
    totals = [*measures, *run_columns]
    per_second = parts.groupBy(key, "bucket", second).agg(*[F.sum(n).alias(n) for n in totals])

    ordered = Window.partitionBy(key, "bucket").orderBy(second)

    def up_to_now(name: str) -> Column:
        return F.sum(name).over(ordered.rangeBetween(Window.unboundedPreceding, 0))

    def before_range(name: str, seconds: int) -> Column:
        frame = ordered.rangeBetween(Window.unboundedPreceding, -(seconds + 1))
        return F.coalesce(F.sum(name).over(frame), zero)

    def in_range(name: str, seconds: int) -> Column:
        return up_to_now(name) - before_range(name, seconds)

    def feature(i: int, s: Trailing) -> Column:
        if s.kind == "distinct":
            return (up_to_now(f"o{i}") - before_range(f"c{i}", s.seconds)).cast("int")
        if s.kind == "count":
            return in_range(f"n{i}", s.seconds).cast("int")
        return F.try_divide(in_range(f"v{i}", s.seconds), in_range(f"n{i}", s.seconds)).cast("double")

    in_own_bucket = F.floor(F.col(second) / bucket_seconds) == F.col("bucket")
    return (
        per_second.select(key, "bucket", second, *[feature(i, s).alias(s.name) for i, s in indexed.items()])
        .filter(in_own_bucket)
        .drop("bucket")
    )
