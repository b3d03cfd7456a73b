"""Exact, reproducible stratified split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PREFIX = 4  # hexadecimal digits: a histogram has at most 65536 rows per label


def _hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def cut_points(df: DataFrame, label: str, key: str, test_fraction: float, seed: int, classes: tuple[int, ...]) -> dict:
    """Per label the hash and key of its last ``eval`` row; labels without such a row are left out.

    A label may hold almost all rows, so its rows are not ranked as a whole: a
    histogram over hash prefixes tells the prefix in which the cut lies, and only
    the rows of that prefix are ranked. At most one row per class is collected.
    """
    hashed = df.filter(F.col(label).isin(*classes)).select(
        F.col(label).alias("label"), F.col(key).cast("string").alias("key"), _hash(key, seed).alias("hash"))
    hashed = hashed.withColumn("prefix", F.substring("hash", 1, _PREFIX))
    whole = Window.partitionBy("label")
    so_far = F.sum("n").over(whole.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
    histogram = hashed.groupBy("label", "prefix").agg(F.count(F.lit(1)).alias("n")).select(
        "label", "prefix", so_far.alias("so_far"), (so_far - F.col("n")).alias("before"),
        F.round(F.lit(test_fraction) * F.sum("n").over(whole)).cast("long").alias("wanted"))
    found = histogram.filter("before < wanted AND so_far >= wanted").collect()
    if not found:
        return {}
    here = [(F.col("label") == r.label) & (F.col("prefix") == r.prefix) for r in found]
    take = F.coalesce(*[F.when(F.col("label") == r.label, F.lit(r.wanted - r.before)) for r in found])
    rank = F.row_number().over(whole.orderBy("hash", "key"))
    last = hashed.filter(reduce(Column.__or__, here)).withColumn("rank", rank).filter(F.col("rank") == take)
    return {r.label: (r.hash, r.key) for r in last.collect()}


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    test_fraction: float = 0.2,
    seed: int = 42,
    classes: tuple[int, ...] = (0, 1),
) -> DataFrame:
    """Adds ``split``: per label, the first ``round(test_fraction * n)`` rows by
    hashed key are ``eval``, the others ``train``.

    The cuts are looked up first, in two scans of label and key; the result
    compares each row with the cut of its label and needs no shuffle or join.
    Rows of equal key lie on the same side; a null key counts as an empty one.
    ``df`` must give the same rows each time it is read.
    """
    mine = F.struct(_hash(key, seed), F.coalesce(F.col(key).cast("string"), F.lit("")))
    cuts = cut_points(df, label, key, test_fraction, seed, classes)
    known = F.coalesce(F.col(label).isin(*classes), F.lit(False))
    side = F.when(~known, F.raise_error(F.lit("label outside the known classes")).cast("string"))
    for value, (hashed, name) in cuts.items():
        cut = F.struct(F.lit(hashed), F.lit(name or ""))
        side = side.when((F.col(label) == value) & (mine <= cut), "eval")
    return df.withColumn("split", side.otherwise("train"))
