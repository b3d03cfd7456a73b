"""Joins of many rows to a lookup table that is unique on its key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach(rows: DataFrame, lookup: DataFrame, keys: list[str], nulls_match: bool = False) -> DataFrame:
    """Inner join that keeps one copy of ``keys``."""
    if not nulls_match:
        return rows.join(lookup, keys)
    renamed = lookup.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & rows[k].eqNullSafe(renamed[f"_k_{k}"])
    return rows.join(renamed, condition).drop(*[f"_k_{k}" for k in keys])


def _own_key(column: Column, nulls_match: bool) -> Column:
    key = F.concat(F.lit("="), column.cast("string"))
    return F.coalesce(key, F.lit("")) if nulls_match else key


def attach_to_hubs(rows: DataFrame, lookup: DataFrame, key: str, nulls_match: bool = False) -> DataFrame:
    """As ``attach`` on one text key, where a single key may hold a large share of ``rows``.

    Adaptive execution splits a skewed partition only if both join inputs come
    straight from a shuffle of their own. A lookup that was just grouped by the
    key would be joined in the grouping's partitions instead, hub and all, so
    the join uses a derived key that forces the separate shuffle of the lookup.
    """
    own = lookup.withColumnRenamed(key, "_k").withColumn("_k", _own_key(F.col("_k"), nulls_match))
    return rows.join(own, _own_key(rows[key], nulls_match) == own["_k"]).drop("_k")


def keep_known(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` occurs in ``known``; hub keys as in ``attach_to_hubs``."""
    own = known.select(_own_key(F.col(key), False).alias("_k"))
    return rows.join(own, _own_key(rows[key], False) == own["_k"], "left_semi")
