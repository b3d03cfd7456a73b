"""Keep the latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per ``key``: the greatest by ``order``, ties broken by all other columns.

    Filtering ``row_number() = 1`` lets Spark cut each key to one row per map task
    before the shuffle, so a key with very many copies never meets in one task.
    """
    rest = sorted(c for c in df.columns if c not in (key, *order))
    ranking = [F.col(c).desc_nulls_last() for c in (*order, *rest)]
    newest_first = Window.partitionBy(key).orderBy(*ranking)
    return df.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")
