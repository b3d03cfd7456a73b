"""Work on sorted groups of rows inside Arrow tasks, and block tasks over large groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_join(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Join on a number column in which both sides get a shuffle of their own, so that adaptive execution can split a
    hot key (a lookup that was just grouped by the key would be joined in the partitions of the grouping)."""
    own = lookup.withColumn("_own", F.col(key) + 1).drop(key)
    return rows.join(own, rows[key] + 1 == own["_own"]).drop("_own")


def segments(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole groups of rows that come sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(keys, keys[-1]))
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if last > 0:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def group_limits(table: pa.Table, key: str) -> np.ndarray:
    """Row limits of the groups."""
    keys = table.column(key).to_numpy()
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def spanning(adjacent: np.ndarray) -> np.ndarray:
    """Least index of the component of every index of a symmetric matrix."""
    labels = np.arange(len(adjacent))
    while True:
        least = np.minimum(labels, np.where(adjacent, labels[None, :], len(labels)).min(axis=1, initial=len(labels)))
        least = least[least]
        if (least == labels).all():
            return labels
        labels = least


def block_tasks(rows: DataFrame, group: list[str], size: Column, node: str, block: int) -> DataFrame:
    """Rows of each group dealt to tasks that each hold two blocks (or one) of about ``block`` rows, every pair of
    blocks once: columns task, side (a row's block) and cross (the task compares two different blocks)."""
    parted = rows.withColumn("_blocks", F.ceil(size / block).cast("int"))
    parted = parted.withColumn("side", F.pmod(F.xxhash64(node, F.lit(5)), F.col("_blocks")).cast("int"))
    parted = parted.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return parted.withColumn("task", F.xxhash64(*group, F.least("side", "_other"), F.greatest("side", "_other"))).withColumn(
        "cross", F.col("side") != F.col("_other")).drop("_blocks", "_other")
