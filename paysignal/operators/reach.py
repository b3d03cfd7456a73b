"""Members per key and distinct counts over two-step paths, safe for hub nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysignal.operators.joins import attach_to_hubs
from paysignal.session import stage

# Leaves share a row in groups of 64, one bit of a long each.
_BLOCK_BITS = 6


def members(pairs: DataFrame, key: str, member: str, total: str, min_total: int = 1) -> DataFrame:
    """(key, total, member): one row per member of keys with ``min_total`` or more.

    ``pairs`` holds distinct (key, member) rows. The result has this shape at
    any number of members; no list is collected.
    """
    totals = pairs.groupBy(key).agg(F.count(F.lit(1)).alias(total)).filter(F.col(total) >= min_total)
    return attach_to_hubs(pairs.select(key, member), totals, key).select(key, total, member)


def reach_count(links: DataFrame, leaves: DataFrame, group: str, via: str, leaf: str, total: str) -> DataFrame:
    """Distinct ``leaf`` values per ``group`` over (group, via) x (via, leaf), both distinct.

    * A leaf with a single ``via`` reaches a group in one way only: such leaves
      are counted per ``via``, and a group adds the counts up.
    * The others are numbered so that leaves of one ``via`` mostly follow each
      other. Per ``via``, each block of 64 numbers becomes one row with a bit
      mask; a group takes the bitwise or of the masks of a block and counts the
      bits. A path is so a part of a row, and masks combine before the shuffle.

    Numbers are written down, so that a task that runs again sees the same ones.
    """
    degree = leaves.groupBy(leaf).agg(F.count(F.lit(1)).alias("_vias"), F.min(via).alias("_first"))
    numbered = stage(
        degree.repartitionByRange("_first", leaf)
        .sortWithinPartitions("_first", leaf)
        .select(leaf, "_vias", "_first", F.monotonically_increasing_id().alias("_n")),
        "reach_numbers",
    )
    alone = (
        numbered.filter("_vias = 1")
        .groupBy(F.col("_first").alias(via))
        .agg(F.count(F.lit(1)).alias("_alone"))
        .select(via, F.lit(None).cast("long").alias("_block"), F.lit(None).cast("long").alias("_mask"), "_alone")
    )
    position = F.col("_n").bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1)).cast("int")
    masks = (
        leaves.join(numbered.filter("_vias > 1").select(leaf, "_n"), leaf)
        .groupBy(via, F.shiftright("_n", _BLOCK_BITS).alias("_block"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), position)).alias("_mask"))
        .select(via, "_block", "_mask", F.lit(0).cast("long").alias("_alone"))
    )
    # both sides of this join may hold a hub, so both get a shuffle of their own
    reached = attach_to_hubs(links.select(group, via), alone.unionByName(masks), via)
    return (
        reached.groupBy(group, "_block")
        .agg(F.bit_or("_mask").alias("_mask"), F.sum("_alone").alias("_alone"))
        .groupBy(group)
        .agg(F.sum(F.col("_alone") + F.coalesce(F.bit_count("_mask"), F.lit(0))).alias(total))
    )
