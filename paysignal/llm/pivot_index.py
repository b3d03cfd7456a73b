"""Near-duplicate embeddings through a pivot-permutation index.

A vector is described by the ordered list of its nearest pivots, which are a
hash-drawn sample of the vectors (``pivots_for`` of their number, bounded by
``MOST_PIVOTS``). Inverted lists take every vector to the vectors that share a
pivot with it; a pair is retrieved if it shares at least ``shared`` of its listed
pivots, and linked if its cosine, in double precision, reaches the threshold. The
pair is dealt with only in the list of the least pivot it shares, so links are
counted once without bringing pairs together; what leaves a task is a link count
per vector and a spanning set of links. Long lists are cut into blocks that meet
pairwise in tasks of their own. The work grows as the number of vectors to the
power 1.5: both the pivots and the length of a list grow with its square root.

Equal vectors are one entry with a member count. Recall against brute force is
measured in the tests.

Cases: vectors that are null, empty, all zero or hold null or non-finite
components link with nothing; vectors of different lengths are not compared;
repeated rows count as vectors of their own; a null id is never the least; no rows give
no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysignal.llm.grouped import block_tasks, group_limits, segments, spanning, spread_join
from paysignal.llm.rows import components, labelled_sample
from paysignal.session import stage

THRESHOLD = 0.9
LISTED = 12
SHARED = 2
LEAST_PIVOTS, MOST_PIVOTS = 16, 32_768
BLOCK = 1024
_PAIR_SLICE = 1 << 16


def pivots_for(n: int) -> int:
    return min(max(int(4 * math.sqrt(n)), LEAST_PIVOTS), MOST_PIVOTS)


def usable(vector: Column) -> Column:
    """True for vectors that have a direction."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def describe(vectors: DataFrame, listed: int) -> DataFrame:
    """Adds to (node, members, vector, n_dims) the nearest pivots, nearest first, and the unit vector as doubles."""
    spark = vectors.sparkSession
    n = vectors.count()
    chosen = labelled_sample(vectors.select("node", "n_dims"), "n_dims", "node", pivots_for(n))
    drawn = vectors.select("node", "n_dims", "vector").join(F.broadcast(chosen.select("node")), "node").collect()
    by_size: dict[int, list] = {}
    for row in sorted(drawn, key=lambda r: r.node):
        by_size.setdefault(row.n_dims, []).append(row.vector)
    pivots = spark.sparkContext.broadcast({k: _unit(np.array(v, dtype=np.float64)) for k, v in by_size.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            flat = column.flatten().to_numpy(zero_copy_only=False)
            sizes = batch.column("n_dims").to_numpy()
            starts = np.cumsum(sizes) - sizes
            lists: list = [None] * len(sizes)
            units: list = [None] * len(sizes)
            for size in np.unique(sizes):
                near = pivots.value[int(size)]
                keep = min(listed, len(near))
                every = np.flatnonzero(sizes == size)
                for lo in range(0, len(every), 1024):
                    rows = every[lo : lo + 1024]
                    unit = _unit(flat[starts[rows][:, None] + np.arange(size)])
                    far = -(unit @ near.T)
                    top = np.argpartition(far, keep - 1, axis=1)[:, :keep]
                    top = np.take_along_axis(top, np.argsort(np.take_along_axis(far, top, axis=1), axis=1, kind="stable"), axis=1)
                    for i, chosen, values in zip(rows, top.astype(np.int32), unit, strict=True):
                        lists[i] = chosen
                        units[i] = values.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("members"), batch.column("n_dims"), pa.array(units, pa.binary()),
                 pa.array(lists, pa.list_(pa.int32()))], names=["node", "members", "n_dims", "unit", "pivots"])

    return vectors.select("node", "members", "n_dims", "vector").mapInArrow(
        run, "node long, members long, n_dims int, unit binary, pivots array<int>")


def _list_links(threshold: float, shared: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in segments(batches, "task"):
            bounds = group_limits(table, "task")
            nodes, members = table.column("node").to_numpy(), table.column("members").to_numpy()
            side, cross = table.column("side").to_numpy(), table.column("cross").to_numpy(zero_copy_only=False)
            pivot = table.column("pivot").to_numpy()
            units, lists = table.column("unit").combine_chunks(), table.column("pivots").combine_chunks()
            out = []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if hi - lo < 2:
                    continue
                unit = np.frombuffer(b"".join(units.slice(lo, hi - lo).to_pylist()), dtype=np.float64).reshape(hi - lo, -1)
                listed = np.sort(lists.slice(lo, hi - lo).flatten().to_numpy().reshape(hi - lo, -1), axis=1)
                alike = unit @ unit.T >= threshold
                np.fill_diagonal(alike, False)
                if cross[lo]:
                    alike &= side[lo:hi][:, None] != side[lo:hi][None, :]
                i, j = np.nonzero(np.triu(alike))
                for a in range(0, len(i), _PAIR_SLICE):
                    p, q = i[a : a + _PAIR_SLICE], j[a : a + _PAIR_SLICE]
                    common = (listed[p][:, :, None] == listed[q][:, None, :]).any(axis=2)
                    least = np.where(common, listed[p], np.iinfo(np.int32).max).min(axis=1)
                    ours = (common.sum(axis=1) >= min(shared, listed.shape[1])) & (least == pivot[lo])
                    alike[p[~ours], q[~ours]] = alike[q[~ours], p[~ours]] = False
                linked = np.flatnonzero(alike.any(axis=1))
                if len(linked):
                    labels = spanning(alike)
                    out.append((nodes[lo:hi][linked], nodes[lo:hi][labels[linked]], (alike @ members[lo:hi])[linked]))
            if out:
                a, b, n = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n.astype(np.int64))], names=["a", "b", "links"])

    return run


def embedding_groups(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", threshold: float = THRESHOLD,
    listed: int = LISTED, shared: int = SHARED, block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, n_links, component_id (least id it can reach) and kept."""
    vector = F.col(vector_column).cast("array<double>")
    plain = rows.select(F.col(id_column).alias("_id"), vector.alias("vector"))
    plain = plain.withColumn("node", F.when(usable(F.col("vector")), F.xxhash64("vector")))
    # a hash and the vector itself make the class; the hash names it
    classes = stage(plain.filter("node IS NOT NULL").groupBy("node", "vector").agg(
        F.count(F.lit(1)).alias("members"), F.min("_id").alias("least")).withColumn("n_dims", F.size("vector")), "vectors")
    index = stage(describe(classes, listed), "pivot_index")
    lists = index.select("*", F.explode("pivots").alias("pivot"))
    # as many rows as pivots, which are bounded
    sizes = index.select("n_dims", F.explode("pivots").alias("pivot")).groupBy("n_dims", "pivot").agg(F.count(F.lit(1)).alias("n"))
    tasks = block_tasks(lists.join(F.broadcast(sizes), ["n_dims", "pivot"]), ["n_dims", "pivot"], F.col("n"), "node", block)
    tasks = tasks.select("task", "node", "members", "pivot", "side", "cross", "unit", "pivots")
    found = stage(tasks.repartition("task").sortWithinPartitions("task").mapInArrow(
        _list_links(threshold, shared), "a long, b long, links long"), "links")
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    whole = classes.select("node", "members", "least").join(links, "node", "left").join(components(found), "node", "left")
    whole = stage(whole.withColumn("component", F.coalesce("component", "node")), "linked")
    heads = whole.groupBy("component").agg(F.min("least").alias("head"))
    per_class = spread_join(whole, heads, "component").select(
        "node", "head", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"))
    linked = spread_join(plain.filter("node IS NOT NULL").select("_id", "node"), per_class, "node")
    linked = linked.select("_id", "n_links", F.col("head").alias("component_id"))
    alone = plain.filter("node IS NULL").select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("_id").alias(id_column), "n_links", "component_id",
        F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"))
