"""Jaccard self-join on word shingles by chosen paths, and the groups that its links form.

1. Every text becomes its set of word shingles. Equal sets are one class with a
   member count, so copies are never paired. Of each class ``TOKENS`` min-hash tokens
   are drawn, which two classes share as often as their Jaccard similarity says.
2. In every run the classes are split recursively. A bucket is a path of tokens chosen
   so far; a hash of the path draws which token names the child that a class goes to, and
   for one path in ``SECOND_CHANCE`` a second token and child, so that a pair at the
   threshold shares one child on average. Buckets with few classes stop: their classes
   are compared by token agreement. Only buckets that are still large are split further, as
   deep as the number of classes asks for (``levels_for``). Runs are repeated until a pair at
   the threshold is met with the target recall at that depth (``runs_for``), even if it
   shares ``SPREAD`` standard deviations fewer tokens than its similarity promises.
3. What a bucket finds similar becomes links of a candidate graph (at most one
   per class and bucket, never all pairs). Classes of one candidate component are
   then compared exactly, in blocks, on their whole shingle sets.

The result has a row per document: its number of links (other documents with
Jaccard >= threshold, copies included) and the least document id of its group.

Cases: texts with fewer words than a shingle are one shingle of all their words;
null or wordless texts link with nothing; of repeated rows each counts as a
document; null ids come last in the choice of the kept document; no rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.llm.grouped import block_tasks, group_limits, segments, spanning, spread_join
from paysignal.llm.rows import KEYS, components, row_keys
from paysignal.llm.task_memory import tidy
from paysignal.llm.words import HOLDER, find_words, hash_windows, hash_words, row_slices, text_buffers, window_rows
from paysignal.session import stage

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
TOKENS = 128
SPREAD = 2.0
FAR = 0.2  # unrelated texts share at most this part of their shingles: each split leaves about a quarter of their meetings
SMALL_BUCKET = 128
BLOCK = 512
SECOND_CHANCE = 4  # one bucket in four opens a second child
_AGREEMENT_MARGIN = 0.2


def meeting_chance(similarity: float, levels: int) -> float:
    """Chance that a pair shares a bucket after ``levels`` splits in one run."""
    chance = 1.0
    for _ in range(levels):
        one = similarity * chance
        chance = (1 - 1 / SECOND_CHANCE) * one + (1 - (1 - one) ** 2) / SECOND_CHANCE
    return chance


def levels_for(n_classes: int, small: int = SMALL_BUCKET) -> int:
    """Splits after which unrelated classes no longer fill buckets of more than ``small``."""
    return 1 + max(math.ceil(math.log(max(n_classes, 1) / small) / -math.log(FAR * (1 + 1 / SECOND_CHANCE))), 1)


def runs_for(recall: float = RECALL, threshold: float = THRESHOLD, levels: int = 2) -> int:
    least = max(threshold - SPREAD * math.sqrt(threshold * (1 - threshold) / TOKENS), 0.1)
    return math.ceil(math.log(1 - recall) / math.log(1 - meeting_chance(least, levels)))


def _sets(data: np.ndarray, limits: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all rows, row by row, and their limits."""
    starts, ends, first = find_words(data, limits)
    words = hash_words(data, starts, ends)
    at, rows = window_rows(first, size)
    hashes = hash_windows(words, size)[at] if len(at) else np.empty(0, dtype=np.uint64)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        own = np.array([hash_windows(words[first[i] : first[i + 1]], counts[i])[0] for i in short], dtype=np.uint64)
        order = np.argsort(np.concatenate((rows, short)), kind="stable")
        rows = np.concatenate((rows, short))[order]
        hashes = np.concatenate((hashes, own))[order]
    return hashes, np.searchsorted(rows, np.arange(len(limits)))


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(20).integers(0, 1 << 32, size=(2, n), dtype=np.uint64).astype(np.uint32)
    return drawn[0] | np.uint32(1), drawn[1]


def signatures(docs: DataFrame, id_column: str, text_column: str, size: int, n_tokens: int) -> DataFrame:
    """Per document: keys, class hashes (null without words), set size and min-hash tokens."""
    schema = T.StructType([
        T.StructField("_id", docs.schema[id_column].dataType), T.StructField("_k1", T.LongType()),
        T.StructField("_k2", T.LongType()), T.StructField("node", T.LongType()), T.StructField("check", T.LongType()),
        T.StructField("tokens", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = _coefficients(n_tokens)
        for batch in batches:
            data, limits = text_buffers(batch.column(3))
            for lo, hi in row_slices(limits):
                hashes, bounds = _sets(data[limits[lo] : limits[hi]], limits[lo : hi + 1] - limits[lo], size)
                filled = np.flatnonzero(np.diff(bounds) > 0)
                nodes, checks = [None] * (hi - lo), [None] * (hi - lo)
                for i in filled:
                    digest = xxhash.xxh3_128_digest(np.unique(hashes[bounds[i] : bounds[i + 1]]).tobytes())
                    nodes[i], checks[i] = np.frombuffer(digest, dtype="<i8").tolist()
                tokens = np.zeros((hi - lo, n_tokens), dtype=np.int32)
                if len(filled):
                    short = (hashes >> np.uint64(32)).astype(np.uint32)
                    for k in range(n_tokens):
                        tokens[filled, k] = np.minimum.reduceat(short * factors[k] + shifts[k], bounds[filled]).view(np.int32)
                flat = pa.ListArray.from_arrays(
                    pa.array(np.arange(hi - lo + 1, dtype=np.int32) * n_tokens), pa.array(tokens.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     batch.column(2).slice(lo, hi - lo), pa.array(nodes, pa.int64()), pa.array(checks, pa.int64()), flat],
                    names=["_id", "_k1", "_k2", "node", "check", "tokens"])

    keyed = docs.select(F.col(id_column).alias("_id"), *row_keys(id_column, text_column), F.col(text_column))
    return keyed.mapInArrow(tidy(run, HOLDER), schema)


def _children(rows: DataFrame, level: int) -> DataFrame:
    """Children of the path ``bucket`` (it names its run, too) for each class: the path draws the token that names the child."""
    def drawn(salt: int) -> Column:
        return F.pmod(F.xxhash64("bucket", F.lit(level), F.lit(salt)), F.lit(TOKENS)).cast("int")

    def child(place: Column) -> Column:
        return F.xxhash64("bucket", place, F.element_at("tokens", place + 1))

    # the second token is another one than the first
    second = F.pmod(F.col("first") + 1 + F.pmod(drawn(1), F.lit(TOKENS - 1)), F.lit(TOKENS)).cast("int")
    opens = F.pmod(F.xxhash64("bucket", F.lit(level), F.lit(2)), F.lit(SECOND_CHANCE)) == 0
    rows = rows.withColumn("first", drawn(0))
    children = F.when(opens, F.array(child(F.col("first")), child(second))).otherwise(F.array(child(F.col("first"))))
    return rows.select("node", F.explode(children).alias("bucket"))


def _bucket_links(least_agreement: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in segments(batches, "bucket"):
            bounds = group_limits(table, "bucket")
            nodes = table.column("node").to_numpy()
            tokens = table.column("tokens").combine_chunks()
            tokens = tokens.flatten().to_numpy().reshape(len(nodes), -1)
            sizes = np.diff(bounds)
            a, b = [], []
            two = bounds[:-1][sizes == 2]
            if len(two):
                alike = (tokens[two] == tokens[two + 1]).mean(axis=1) >= least_agreement
                a.append(nodes[two][alike])
                b.append(nodes[two + 1][alike])
            for k in np.flatnonzero(sizes > 2):
                own = slice(bounds[k], bounds[k + 1])
                part = tokens[own]
                adjacent = np.stack([(part == row).mean(axis=1) >= least_agreement for row in part])
                labels = spanning(adjacent)
                moved = np.flatnonzero(labels != np.arange(len(labels)))
                a.append(nodes[own][labels[moved]])
                b.append(nodes[own][moved])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return run


def candidate_links(classes: DataFrame, runs: int, levels: int, threshold: float, small: int = SMALL_BUCKET) -> DataFrame:
    """Links (a, b) between classes that some bucket found alike; ``classes`` has node and tokens."""
    spark = classes.sparkSession
    rows = classes.select("node", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(runs - 1).cast("long"))).alias("bucket"))
    found = None
    for level in range(levels):
        rows = stage(_children(rows, level), "paths")
        sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        met = stage(spread_join(rows, sizes, "bucket"), "buckets")
        few = met.filter(F.col("size") <= small).select("node", "bucket")
        few = few.join(classes.select("node", "tokens"), "node").repartition("bucket").sortWithinPartitions("bucket")
        links = few.select("bucket", "node", "tokens").mapInArrow(tidy(_bucket_links(threshold - _AGREEMENT_MARGIN)), "a long, b long")
        found = links if found is None else found.unionByName(links)
        large = met.filter(F.col("size") > small)
        if large.isEmpty():
            break
        if level == levels - 1:  # still together after all splits: compared exactly later
            least = large.groupBy("bucket").agg(F.min("node").alias("a"))
            found = found.unionByName(spread_join(large, least, "bucket").select("a", F.col("node").alias("b")))
        else:
            rows = large.select("node", "bucket").join(classes.select("node", "tokens"), "node")
    return found if found is not None else spark.createDataFrame([], "a long, b long")


def _exact(threshold: float):
    def overlaps(sets: list[np.ndarray]) -> np.ndarray:
        """Sizes of all intersections, by a product of 0/1 matrices over the shared shingles, a slice at a time."""
        every = np.concatenate(sets)
        _, token, counts = np.unique(every, return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        shared = counts > 1
        number = np.cumsum(shared) - 1
        keep = shared[token]
        token, row = number[token[keep]], row[keep]
        total = np.zeros((len(sets), len(sets)), dtype=np.float32)
        order = np.argsort(token, kind="stable")
        token, row = token[order], row[order]
        width = 4096
        limits = np.searchsorted(token, np.arange(0, int(shared.sum()) + width, width))
        for k, (lo, hi) in enumerate(zip(limits[:-1], limits[1:], strict=True)):
            dense = np.zeros((len(sets), width), dtype=np.float32)
            dense[row[lo:hi], token[lo:hi] - k * width] = 1
            total += dense @ dense.T
        return total

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in segments(batches, "task"):
            bounds = group_limits(table, "task")
            nodes, members = table.column("node").to_numpy(), table.column("members").to_numpy()
            side, cross = table.column("side").to_numpy(), table.column("cross").to_numpy(zero_copy_only=False)
            column = table.column("shingles").combine_chunks()
            out = []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if hi - lo < 2:
                    continue
                sets = [np.frombuffer(column[i].as_buffer(), dtype="<u8") for i in range(lo, hi)]
                sizes = np.array([len(s) for s in sets], dtype=np.float64)
                both = overlaps(sets).astype(np.float64)
                alike = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
                np.fill_diagonal(alike, False)
                if cross[lo]:
                    alike &= side[lo:hi][:, None] != side[lo:hi][None, :]
                linked = np.flatnonzero(alike.any(axis=1))
                if not len(linked):
                    continue
                labels = spanning(alike)
                links = alike @ members[lo:hi]
                out.append((nodes[lo:hi][linked], nodes[lo:hi][labels[linked]], links[linked]))
            if out:
                a, b, n = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n.astype(np.int64))], names=["a", "b", "links"])

    return run


def _shingles(docs: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of rows (node, text): sorted distinct 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, limits = text_buffers(batch.column(1))
            for lo, hi in row_slices(limits):
                hashes, bounds = _sets(data[limits[lo] : limits[hi]], limits[lo : hi + 1] - limits[lo], size)
                sets = [np.unique(hashes[a:b]).astype("<u8").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return docs.select("node", "text").mapInArrow(tidy(run, HOLDER), "node long, shingles binary")


def jaccard_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SHINGLE,
    threshold: float = THRESHOLD, recall: float = RECALL, small: int = SMALL_BUCKET, block: int = BLOCK,
) -> DataFrame:
    """One row per document: id, class_id, n_links, kept, and the row keys ``_k1`` and ``_k2``."""
    rows = stage(signatures(docs, id_column, text_column, size, TOKENS), "signatures")
    # the first member is the one with the least id; nulls last
    who = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), "_k1", "_k2")
    classes = stage(rows.filter("node IS NOT NULL").groupBy("node", "check", "tokens").agg(
        F.count(F.lit(1)).alias("members"), F.min(who).alias("least")), "classes")
    levels = levels_for(classes.count(), small)
    links = candidate_links(classes.select("node", "tokens"), runs_for(recall, threshold, levels), levels, threshold, small)
    groups = stage(components(links), "candidates")
    # exact comparison within candidate components, in blocks of about ``block`` classes
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    members = spread_join(groups, sizes, "component").join(classes.select("node", "members", "least"), "node")
    texts = docs.select(*row_keys(id_column, text_column), F.col(text_column).alias("text"))
    wanted = members.select("node", F.col("least._k1").alias("_k1"), F.col("least._k2").alias("_k2"))
    texts = texts.join(wanted, KEYS).select("node", "text").dropDuplicates(["node"])
    sets = stage(_shingles(texts, size), "shingles")
    tasks = block_tasks(members, ["component"], F.col("n"), "node", block).select("task", "node", "members", "side", "cross")
    tasks = tasks.join(sets, "node").repartition("task").sortWithinPartitions("task")
    found = stage(tasks.select("task", "node", "members", "side", "cross", "shingles").mapInArrow(
        tidy(_exact(threshold)), "a long, b long, links long"), "links")
    linked = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = components(found)
    whole = classes.select("node", "members", "least").join(linked, "node", "left").join(joined, "node", "left").select(
        "node", "members", "least", F.coalesce("links", F.lit(0)).alias("links"),
        F.coalesce("component", "node").alias("component"))
    whole = stage(whole, "linked")
    heads = whole.groupBy("component").agg(F.min("least").alias("head"))
    per_class = spread_join(whole, heads, "component").select(
        "node", "head", (F.col("links") + F.col("members") - 1).alias("n_links"))
    with_words = spread_join(rows.filter("node IS NOT NULL").select("node", "_id", *KEYS), per_class, "node")
    with_words = with_words.select(
        F.col("_id").alias(id_column), F.col("head.id").alias("class_id"), "n_links",
        ((F.col("head._k1") == F.col("_k1")) & (F.col("head._k2") == F.col("_k2"))
         & F.col("head.id").eqNullSafe(F.col("_id"))).alias("kept"), *KEYS)
    wordless = rows.filter("node IS NULL").select(
        F.col("_id").alias(id_column), F.col("_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(True).alias("kept"), *KEYS)
    return with_words.unionByName(wordless)
