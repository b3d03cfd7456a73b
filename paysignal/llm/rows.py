"""Helpers shared by the operators: row keys, sampling, links to components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysignal.llm.grouped import spread_join
from paysignal.session import stage

KEYS = ["_k1", "_k2"]
BATCH_ROWS = 2000


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Arrow batches of whole texts: fewer rows than Spark's default, so that Python tasks stay small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def row_keys(*columns: str) -> list[Column]:
    """Two independent 64-bit hashes of the given columns; equal rows have equal keys."""
    plain = [F.col(c) for c in columns]
    return [F.xxhash64(*plain).alias("_k1"), F.xxhash64(F.lit(7), *reversed(plain)).alias("_k2")]


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text modulo ``modulus``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length(F.col(column))), F.lit(0))).first()[0]


def labelled_sample(rows: DataFrame, label: str, key: str, per_label: int) -> DataFrame:
    """At most ``per_label`` rows of each label, those with the least hash of ``key``; give narrow rows only.

    A threshold per label, from the label counts (a broadcast row for each label), first leaves about twice that
    many rows where they are read, so that no task ever ranks more than a bounded number of rows.
    """
    rows = rows.filter(F.col(label).isNotNull())
    counts = rows.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit(42)), F.lit(1 << 20)) / float(1 << 20)
    near = rows.withColumn("_u", drawn).join(F.broadcast(counts), F.col(label) == F.col("_label"))
    near = near.filter(F.col("_u") * F.col("_n") <= 2.0 * per_label + 50)
    order = Window.partitionBy(label).orderBy("_u", F.xxhash64(F.col(key), F.lit(43)), F.col(key))
    return near.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= per_label).drop(
        "_u", "_n", "_rank", "_label")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Smallest reachable node of every node in ``links`` (columns a, b): rows (node, component).

    Alternates two local rewirings until nothing changes: every node hands its
    larger neighbours its smallest neighbour, then its smaller neighbours the
    smallest of all. Each keeps components and shortens paths, so a logarithmic
    number of rounds is enough; a round ends in a written table. A node of any
    degree costs one aggregate row per task before the shuffle, and the links of a
    hub may be read by several tasks.
    """

    spark: SparkSession = links.sparkSession

    def larger(edges: DataFrame) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        joined = spread_join(both.filter("v > u"), least, "u")
        return joined.select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()

    def smaller(edges: DataFrame) -> DataFrame:
        down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = spread_join(down, least, "u")
        moved = joined.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stage(links.select("a", "b").filter("a <> b").distinct(), "links")
    seen = state(edges)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        edges = stage(smaller(larger(edges)), "links")
        now = state(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)
