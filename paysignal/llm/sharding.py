"""Contiguous shards of nearly equal byte size, in DataFrame functions only.

Documents are ordered by id; ties by size and checksum of the text. Rows that are
equal in all three are interchangeable and stay one counted row until the end, so no
number of copies meets in one task. The counted rows are dealt to ranges of the order
and written once with the number of their range. Every range has a total; a running
sum over these few totals says where the range starts, a running sum inside the range
where each row starts. A document belongs to the shard that holds the middle of its
bytes when the whole is cut into equal parts, so a shard differs from its target by
less than one document at each end.

The text itself is read once for its size and checksum and never shuffled.
``write_shards`` finds the shard of a whole row by comparing its order key with the
first keys of the shards, at most as many as there are shards.

Cases: a null text counts one byte and has the checksum of no bytes; null ids come
first; repeated rows are placed each (copies may straddle a cut); a document larger than a
target leaves shards empty; no rows give no rows. Sums must stay below 2**63 divided by
twice the number of shards. Other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysignal.session import stage

SHARDS = 16
COPIES_AT_ONCE = 4096


def digests(docs: DataFrame, id_column: str, text_column: str) -> list[Column]:
    """Order key of a row: id, bytes of its text plus one, and checksum of the text."""
    raw = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    return [F.col(id_column).alias("id"), (F.octet_length(raw).cast("long") + 1).alias("size"), F.crc32(raw).alias("crc")]


_ORDER = ["id", "size", "crc"]


def placed_classes(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One staged row per distinct order key: id, size, crc, copies, and how many bytes and rows come before it."""
    classes = docs.select(*digests(docs, id_column, text_column)).groupBy(*_ORDER).agg(F.count(F.lit(1)).alias("copies"))
    ranged = classes.repartitionByRange(*_ORDER).withColumn("range", F.spark_partition_id())
    # written, so that the ranges are the same for whoever reads them
    ranged = stage(ranged, "shard_ranges")
    totals = ranged.groupBy("range").agg(
        F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    starts = totals.select(
        F.col("range").alias("_range"), F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("_bytes"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_rows"))
    inside = Window.partitionBy("range").orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, -1)
    run = ranged.withColumn("_b", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(inside), F.lit(0))).withColumn(
        "_r", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    placed = run.join(starts, F.col("range") == F.col("_range")).select(
        *_ORDER, "copies", (F.col("_b") + F.col("_bytes")).alias("start"), (F.col("_r") + F.col("_rows")).alias("row"))
    return stage(placed, "shard_places")


def _shard_of(start: Column, size: Column, total: int, shards: int) -> Column:
    """Shard that holds the middle of the bytes [start, start + size)."""
    return F.call_function("div", (2 * start + size) * shards, F.lit(2 * total)).cast("int")


def _copies(classes: DataFrame) -> DataFrame:
    """A row per copy; a class of very many copies is dealt out in pieces first."""
    pieces = F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("copies") - 1, F.lit(COPIES_AT_ONCE)))
    many = classes.filter(F.col("copies") > COPIES_AT_ONCE).withColumn("_piece", F.explode(pieces))
    many = many.repartition("id", "size", "crc", "_piece")
    few = classes.filter(F.col("copies") <= COPIES_AT_ONCE).withColumn("_piece", F.lit(0).cast("long"))
    first = F.col("_piece") * COPIES_AT_ONCE
    numbers = F.sequence(first, F.least(first + COPIES_AT_ONCE, F.col("copies")) - 1)
    rows = few.unionByName(many).withColumn("_copy", F.explode(numbers))
    return rows.select(
        *_ORDER, (F.col("start") + F.col("_copy") * F.col("size")).alias("start"), (F.col("row") + F.col("_copy")).alias("row"))


def shard_table(
    docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per document: id, size, text_crc32, shard, and slot (gapless from 0 within the shard)."""
    classes = placed_classes(docs, id_column, text_column)
    total = classes.agg(F.sum(F.col("size") * F.col("copies"))).first()[0] or 1
    rows = _copies(classes).withColumn("shard", _shard_of(F.col("start"), F.col("size"), total, shards))
    firsts = rows.groupBy("shard").agg(F.min("row").alias("_first"))  # a row per shard
    slotted = rows.join(F.broadcast(firsts), "shard")
    return slotted.select(
        F.col("id").alias(id_column), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("row") - F.col("_first")).alias("slot"))


def _cuts(classes: DataFrame, total: int, shards: int) -> list:
    """Order keys at which a new shard begins, with the shards of the copies of that key; at most one row per shard."""
    first = _shard_of(F.col("start"), F.col("size"), total, shards)
    last = _shard_of(F.col("start") + (F.col("copies") - 1) * F.col("size"), F.col("size"), total, shards)
    known = classes.withColumn("first", first).withColumn("last", last)
    opens = known.groupBy(F.col("last").alias("shard")).agg(F.min(F.struct("row", *_ORDER, "start", "copies", "first", "last")).alias("c"))
    return [r.c for r in opens.orderBy("c.row").collect()]


def with_shards(
    docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text", name: str = "shard",
) -> DataFrame:
    """Whole rows of ``docs`` with their shard, without a shuffle of them. Copies of one row that straddle a cut are dealt
    to the shards in the right shares by their place in the input, as they cannot be told apart."""
    classes = placed_classes(docs, id_column, text_column)
    total = classes.agg(F.sum(F.col("size") * F.col("copies"))).first()[0] or 1
    key = F.struct(*digests(docs, id_column, text_column))
    types = [classes.schema[c].dataType for c in _ORDER]
    shard = F.lit(0)
    for cut in _cuts(classes, total, shards):
        edge = F.struct(*(F.lit(cut[c]).cast(t).alias(c) for c, t in zip(_ORDER, types, strict=True)))
        inside = F.lit(cut["last"])
        if cut["first"] != cut["last"]:
            spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(cut["copies"]))
            inside = _shard_of(F.lit(cut["start"]) + spread * cut["size"], F.lit(cut["size"]), total, shards)
        shard = F.when(key > edge, F.lit(cut["last"])).when(key.eqNullSafe(edge), inside).otherwise(shard)
    return docs.withColumn(name, shard.cast("int"))


def write_shards(
    docs: DataFrame, path: str, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text",
) -> None:
    """Parquet folders ``shard=0`` to ``shard=<shards - 1>``; adaptive execution splits a shard into files of even size."""
    placed = with_shards(docs.drop("shard"), shards, id_column, text_column)
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def shard_sizes(table: DataFrame) -> DataFrame:
    """Rows and bytes of every shard of ``shard_table``."""
    return table.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))


