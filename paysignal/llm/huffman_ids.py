"""Token ids as Huffman-coded blocks, with exact reading back.

Ids of all documents are counted, codes of at most ``MAX_BITS`` bits are found
for them, and the ids are written with the canonical form of these codes: code
lengths alone, in id order, say all. A file row (chunk) holds whole documents in
ascending id order and is cut into blocks of ``BLOCK`` ids; the bit offset of
every block is kept, so blocks are decoded independently of each other, here all
blocks of a chunk in step through one lookup table of 2**MAX_BITS entries.

The files are Parquet files in which a row is a chunk; ``part`` and ``chunk``
give their order, which is the order of the document ids. Only the counts per
id (bounded by the vocabulary) and one number per part reach the driver.

Cases: null or empty text is the end id alone; repeated ids stand next to each
other, in no stated order; a null id sorts first; no rows give files without chunks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.llm.rows import text_bytes
from paysignal.llm.task_memory import tidy
from paysignal.llm.unit_tokens import HOLDER, encoder, id_bytes
from paysignal.llm.words import row_slices, text_buffers
from paysignal.session import fresh_path

MAX_BITS = 16
BLOCK = 256
CHUNK_IDS = 1 << 18
_STEP = 1 << 15  # ids encoded at a time, whole blocks
IDS = 1 << 16
_PART_BYTES = 32 << 20
_SLICE_BYTES = 6 << 20
_ROW_GROUP = {"parquet.block.size": str(8 << 20)}  # what a writing task buffers


def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``most`` bits, by pairing coins level by level (0: unused id)."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << most:
        raise ValueError("more ids than codes")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, items = [], leaves
    is_leaf = np.ones(len(leaves), dtype=bool)
    for _ in range(most):
        levels.append(is_leaf)
        even = items[: len(items) // 2 * 2]
        pairs = even[::2] + even[1::2]
        both = np.concatenate((leaves, pairs))
        rank = np.argsort(both, kind="stable")
        items, is_leaf = both[rank], rank < len(leaves)
    depth = np.zeros(len(leaves), dtype=np.int64)
    take = 2 * len(leaves) - 2
    for is_leaf in reversed(levels):
        n = int(is_leaf[:take].sum())
        depth[:n] += 1
        take = 2 * (take - n)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    code, last = 0, 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        ids = np.flatnonzero(lengths == bits)
        code <<= bits - last
        last = bits
        codes[ids] = code + np.arange(len(ids), dtype=np.uint64)
        code += len(ids)
    return codes


def decode_table(lengths: np.ndarray, most: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Id and code length for every possible next ``most`` bits."""
    ids, bits = np.zeros(1 << most, dtype=np.uint16), np.zeros(1 << most, dtype=np.uint8)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    spans = np.left_shift(1, most - lengths[used].astype(np.int64))
    filled = int(spans.sum())
    ids[:filled] = np.repeat(used, spans)
    bits[:filled] = np.repeat(lengths[used], spans)
    return ids, bits


def encode_ids(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit string, first bit highest, and the bit offset of every block."""
    # both of an id in one number: its code shifted to the top, its length (0: unused, never looked up) below
    both = (codes << (np.uint64(64) - lengths.astype(np.uint64))) | lengths.astype(np.uint64)
    words = np.zeros((len(ids) * MAX_BITS >> 6) + 2, dtype=np.uint64)
    offsets, total = [np.empty(0, dtype=np.int64)], 0
    for i in range(0, len(ids), _STEP):
        value = both.take(ids[i : i + _STEP])
        n = (value & np.uint64(255)).astype(np.int64)
        value &= ~np.uint64(255)
        ends = np.cumsum(n) + total
        starts = ends - n
        offsets.append(starts[::BLOCK])
        total = int(ends[-1])
        word, at = starts >> 6, starts & 63
        bit = at.astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] |= np.bitwise_or.reduceat(value >> bit, first)
        over = np.flatnonzero(at + n > 64)
        words[word[over] + 1] |= value[over] << (np.uint64(64) - bit[over])
    return words[: (total >> 6) + 1].astype(">u8").tobytes()[: (total + 7) >> 3], np.concatenate(offsets)


def decode_ids(payload: bytes, offsets: np.ndarray, n: int, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """All blocks in step: the k-th id of every block at a time."""
    symbol, bits = table
    raw = np.frombuffer(payload + b"\0\0\0\0", dtype=np.uint8).astype(np.uint32)
    ahead = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    blocks = len(offsets)
    out = np.zeros((blocks, BLOCK), dtype=np.uint16)
    at = offsets.astype(np.int64).copy()
    last = n - (blocks - 1) * BLOCK if blocks else 0
    for k in range(min(BLOCK, n)):
        live = at if k < last else at[:-1]
        seen = (ahead[live >> 3] >> (8 - (live & 7)).astype(np.uint32)) & np.uint32((1 << MAX_BITS) - 1)
        out[: len(live), k] = symbol[seen]
        live += bits[seen]
    return out.reshape(-1)[:n]


CHUNK_SCHEMA = "part int, chunk int, before long, n_ids int, docs binary, payload binary, offsets binary"
# beside plain chunks: how often a task met each id, 64 bits each, in the last chunk of the task
_PLAIN_SCHEMA = f"{CHUNK_SCHEMA}, counts binary"


def _tokenise(docs: DataFrame, id_column: str, text_column: str, vocabulary: str, end_id: int) -> DataFrame:
    """Chunks of plain 16-bit ids; ``docs`` holds (id, number of ids, 1 for a null id) in 64 bits each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(vocabulary, True), TaskContext.get().partitionId()
        chunk = before = held = 0
        keys: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        total = np.zeros(IDS, dtype=np.int64)

        def flush(last: bool = False) -> Iterator[pa.RecordBatch]:
            nonlocal chunk, before, held
            if not parts and not (last and chunk):
                return
            index = np.concatenate(keys).astype("<i8").tobytes() if keys else b""
            payload = np.concatenate(parts) if parts else np.empty(0, dtype="<u2")
            total[:] += np.bincount(payload, minlength=IDS)
            yield pa.RecordBatch.from_pylist([{
                "part": part, "chunk": chunk, "before": before, "n_ids": held, "docs": index,
                "payload": payload.astype("<u2", copy=False).tobytes(), "offsets": b"",
                "counts": total.astype("<i8").tobytes() if last else None}], schema=_PLAIN)
            chunk, before, held = chunk + 1, before + held, 0
            keys.clear()
            parts.clear()

        for batch in batches:
            _, limits = text_buffers(batch.column(1))
            for lo, hi in row_slices(limits, _SLICE_BYTES):
                ids, bounds = coder.encode(batch.column(1).slice(lo, hi - lo))
                own = batch.column(0).slice(lo, hi - lo)
                unknown = own.is_null().to_numpy(zero_copy_only=False)
                doc_ids = own.fill_null(0).to_numpy()  # filled first: numpy would turn ids beside a null into doubles
                with_end = np.insert(ids, bounds[1:], end_id)
                bounds = bounds + np.arange(len(bounds))
                first = 0
                while first < hi - lo:
                    room = max(CHUNK_IDS - held, 1)
                    stop = max(int(np.searchsorted(bounds, bounds[first] + room, side="right")) - 1, first + 1)
                    stop = min(stop, hi - lo)
                    parts.append(with_end[bounds[first] : bounds[stop]])
                    keys.append(np.column_stack((doc_ids[first:stop], np.diff(bounds[first : stop + 1]), unknown[first:stop])))
                    held += int(bounds[stop] - bounds[first])
                    first = stop
                    if held >= CHUNK_IDS:
                        yield from flush()
        yield from flush(last=True)

    return docs.select(F.col(id_column).cast("long"), text_column).mapInArrow(tidy(run, HOLDER), _PLAIN_SCHEMA)


_ARROW = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int32()), ("docs", pa.binary()),
    ("payload", pa.binary()), ("offsets", pa.binary())])
_PLAIN = _ARROW.append(pa.field("counts", pa.binary()))


def _count_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(IDS, dtype=np.int64)
    for batch in batches:
        for counts in batch.column(0):
            total += np.frombuffer(counts.as_buffer(), dtype="<i8")
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])


@cache
def _tables(lengths: bytes):
    lengths_ = np.frombuffer(lengths, dtype=np.uint8)
    return lengths_, canonical_codes(lengths_), decode_table(lengths_)


def write_ids(
    docs: DataFrame, path: str, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", end_id: int = 2,
    parts: int | None = None,
) -> None:
    """Writes the ids of all documents, in the order of their (integer) ids, to ``path``.

    ``path/chunks`` has the chunks, ``path/codes`` one row with the code length of each id.
    """
    spark = docs.sparkSession
    parts = parts or max(spark.sparkContext.defaultParallelism, -(-text_bytes(docs, text_column) // _PART_BYTES))
    ordered = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    ordered = ordered.repartitionByRange(parts, "id").sortWithinPartitions("id")
    plain = fresh_path(spark, "plain_ids")
    _tokenise(ordered, "id", "text", vocabulary, end_id).write.options(compression="zstd", **_ROW_GROUP).parquet(plain)
    every = spark.read.schema(_PLAIN_SCHEMA).parquet(plain)
    staged = every.drop("counts").filter("n_ids > 0")
    counted = every.select("counts").filter("counts IS NOT NULL").mapInArrow(_count_ids, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(IDS, dtype=np.int64)
    for row in counted.collect():  # at most one row per id of the vocabulary
        counts[row.id] = row.n
    lengths = code_lengths(counts).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, codes, _ = _tables(lengths)
        for batch in batches:
            payloads, offsets = [], []
            for payload in batch.column("payload"):
                coded, at = encode_ids(np.frombuffer(payload.as_buffer(), dtype="<u2"), codes, bits)
                payloads.append(coded)
                offsets.append(at.astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(payloads, pa.binary()), pa.array(offsets, pa.binary())], schema=_ARROW)

    staged.mapInArrow(run, CHUNK_SCHEMA).write.options(compression="uncompressed", **_ROW_GROUP).parquet(f"{path}/chunks")
    spark.createDataFrame([(bytearray(lengths),)], "lengths binary").coalesce(1).write.parquet(f"{path}/codes")


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents from files of ``write_ids``: id, start (ids of all documents before it), n_tokens, ids_crc32 and ids
    (little-endian, 32 bits)."""
    lengths = bytes(spark.read.parquet(f"{path}/codes").first()[0])
    schema = "id long, part int, before long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _tables(lengths)[2]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                docs = np.frombuffer(row["docs"], dtype="<i8").reshape(-1, 3)
                ids = decode_ids(row["payload"], np.frombuffer(row["offsets"], dtype="<u8"), row["n_ids"], table)
                bounds = np.concatenate(([0], np.cumsum(docs[:, 1])))
                raws = [id_bytes(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                columns = [
                    pa.array(docs[:, 0], mask=docs[:, 2] == 1), pa.array(np.full(len(docs), row["part"], np.int32)),
                    pa.array(row["before"] + bounds[:-1]), pa.array(docs[:, 1]),
                    pa.array(np.array([zlib.crc32(r) for r in raws], dtype=np.int64)),
                ] + ([pa.array(raws, pa.binary())] if with_ids else [])
                names = ["id", "part", "before", "n_tokens", "ids_crc32"] + (["ids"] if with_ids else [])
                yield pa.RecordBatch.from_arrays(columns, names=names)

    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(f"{path}/chunks")
    sizes = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per part
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    found = chunks.mapInArrow(run, schema).join(F.broadcast(bases), "part")
    columns = ["id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"]
    return found.select(*columns, *(["ids"] if with_ids else []))
