"""Removes word windows that occur more than once in a corpus.

1. Sketch. Of the shorter windows (``SUB`` words) inside each window, the one with
   the least hash is its anchor; equal windows have equal anchors, and neighbours
   mostly share theirs, so about one anchor in twelve words is counted. Every task
   counts its anchors in a count-min sketch (``ROWS`` rows, counts up to two); the
   sketches are merged on Spark, one block of cells at a time in a stream of entries. As each occurrence of a window
   counts an anchor occurrence, a merged cell never underestimates a window's
   count. What is kept is one bit per cell: two or more, or not.
2. Exact pass. Windows whose anchor has all its bits set are grouped by a 96-bit
   hash in shards, after each task has reduced its own repeats to one entry. Other
   windows occur once for certain and are never shuffled.
3. Positions of repeated windows go back to their documents, and the words they
   cover are left out.

The bitmaps are broadcast; their size is bounded (``MOST_CELLS`` cells a row, 64 MB in all).
Where a corpus outgrows the sketch, more windows reach the exact pass; no window
is ever lost or added. The input is read twice and must give the same rows both
times in the same order (files do).

Cases: null or empty text has no words; texts shorter than a window keep all;
repeated rows repeat each other's windows; a null id is an ordinary value; columns
that the result adds replace equally named ones; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.llm.rows import KEYS, row_keys, text_bytes
from paysignal.llm.task_memory import tidy
from paysignal.llm.words import (
    HOLDER, binary_column, find_words, hash_windows, hash_words, mix, packed, row_slices, text_buffers, window_rows,
)
from paysignal.session import stage

SIZE = 35
SUB = 12
ROWS = 2
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 28
_ROW_SALTS = (0x243F6A8885A308D3, 0x13198A2E03707344)
_CHECK_SALT = 0xA4093822299F31D0
_FLUSH = 2 << 20
_SHARD_BYTES = 24 << 20
_NOWHERE = np.uint64((1 << 64) - 1)


def cells_for(n_bytes: int) -> int:
    """Four cells per expected anchor (one in about 64 bytes), as a power of two within bounds."""
    return min(max(1 << max(n_bytes // 16, 1).bit_length(), LEAST_CELLS), MOST_CELLS)


class _Slice:
    """Windows of a slice of rows: word hashes, window starts, rows and anchors."""

    def __init__(self, data: np.ndarray, limits: np.ndarray, size: int, sub: int):
        starts, ends, self.first = find_words(data, limits)
        self.words = hash_words(data, starts, ends)
        self.at, self.rows = window_rows(self.first, size)
        least, where = _anchors(self.words, size, sub)
        self.anchors, self.places = (least[self.at], where[self.at]) if len(self.at) else (least[:0], where[:0])


def _anchors(words: np.ndarray, size: int, sub: int) -> tuple[np.ndarray, np.ndarray]:
    least = hash_windows(words, sub)
    where = np.arange(len(least))
    span, width = size - sub + 1, 1
    while width < span:
        step = min(width, span - width)
        n = max(len(least) - step, 0)
        nearer = least[step:] < least[:n]
        where = np.where(nearer, where[step:], where[:n])
        least = np.where(nearer, least[step:], least[:n])
        width += step
    return least, where


def _cells(anchors: np.ndarray, row: int, cells: int) -> np.ndarray:
    return mix(anchors ^ np.uint64(_ROW_SALTS[row])) & np.uint64(cells - 1)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, limits = text_buffers(batch.column(column))
    for lo, hi in row_slices(limits):
        yield lo, hi, data[limits[lo] : limits[hi]], limits[lo : hi + 1] - limits[lo]


def merged_sketch(texts: DataFrame, size: int, sub: int, cells: int) -> np.ndarray:
    """Bits (row, cell) that are set where a merged count is two or more; ``texts`` has one column."""
    block_bits = min(max(cells.bit_length() - 1 - 8, 12), 20)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            every = np.concatenate(held) if held else np.empty(0, dtype=np.uint64)
            held.clear()
            for row in range(ROWS):
                found, counts = np.unique(_cells(every, row, cells), return_counts=True)
                block = (found >> np.uint64(block_bits)).astype(np.int64)
                inner = (found & np.uint64((1 << block_bits) - 1)).astype("<u4")
                firsts = np.flatnonzero(np.diff(block, prepend=-1))
                limits = np.append(firsts, len(block))
                once, more = [], []
                for a, b in zip(limits[:-1], limits[1:], strict=True):
                    single = counts[a:b] == 1
                    once.append(inner[a:b][single].tobytes())
                    more.append(inner[a:b][~single].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(firsts), row, np.int32)), pa.array(block[firsts].astype(np.int32)),
                     binary_column(once), binary_column(more)], names=["row", "block", "once", "more"])

        for batch in batches:
            for _, _, data, limits in _slices(batch, 0):
                part = _Slice(data, limits, size, sub)
                # a place is counted once; the places of a row never fall back
                new = np.flatnonzero(np.diff(part.places, prepend=-1))
                held.append(part.anchors[new])
                n += len(new)
                if n >= _FLUSH:
                    yield from flush()
                    n = 0
        yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries come sorted by row and block: one block is counted at a time, however many tasks sent entries for it."""
        count = np.zeros(1 << block_bits, dtype=np.uint8)
        current: tuple[int, int] | None = None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([current[0]], pa.int32()), pa.array([current[1]], pa.int32()),
                 binary_column([np.packbits(count == 2).tobytes()])], names=["row", "block", "bits"])

        for batch in batches:
            once_column, more_column = batch.column("once"), batch.column("more")
            for i, key in enumerate(zip(batch.column("row").to_pylist(), batch.column("block").to_pylist(), strict=True)):
                if key != current:
                    if current is not None:
                        yield done()
                    current = key
                    count[:] = 0
                count[np.frombuffer(more_column[i].as_buffer(), dtype="<u4")] = 2
                at = np.frombuffer(once_column[i].as_buffer(), dtype="<u4")
                count[at] = np.minimum(count[at] + 1, 2)
        if current is not None:
            yield done()

    partial = texts.mapInArrow(tidy(run, HOLDER), "row int, block int, once binary, more binary")
    dealt = partial.repartition("row", "block").sortWithinPartitions("row", "block")
    merged = dealt.mapInArrow(tidy(merge), "row int, block int, bits binary")
    bits = np.zeros((ROWS, cells >> 3), dtype=np.uint8)
    width = 1 << block_bits >> 3
    for found in merged.toLocalIterator():  # bounded by the number of cells
        bits[found.row, found.block * width : (found.block + 1) * width] = np.frombuffer(found.bits, dtype=np.uint8)
    return bits


def _shard_entries(batches: Iterator[pa.RecordBatch], bits: np.ndarray, size: int, sub: int, shards: int):
    """Rows (shard, src, kind, keys, hashes, checks, refs); kind 1 hands on a source's keys and own findings."""
    cells = bits.shape[1] << 3
    keys: list[np.ndarray] = []
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rows = n = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal rows, n
        if not found:
            return
        hashes, checks, refs = (np.concatenate(x) for x in zip(*found, strict=True))
        index = np.concatenate(keys)
        found.clear()
        keys.clear()
        rows = n = 0
        src = xxhash.xxh64_intdigest(index.tobytes(), seed=TaskContext.get().partitionId()) - (1 << 63)
        order = np.lexsort((refs, checks, hashes))
        hashes, checks, refs = hashes[order], checks[order], refs[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1])
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(hashes)))
        own = refs[np.repeat(sizes > 1, sizes)]
        hashes, checks = hashes[first], checks[first]
        refs = np.where(sizes > 1, _NOWHERE, refs[first])
        shard = ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        limits = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
        table = {c: [] for c in ("shard", "src", "kind", "keys", "hashes", "checks", "refs")}

        def add(*values) -> None:
            for column, value in zip(table.values(), values, strict=True):
                column.append(value)

        add(src % shards, src, 1, packed(index, "<i8"), b"", b"", packed(own, "<u8"))
        for k in range(shards):
            a, b = limits[k], limits[k + 1]
            if b > a:
                add(k, src, 0, b"", packed(hashes[a:b], "<u8"), packed(checks[a:b], "<u4"), packed(refs[a:b], "<u8"))
        yield pa.RecordBatch.from_pydict(table, schema=_ENTRY_SCHEMA)

    for batch in batches:
        batch_keys = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)])
        for lo, hi, data, limits in _slices(batch, 2):
            part = _Slice(data, limits, size, sub)
            likely = np.ones(len(part.anchors), dtype=bool)
            for row in range(ROWS):
                cell = _cells(part.anchors, row, cells)
                likely &= (bits[row][(cell >> np.uint64(3)).astype(np.int64)] >> (7 - (cell & np.uint64(7)).astype(np.uint8))) & 1 == 1
            if not likely.any():
                continue
            at, of = part.at[likely], part.rows[likely]
            present, ordinal = np.unique(of, return_inverse=True)
            keys.append(batch_keys[lo:hi][present])
            refs = ((ordinal + rows).astype(np.uint64) << np.uint64(32)) | (at - part.first[of]).astype(np.uint64)
            checks = (hash_windows(part.words, size, _CHECK_SALT)[at] >> np.uint64(32)).astype(np.uint32)
            found.append((hash_windows(part.words, size)[at], checks, refs))
            rows += len(present)
            n += len(at)
            if n >= _FLUSH:
                yield from flush()
    yield from flush()


_ENTRY_SCHEMA = pa.schema([
    ("shard", pa.int64()), ("src", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("hashes", pa.binary()),
    ("checks", pa.binary()), ("refs", pa.binary())])


def _repeated(group: pd.DataFrame) -> pd.DataFrame:
    """Entries of a shard that are not alone, back to their sources."""
    handed = group[group["kind"] == 1][["src", "keys", "refs"]]
    group = group[group["kind"] == 0]
    if group.empty:
        return handed
    hashes = np.frombuffer(b"".join(group["hashes"]), dtype="<u8")
    checks = np.frombuffer(b"".join(group["checks"]), dtype="<u4")
    refs = np.frombuffer(b"".join(group["refs"]), dtype="<u8")
    of = np.repeat(np.arange(len(group)), [len(x) >> 3 for x in group["hashes"]])
    order = np.lexsort((checks, hashes))
    same = (hashes[order][1:] == hashes[order][:-1]) & (checks[order][1:] == checks[order][:-1])
    more = np.zeros(len(order), dtype=bool)
    more[1:] |= same
    more[:-1] |= same
    hit = np.zeros(len(order), dtype=bool)
    hit[order] = more
    hit &= refs != _NOWHERE
    at, of = refs[hit], of[hit]
    limits = np.searchsorted(of, np.arange(len(group) + 1))
    parts = [(s, at[a:b].tobytes()) for s, a, b in zip(group["src"], limits[:-1], limits[1:], strict=True) if b > a]
    back = pd.DataFrame({"src": [s for s, _ in parts], "keys": [b""] * len(parts), "refs": [r for _, r in parts]})
    return pd.concat([handed, back]) if len(parts) else handed


def _spans_of(size: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Covered word ranges of each document of one source."""
        index = np.frombuffer(b"".join(group["keys"]), dtype="<i8").reshape(-1, 2)
        refs = np.unique(np.frombuffer(b"".join(group["refs"]), dtype="<u8"))
        of, at = (refs >> np.uint64(32)).astype(np.int64), (refs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        if not len(refs):
            return pd.DataFrame({"_k1": [], "_k2": [], "_spans": []}).astype({"_k1": "int64", "_k2": "int64"})
        gap = np.ones(len(refs), dtype=bool)
        gap[1:] = (of[1:] != of[:-1]) | (at[1:] > at[:-1] + size)
        begin = np.flatnonzero(gap)
        end = np.append(begin[1:], len(refs)) - 1
        spans = np.column_stack((at[begin], at[end] + size)).astype("<u4")
        owner = of[begin]
        limits = np.append(np.flatnonzero(np.diff(owner, prepend=-1)), len(owner))
        docs = owner[limits[:-1]]
        return pd.DataFrame({
            "_k1": index[docs, 0], "_k2": index[docs, 1],
            "_spans": [spans[a:b].tobytes() for a, b in zip(limits[:-1], limits[1:], strict=True)]})

    return run


def repeated_spans(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SIZE, sub: int = SUB,
    cells: int | None = None,
) -> DataFrame:
    """Word ranges covered by repeated windows: row keys and pairs of 32-bit (start, end) word numbers."""
    sub = min(sub, size)
    n_bytes = text_bytes(docs, text_column)
    shards = max(docs.sparkSession.sparkContext.defaultParallelism, -(-n_bytes // _SHARD_BYTES))
    bits = merged_sketch(docs.select(text_column), size, sub, cells or cells_for(n_bytes))
    sent = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _shard_entries(batches, sent.value, size, sub, shards)

    keyed = docs.select(*row_keys(id_column, text_column), text_column)
    entries = keyed.mapInArrow(
        tidy(run, HOLDER), "shard long, src long, kind int, keys binary, hashes binary, checks binary, refs binary")
    back = entries.groupBy("shard").applyInPandas(_repeated, "src long, keys binary, refs binary")
    spans = back.groupBy("src").applyInPandas(_spans_of(size), "_k1 long, _k2 long, _spans binary")
    return spans.groupBy(*KEYS).agg(F.first("_spans").alias("_spans"))  # equal rows have equal spans


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SIZE, sub: int = SUB,
    cells: int | None = None, normalise: bool = False,
) -> DataFrame:
    """``docs`` with the kept words as text (joined by one space), and ``n_words`` and ``n_removed``.

    Without ``normalise`` a text that loses nothing stays as it is, null too.
    """
    spans = stage(repeated_spans(docs, id_column, text_column, size, sub, cells), "spans")
    added = ["n_words", "n_removed"]
    plain = docs.drop(*added)
    names = plain.columns
    place = names.index(text_column)
    schema = T.StructType([*plain.schema.fields, *(T.StructField(n, T.LongType()) for n in added)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_words, n_removed = [], [], []
            data, limits = text_buffers(batch.column(place))
            raw = memoryview(np.ascontiguousarray(data))
            missing = batch.column(place).is_null().to_pylist()
            marks = batch.column(len(names))
            for i in range(batch.num_rows):
                text = bytes(raw[limits[i] : limits[i + 1]])
                words = text.split()
                removed = 0
                mark = marks[i].as_py()
                if mark:
                    kept, last = [], 0
                    for a, b in np.frombuffer(mark, dtype="<u4").reshape(-1, 2).tolist():
                        kept += words[last:a]
                        removed += b - a
                        last = b
                    text = b" ".join(kept + words[last:])
                elif normalise:
                    text = b" ".join(words)
                elif missing[i]:
                    text = None
                texts.append(text)
                n_words.append(len(words))
                n_removed.append(removed)
            columns = batch.columns[: len(names)]
            columns[place] = pa.array(texts, pa.binary()).cast(pa.string())
            fields = [batch.schema.field(i) for i in range(len(names))]
            fields[place] = pa.field(text_column, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
                schema=pa.schema([*fields, *(pa.field(n, pa.int64()) for n in added)]))

    keyed = plain.select("*", *row_keys(id_column, text_column))
    marked = keyed.join(spans, KEYS, "left").select(*names, "_spans")
    return marked.mapInArrow(tidy(run), schema)
