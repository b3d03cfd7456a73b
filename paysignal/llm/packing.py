"""Packs token ids into training sequences of several lengths.

Documents are routed to tiers of window sizes. Long ones are cut into full
windows of the largest tier; a rest goes to the smallest tier that holds it. The
windows of a tier are opened by its own rests, longest first; their gaps are
filled by the longest fitting rests of shorter tiers, and what then stays open
by a piece cut from one more rest. So windows are full, whatever the tier; only
the last window of a task may need padding. Windows of a tier are gathered into
step groups of equal token counts, so that steps cost the same.

Tasks pack on their own, in batches of bounded size: no shuffle, no shared
state, and a task that is run again gives the same sequences, provided that the
input is read in the same order (as from files).

Cases: null or empty text is the end id alone; repeated rows are packed each;
any number of further columns is ignored; no rows give no sequences.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from paysignal.llm.task_memory import tidy
from paysignal.llm.unit_tokens import HOLDER, encoder, id_bytes
from paysignal.llm.words import row_slices, text_buffers

TIERS = (256, 512, 1024, 2048)
END_ID = 1
STEP_WINDOWS = 16
_BATCH_TOKENS = 2 << 20
_SLICE_BYTES = 2 << 20
CACHE_UNITS = 200_000


class Packer:
    """Turns (document, length) rests into windows; windows are lists of (document, start, length)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        if list(tiers) != sorted(set(tiers)) or any(t & (t - 1) for t in tiers):
            raise ValueError("tiers must be rising powers of two")
        self.tiers = tiers
        self.rests: list[tuple[int, int, int]] = []  # (length, document, start), by length

    def add(self, document: int, length: int) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        top = self.tiers[-1]
        start = 0
        while length - start >= top:
            yield top, [(document, start, top)]
            start += top
        if length > start:
            self.rests.append((length - start, document, start))

    def _fill(self, window: list, gap: int) -> int:
        """Longest fitting rests first, then a piece of the longest rest."""
        rests = self.rests
        while gap and rests:
            at = bisect_right(rests, (gap, 1 << 62, 0)) - 1
            if at >= 0:
                length, document, start = rests.pop(at)
                window.append((document, start, length))
                gap -= length
            else:
                length, document, start = rests.pop()
                window.append((document, start, gap))
                insort(rests, (length - gap, document, start + gap))
                gap = 0
        return gap

    def pack(self) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """Full windows, longest tier first, as long as the rests fill them."""
        rests = self.rests
        rests.sort()
        total = sum(r[0] for r in rests)
        for k in range(len(self.tiers) - 1, -1, -1):
            tier = self.tiers[k]
            least = self.tiers[k - 1] if k else 0
            while rests and rests[-1][0] > least and total >= tier:
                length, document, start = rests.pop()
                take = min(length, tier)
                window = [(document, start, take)]
                if take < length:
                    insort(rests, (length - take, document, start + take))
                self._fill(window, tier - take)
                total -= tier
                yield tier, window

    def finish(self) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """What is left, in windows of the largest tier; only the very last may be open."""
        yield from self.pack()
        top = self.tiers[-1]
        self.rests.sort()
        while self.rests:
            window: list = []
            self._fill(window, top)
            yield top, window


def pack_documents(
    docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text",
    tiers: tuple[int, ...] = TIERS, end_id: int = END_ID, step_windows: int = STEP_WINDOWS, with_ids: bool = True,
) -> DataFrame:
    """One row per piece: where it comes from, where it lies, and its ids (little-endian, 32 bits).

    ``sequence_id`` is unique; ``tier`` is the sequence's window size and
    ``step_group`` the group of sequences, with as many tokens as ``step_windows``
    windows of the largest tier, that make one step.
    """
    schema = T.StructType([
        T.StructField(id_column, docs.schema[id_column].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()), T.StructField("tier", T.IntegerType()),
        T.StructField("step_group", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if with_ids else []),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer = encoder(vocabulary, False, CACHE_UNITS), Packer(tiers)
        base = TaskContext.get().partitionId() << 33
        made = 0
        in_tier = dict.fromkeys(tiers, 0)
        keys: list = []
        held: list[np.ndarray] = []
        tokens = 0
        out: dict[str, list] = {f.name: [] for f in schema.fields}

        def write(windows) -> None:
            nonlocal made
            for tier, window in windows:
                group = in_tier[tier] // (step_windows * tiers[-1] // tier)
                in_tier[tier] += 1
                offset = 0
                for document, start, length in window:
                    raw = id_bytes(held[document][start : start + length])
                    row = (keys[document], start, length, zlib.crc32(raw), len(held[document]), base + made, offset,
                           tier, base + (tiers.index(tier) << 29) + group, raw)
                    for column, value in zip(out.values(), row, strict=False):
                        column.append(value)
                    offset += length
                made += 1

        def rows() -> Iterator[pa.RecordBatch]:
            if out["start"]:
                arrays = [pa.array(out[f.name], type=target.field(f.name).type) for f in schema.fields]
                for column in out.values():
                    column.clear()
                yield pa.RecordBatch.from_arrays(arrays, schema=target)

        target = None
        for batch in batches:
            if target is None:
                target = pa.schema([
                    pa.field(id_column, batch.schema.field(0).type), *(pa.field(n, pa.int64()) for n in
                    ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")),
                    pa.field("tier", pa.int32()), pa.field("step_group", pa.int64()),
                    *([pa.field("ids", pa.binary())] if with_ids else []),
                ])
            ids_of, texts = batch.column(0), batch.column(1)
            _, limits = text_buffers(texts)
            for lo, hi in row_slices(limits, _SLICE_BYTES):
                ids, bounds = coder.encode(texts.slice(lo, hi - lo))
                for k, key in enumerate(ids_of.slice(lo, hi - lo).to_pylist()):
                    keys.append(key)
                    held.append(np.append(ids[bounds[k] : bounds[k + 1]], np.uint16(end_id)))
                    tokens += len(held[-1])
                    write(packer.add(len(held) - 1, len(held[-1])))
                if tokens >= _BATCH_TOKENS:
                    write(packer.pack())
                    yield from rows()
                    # only documents with a rest stay
                    kept = sorted({d for _, d, _ in packer.rests})
                    new = {d: i for i, d in enumerate(kept)}
                    keys, held = [keys[d] for d in kept], [held[d] for d in kept]
                    packer.rests = [(n, new[d], s) for n, d, s in packer.rests]
                    tokens = sum(len(h) for h in held)
        write(packer.finish())
        yield from rows()

    return docs.select(id_column, text_column).mapInArrow(tidy(run, HOLDER), schema)
