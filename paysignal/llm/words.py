"""Words and hashes of word windows, vectorised over the UTF-8 bytes of many texts.

A word is a maximal run of bytes other than space and tab to carriage return,
which is the same as ``[^\\x20\\x09-\\x0D]+`` on the characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from paysignal.llm.task_memory import holders

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False

# Odd 64-bit multipliers of the polynomial hashes, and the mixing constants; any odd numbers do.
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
_MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
_MASK = (1 << 64) - 1

_GROUP_BYTES = 1 << 20
SLICE_BYTES = 2 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class _PowerTable:
    """Powers of a base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base = base
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up = _powers(self.base, size)
            self.down = _powers(pow(self.base, -1, 1 << 64), size)
        return self.up[:n], self.down[:n]

    def clear(self) -> None:
        self.up = self.down = np.empty(0, dtype=np.uint64)


_BYTE_POWERS = _PowerTable(_BYTE_BASE)
_WORD_POWERS = _PowerTable(_WORD_BASE)
HOLDER = "words"
holders[HOLDER] = lambda: (_BYTE_POWERS.clear(), _WORD_POWERS.clear())


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(_MIX[0])
    h ^= h >> np.uint64(29)
    h *= np.uint64(_MIX[1])
    return h ^ (h >> np.uint64(32))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the limits of its rows in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    limits = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    limits = limits[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.empty(0, dtype=np.uint8)
    return data[limits[0] : limits[-1]], limits - limits[0]


def row_slices(limits: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one longer row."""
    rows, start = len(limits) - 1, 0
    while start < rows:
        stop = int(np.searchsorted(limits, limits[start] + most, side="right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def find_words(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of the first word of every row (and after the last)."""
    word = _IS_WORD[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = limits[:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, limits)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word, in groups of about a megabyte to bound memory."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(int(np.searchsorted(ends, base + _GROUP_BYTES, side="right")), i + 1)
        if ends[i] - base > _GROUP_BYTES:  # one huge word
            out[i] = xxhash.xxh64_intdigest(data[base : ends[i]].tobytes())
            i += 1
            continue
        part = data[base : ends[j - 1]].astype(np.uint64)
        part += np.uint64(1)
        up, down = _BYTE_POWERS.upto(len(part) + 1)
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * up[:-1], out=total[1:])
        at = starts[i:j] - base
        out[i:j] = (total[ends[i:j] - base] - total[at]) * down[at]
        i = j
    return mix(out)


def hash_windows(words: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """One hash per ``size`` consecutive entries of ``words`` (rows are not told apart here)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    up, down = _WORD_POWERS.upto(len(words) + 1)
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    salted = words if not salt else mix(words ^ np.uint64(salt))
    np.cumsum(salted * up[:-1], out=total[1:])
    return mix((total[size:] - total[:n]) * down[:n])


def window_rows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start index of every window that lies within one row, and its row."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[:-1][rows] + within, rows


def packed(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values, dtype=kind).tobytes()


def binary_column(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, type=pa.binary())
