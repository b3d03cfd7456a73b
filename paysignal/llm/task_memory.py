"""Keeps reused Python workers small: what a task freed goes back to the machine, and caches belong to one user.

Workers live on between tasks and stages, and their allocators keep the pages of freed objects, so a worker would hold the
most that any of its earlier tasks ever needed, beside the caches of operators that are long done.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

# Clears the caches of a user, by name; filled by the modules that hold caches across tasks.
holders: dict[str, Callable[[], object]] = {}


def give_back() -> None:
    """Returns freed pages of Arrow's and the C library's allocators."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # other C libraries
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], user: str = "", after: Callable[[], object] | None = None):
    """``run`` for ``mapInArrow``, with a tidy worker before and after: caches of others than ``user`` are dropped first,
    ``after`` is called at the end, however the task ends, and freed memory is given back."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, clear in holders.items():
            if name != user:
                clear()
        try:
            yield from run(batches)
        finally:
            if after is not None:
                after()
            give_back()

    return tidied
