"""Helpers for ragged numpy arrays and Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa


def gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """pool[s : s + n] for each start and length, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(pool)) < 1 << 31 else np.int64
    return pool[np.arange(total, dtype=kind) + np.repeat((starts - (ends - lengths)).astype(kind), lengths)]


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def chunks_by_size(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Index ranges whose sizes add up to about `limit`; a larger item is a range of its own."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > limit:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


#: What clears each operator's caches in this process, by the operator's name.
_CLEARS: dict[str, Callable[[], object]] = {}
_busy_with = ""


def clears_cache(name: str, clear: Callable[[], object]) -> None:
    _CLEARS[name] = clear


def release_memory() -> None:
    """Give what is free back to the system: Spark keeps a Python worker for later tasks, of other operators too."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def worker(name: str) -> Callable[[Callable], Callable]:
    """For a function that runs in Python workers (batches in, batches out): when a worker
    turns from one operator to another, the caches of the former go; at the end of each
    task, free memory goes back to the system."""

    def wrap(f: Callable) -> Callable:
        @wraps(f)
        def task(batches: Iterator) -> Iterator:
            global _busy_with
            if _busy_with != name:
                for other, clear in _CLEARS.items():
                    if other != name:
                        clear()
                _busy_with = name
                release_memory()
            yield from f(batches)
            release_memory()

        return task

    return wrap
