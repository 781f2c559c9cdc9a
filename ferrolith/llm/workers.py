"""What Python workers hold: they outlive their task and stand beside the next stages."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa

#: Rows of a batch that a task works on at once.
ROWS = 1024


def give_back() -> None:
    """Return what this worker has freed to the system (the C library and Arrow keep it otherwise)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def frugal(function: Callable) -> Callable:
    """A function for ``mapInArrow`` that works on slices and gives its memory back at the end of the task."""

    @wraps(function)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(slices(batches))
        give_back()  # by now all that the function held is gone

    return run
