"""Memory of the Python workers, which Spark keeps between tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa


def release() -> None:
    """Gives freed memory back to the system: Arrow's, and the C library's where it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function of a task, after which its worker waits for the next one without the memory that it freed.

    An executor has more workers than cores, and those that wait would hold the peak of an earlier task.
    """

    def task(batches):
        yield from run(batches)
        release()

    return task
