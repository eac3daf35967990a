"""Memory of the Python workers, which Spark keeps for the tasks and stages that follow."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Hands memory that is free inside this process back to the system, where its allocators can do so."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run: Callable[[Batches], Batches], forget: Callable[[], None] | None = None) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, after which its worker holds no more than before: a worker lives on, and the buffers of each stage would add up.

    ``forget`` drops what ``run`` has kept in the worker.
    """

    def task(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            if forget is not None:
                forget()
            give_back()

    return task
