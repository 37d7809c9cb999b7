"""Gives memory that a task no longer uses back to the system.

Python workers live on after a task. What its arrays held would stay theirs and
be missing to the next stage.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

#: Only the GNU C library has this function.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def tidy_group(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        found = work(table)
        release()
        return found

    return run


def tidy_cogroup(work: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = work(left, right)
        release()
        return found

    return run


Batches = Iterator[pa.RecordBatch]


def tidy_batches(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for found in work(batches):
            yield found
            del found
            release()
        release()

    return run
