"""Workers are used again by later tasks and stages, so a task gives its memory back when it ends."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Return what the allocators hold in reserve to the system, where they can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass    # not this C library


def returning(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task``, after which its worker gives memory back."""
    @functools.wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            give_back()

    return run
