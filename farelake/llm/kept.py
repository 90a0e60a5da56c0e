"""What a Python process keeps: of a worker from task to task, of the driver from stage to stage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")

_KEPT: dict[Hashable, object] = {}


def release() -> None:
    """Give memory that is free back to the system; the C library keeps blocks of middle size for good, where it has a way to be asked."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def kept(key: Hashable, make: Callable[[], T]) -> T:
    """What ``make`` gave for ``key``, if this worker still has it.

    Only the last key is kept: workers outlive the stages of a pipeline, and what one stage remembers must not add to the next one's.
    """
    if key not in _KEPT:
        _KEPT.clear()
        release()
        _KEPT[key] = make()
    return _KEPT[key]
