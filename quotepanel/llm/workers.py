"""What a Python worker keeps between tasks: one object, so that stages do not add up."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps
from typing import Any

import pyarrow as pa

_held: dict[str, Any] = {}


def give_back() -> None:
    """Gives freed memory back to the system, where the allocators can, rather than keep it for later."""
    pa.default_memory_pool().release_unused()
    getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)(0)


def _drop() -> None:
    """Empties the slot and gives its memory back."""
    if _held:
        _held.clear()
        gc.collect()
        give_back()


def held(name: str, make: Callable[[], Any]) -> Any:
    """The worker's object of that name; another one that it held is let go first."""
    if name not in _held:
        _drop()
        _held[name] = make()
    return _held[name]


def release() -> None:
    """Let go of what an earlier stage has left in this worker."""
    _drop()


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for a task: what it worked with goes back at its end, as workers wait for other tasks, and those of Spark itself, with all they have."""

    @wraps(run)
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task
