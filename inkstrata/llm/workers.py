"""Memory of Python workers, which Spark keeps between tasks and hands from one operator to the next."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

_held: dict = {}  # the models of the operator whose task ran last, by key


def model(key: tuple, build: Callable):
    """build()'s result, kept for the operator's next tasks in this worker."""
    if key not in _held:
        _held[key] = build()
    return _held[key]


def begin(operator: str) -> None:
    """The models of any other operator go."""
    if _held.get("operator") != operator:
        _held.clear()
        _held["operator"] = operator


def end() -> None:
    """Freed memory goes back to the system, so that a worker that waits holds little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def tidy(operator: str, run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run over a task's batches, between begin() and end()."""

    def tidied(batches: Iterator) -> Iterator:
        begin(operator)
        try:
            yield from run(batches)
        finally:
            end()

    return tidied
