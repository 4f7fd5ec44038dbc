"""State of a Python worker process that outlives a task."""

from __future__ import annotations

import ctypes
import functools
import gc
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa


def per_worker(name: str, make: Callable):
    """What `make` returned when `name` was first asked for in this process.

    Functions reach the workers by value, so their globals are new in every task; what should stay
    is kept in a module of its own instead.
    """
    held = sys.modules.setdefault("_fieldcatch_worker", types.ModuleType("_fieldcatch_worker")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


def forget(*keep: str) -> None:
    """Drops what earlier operators have kept in this process, but for the names in `keep`, and gives free memory back.

    Spark hands a worker on to the next job, and a large cache that nobody will ask for again would stay beside
    whatever that job needs. So would what the allocators hold for batches that are long gone.
    """
    held = getattr(sys.modules.get("_fieldcatch_worker"), "__dict__", {})
    for name in [n for n in held if n not in keep and not n.startswith("__")]:
        del held[name]
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it
    if trim:
        trim(0)


def tidy(work: Callable[[Iterator], Iterator], *keep: str) -> Callable[[Iterator], Iterator]:
    """`work` on the batches of a task, in a worker that is rid of what it does not need before and after."""
    @functools.wraps(work)
    def run(batches: Iterator) -> Iterator:
        forget(*keep)
        yield from work(batches)
        forget(*keep)

    return run
