"""Objects that a Python worker keeps from one task to the next."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa


def kept(owner: str, name: str, make: Callable[[], object]) -> object:
    """The object called ``name`` of this worker process, made at first use.

    Only for tables that change speed, never results: a worker may be new at any
    time. Workers outlive jobs, so what other owners left here goes when a new
    owner comes: a worker holds the tables of one operator.
    """
    box = sys.modules.setdefault("_merchlens_worker", types.ModuleType("_merchlens_worker"))
    if getattr(box, "owner", None) != owner:
        box.owner, box.tables = owner, {}
        give_back()
    if name not in box.tables:
        box.tables[name] = make()
    return box.tables[name]


def keeps_nothing(run: Callable) -> Callable:
    """A function of batches that leaves nothing in its worker but what it imports.

    What other owners left here goes before it begins, what it used when it ends.
    """

    def tidy(batches: Iterator) -> Iterator:
        box = sys.modules.get("_merchlens_worker")
        if getattr(box, "owner", None) is not None:
            box.owner, box.tables = None, {}
            give_back()
        yield from run(batches)
        give_back()

    return tidy


def give_back() -> None:
    """Hand memory that is no longer used back to the system: Arrow's, and that of the C library where it can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
