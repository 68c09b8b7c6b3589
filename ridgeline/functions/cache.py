"""Scoped persistence for operators that make several passes over a table."""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

_NONE = StorageLevel(False, False, False, False, 1)
_lock = threading.Lock()
_refs: dict[int, int] = {}


@contextmanager
def passes_over(df: DataFrame, columns: list[str] | None = None):
    """Persist (memory, spilling to disk) the projection an operator needs
    while it runs several eager passes, and release it afterwards; the way
    Spark ML's iterative learners handle their input.

    Identical plans share one cache entry, so concurrent users (e.g. model
    fits in parallel threads) are reference-counted: the entry is released
    when the last user leaves. An input the caller persisted is used as it
    is. Lost cached blocks are recomputed from lineage, so an executor loss
    costs time, not correctness."""
    part = df if columns is None else df.select(*[f"`{c}`" for c in columns])
    if df.storageLevel != _NONE:
        yield part
        return
    key = part.semanticHash()
    with _lock:
        if key not in _refs and part.storageLevel != _NONE:
            owned = False
        else:
            owned = True
            _refs[key] = _refs.get(key, 0) + 1
            if _refs[key] == 1:
                part.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield part
    finally:
        if owned:
            with _lock:
                _refs[key] -= 1
                if _refs[key] == 0:
                    del _refs[key]
                    part.unpersist()
