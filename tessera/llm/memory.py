"""Memory of Python workers, which Spark reuses while the JVM beside them grows."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def release() -> None:
    """Give free memory back to the system; functions call this at the end of a task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)
