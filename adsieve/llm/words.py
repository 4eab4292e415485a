"""Whole texts, a few megabytes at a time."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import pyarrow as pa


def slices(text: bytes, size: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that end at ASCII white space."""
    at, end = 0, len(text)
    while at < end:
        to = at + size
        if to >= end:
            to = end
        else:
            while to < end and text[to] not in b" \t\n\v\f\r":
                to += 1
        yield at, to
        at = to


_CACHES: list[dict] = []
_NONE: dict = {}
#: The C library's way to return freed memory, where it has one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def sole(cache: dict) -> dict:
    """The cache to use in this task. A worker process serves many operators in turn: the caches of others are emptied,
    and what tasks before have freed goes back to the system."""
    if not any(c is cache for c in _CACHES):
        _CACHES.append(cache)
    for other in _CACHES:
        if other is not cache:
            other.clear()
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)
    return cache


def no_cache() -> None:
    """To be called as a task begins that needs no cache: what the worker's tasks before have remembered goes."""
    sole(_NONE)
