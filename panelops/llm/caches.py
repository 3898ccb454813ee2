"""Look-up caches of the Python workers.

Spark hands a worker the tasks of one operator after another. Each operator
claims the caches when its task starts, which empties those of all others, so
a worker holds one operator's cache at a time.
"""

from __future__ import annotations

_CACHES: dict[str, dict] = {}
_OWNER: list[str] = []


def register(name: str, cache: dict) -> dict:
    _CACHES[name] = cache
    return cache


def claim(name: str) -> None:
    if _OWNER == [name]:
        return
    for other, cache in _CACHES.items():
        if other != name:
            cache.clear()
    _OWNER[:] = [name]
