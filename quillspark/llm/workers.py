"""What the Python workers hold between tasks."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

_state: dict[str, str] = {}
_caches: dict[str, Callable[[], None]] = {}


def turn_to(work: str, drop: Callable[[], None] | None = None) -> None:
    """Called as a task begins: ``drop`` empties what this kind of work caches, once the worker turns to another.

    Workers outlive their tasks, beside the executor's heap. Arrow's default pool
    would keep about 100 MB of what it once held in each; the system's allocator
    gives large buffers back.
    """
    if _state.get("work") != work:
        pa.set_memory_pool(pa.system_memory_pool())
        for other, empty in list(_caches.items()):
            if other != work:
                empty()
                del _caches[other]
        _state["work"] = work
    if drop is not None:
        _caches[work] = drop
