"""Submit independent Spark actions together."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any


def run_concurrently(actions: Mapping[str, Callable[[], Any]]) -> dict[str, Any]:
    """Run independent actions (each one or more Spark jobs) from driver
    threads so the scheduler can fill idle executor slots with the tasks of
    the others.  Results by name; the first failure is re-raised."""
    if len(actions) <= 1:
        return {name: fn() for name, fn in actions.items()}
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        futures = {name: pool.submit(fn) for name, fn in actions.items()}
        return {name: f.result() for name, f in futures.items()}
