"""Running independent Spark actions side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

R = TypeVar("R")


def run_concurrently(jobs: dict[str, Callable[[], R]], max_parallel: int = 6) -> dict[str, R]:
    """Run independent Spark actions from a few driver threads.

    Each action is its own Spark job; the scheduler shares the executors
    between them, so small or straggling jobs no longer leave the cluster
    idle while they run one after another.  Every job runs to its end; the
    first failure is then re-raised.
    """
    if max_parallel <= 1 or len(jobs) <= 1:
        return {name: fn() for name, fn in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(max_parallel, len(jobs))) as pool:
        futures = {name: pool.submit(fn) for name, fn in jobs.items()}
        errors = [f.exception() for f in futures.values() if f.exception() is not None]
        if errors:
            raise errors[0]
        return {name: f.result() for name, f in futures.items()}
