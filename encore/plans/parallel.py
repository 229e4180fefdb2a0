"""Run independent Spark actions (writes) concurrently from the driver.

Spark schedules jobs submitted from several threads side by side, so small
single-task jobs (a dimension file) overlap with a large one (the events)
instead of leaving cores idle. Each callable is one action; the first error
is raised after all have finished.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor


def run_all(actions: Iterable[Callable[[], object]], max_workers: int = 4) -> list:
    actions = list(actions)
    if len(actions) <= 1:
        return [a() for a in actions]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(actions))) as pool:
        futures = [pool.submit(a) for a in actions]
        errors = [f.exception() for f in futures]
    for err in errors:
        if err is not None:
            raise err
    return [f.result() for f in futures]
