"""Running independent write jobs of one layer side by side.

The tables of one layer do not depend on each other, so their Spark jobs are submitted from a
few driver threads at once (Spark schedules concurrent jobs of one session; no data passes
through the driver).  The threads inherit the caller's job group, pool and description.
Failures keep their meaning: with ``on_error="raise"`` jobs not yet begun are cancelled and the
first failure is re-raised once the running ones have finished, with ``"skip"`` it is logged and
the other tables are still written.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor, as_completed

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

DEFAULT_PARALLEL = 4


def run_writes(writes: Mapping[str, Callable[[], str]], on_error: str = "raise",
               max_parallel: int = DEFAULT_PARALLEL) -> dict[str, str]:
    """Run ``{name: write()}`` (each returns the written path); ``{name: path}`` of successes."""
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error must be 'raise' or 'skip'")
    done: dict[str, str] = {}
    first_error: BaseException | None = None
    workers = max(1, min(max_parallel, len(writes)))
    with ThreadPoolExecutor(max_workers=workers, thread_name_prefix="sediment-write") as pool:
        inherit = inheritable_thread_target(SparkSession.getActiveSession())
        names = {pool.submit(inherit(fn)): name for name, fn in writes.items()}
        for fut in as_completed(names):
            if fut.cancelled():
                continue
            try:
                done[names[fut]] = fut.result()
            except Exception as e:  # noqa: BLE001 - reported, and re-raised unless skipping
                log.exception("writing %s failed", names[fut])
                first_error = first_error or e
                if on_error == "raise":
                    for other in names:
                        other.cancel()
    if first_error is not None and on_error == "raise":
        raise first_error
    return {name: done[name] for name in writes if name in done}
