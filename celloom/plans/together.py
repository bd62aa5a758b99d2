"""Several pieces of work at the same time in one session."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from time import monotonic
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")

_POOL = "spark.scheduler.pool"


class TookTooLong(RuntimeError):
    """Work was cancelled because its time was up."""


def run_together(
    spark: SparkSession,
    work: Mapping[str, Callable[[], T]],
    at_once: int = 4,
    seconds: float | None = None,
) -> dict[str, T | Exception]:
    """What each piece of work returns, or the exception it ends with, in the order given.

    Each runs in a thread with the caller's local properties, in a scheduler
    pool of its own name (pools share the cluster evenly where
    spark.scheduler.mode is FAIR) and under a job tag of its own. When one
    fails, or has run for ``seconds``, whatever jobs it still has are cancelled
    by the tag; the others go on.
    """
    context = spark.sparkContext
    tags = {name: f"celloom-{uuid.uuid4().hex}" for name in work}
    started: dict[str, float] = {}

    def one(name: str) -> T:
        started[name] = monotonic()
        context.setLocalProperty(_POOL, name)
        context.addJobTag(tags[name])
        try:
            return work[name]()
        except Exception:
            context.cancelJobsWithTag(tags[name])
            raise
        finally:
            # the thread takes other work later
            context.removeJobTag(tags[name])
            context.setLocalProperty(_POOL, None)

    results: dict[str, T | Exception] = {}
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(work) or 1))) as threads:
        # wrapped for each piece, as local properties are copied when a target is wrapped
        running: dict[Future, str] = {threads.submit(inheritable_thread_target(one), name): name for name in work}
        late: set[str] = set()
        while running:
            done, _ = wait(running, timeout=None if seconds is None else 0.2, return_when=FIRST_COMPLETED)
            for future in done:
                name = running.pop(future)
                error = future.exception()
                if error is None:
                    results[name] = future.result()
                elif name in late:
                    results[name] = TookTooLong(f"{name} was cancelled after {seconds:g} s")
                elif isinstance(error, Exception):
                    results[name] = error
                else:
                    raise error
            for name in running.values():
                if seconds is not None and name in started and monotonic() - started[name] > seconds:
                    late.add(name)
                    context.cancelJobsWithTag(tags[name])
    return {name: results[name] for name in work}
