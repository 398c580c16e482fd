"""Named jobs and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]

JOBS: dict[str, Job] = {}
TWINS: dict[str, str] = {}


def job(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    """Register a job; ``sql`` is the same computation as ANSI SQL for the cross-check."""

    def add(fn: Job) -> Job:
        if name in JOBS:
            raise ValueError(f"duplicate job {name}")
        JOBS[name] = fn
        if sql is not None:
            TWINS[name] = sql
        return fn

    return add
