"""The list of jobs: name, Spark function, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]
JOBS: dict[str, Job] = {}
CHECKS: dict[str, str] = {}


def job(name: str, sql: str | None = None) -> Callable[[Job], Job]:
    def register(fn: Job) -> Job:
        if name in JOBS:
            raise ValueError(f"job {name} is registered twice")
        JOBS[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn
    return register
