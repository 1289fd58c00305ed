"""Registry of the queries with their inventory ids and check SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    covers: str
    run: Job
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(covers: str, sql: str | None = None):
    """Register a job under its function name; ``covers`` lists inventory ids."""

    def register(run: Job) -> Job:
        REGISTRY[run.__name__] = Entry(run.__name__, covers, run, sql)
        return run

    return register
