"""The query catalogue: each operator on the given tables, with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` under ``name``."""
    def add(run: Run) -> Run:
        if name in CATALOGUE:
            raise ValueError(f"query registered twice: {name}")
        CATALOGUE[name] = Query(run, sql)
        return run
    return add


def load_all() -> dict[str, Query]:
    from embedlift.queries import checksums, jobs, logs, records, schemas, states, stores, streams, validation  # noqa: F401

    return CATALOGUE
