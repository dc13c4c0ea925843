"""All registered queries with their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from docflow.plans.fixtures import Tables


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(fn, sql)
        return fn

    return add


def load() -> dict[str, Query]:
    from docflow.plans import documents, landing, quality, reports, search, streams  # noqa: F401

    return QUERIES


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query):
        return lambda spark, sf_dir: q.run(Tables(spark, sf_dir))

    return {name: bind(q) for name, q in load().items()}


def oracles() -> dict[str, str]:
    return {name: q.sql for name, q in load().items() if q.sql}
