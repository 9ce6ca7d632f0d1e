"""Registry of named queries: a Spark builder and (where SQL can say it) a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None


QUERIES: dict[str, Query] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, oracle)
        return fn

    return wrap


def load_all() -> dict[str, Query]:
    # importing the modules fills the registry
    from ringwise.plans import relational, rings, centrality, structure, proximity, samples, summary  # noqa: F401

    return QUERIES
