"""Every query by name, with the plain SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from farelake.plans.fixtures import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_views(oracle.strip())
        return fn

    return add


def load() -> None:
    """Import the modules that register queries."""
    from farelake.plans import (  # noqa: F401
        q_attempts, q_endpoints, q_gold, q_offers, q_sources, q_state, q_streams, q_tasks,
    )
