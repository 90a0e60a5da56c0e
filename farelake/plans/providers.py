"""Providers: where the offers of a task come from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Provider:
    """A transform from tasks to outcome rows, and the (origin, dest) pairs it covers; None covers all."""

    transform: Callable[[DataFrame], DataFrame]
    coverage: DataFrame | None = None


class ProviderRegistry:
    """Providers by name, in order of registration."""

    def __init__(self, **providers: Provider) -> None:
        self._providers: dict[str, Provider] = dict(providers)

    @property
    def providers(self) -> dict[str, Provider]:
        """A copy; changing it does not change the registry."""
        return dict(self._providers)

    def register(self, name: str, provider: Provider) -> None:
        self._providers[name] = provider

    def unregister(self, name: str) -> None:
        """Forget ``name``; an unknown name is fine."""
        self._providers.pop(name, None)


def covered_tasks(tasks: DataFrame, provider: Provider) -> DataFrame:
    if provider.coverage is None:
        return tasks
    pairs = provider.coverage.select("origin", F.col("dest").alias("destination"))
    return tasks.join(pairs, ["origin", "destination"], "left_semi")


def collect(registry: ProviderRegistry, tasks: DataFrame, schema: str) -> DataFrame:
    """Outcome rows of every registered provider over the tasks it covers; none registered gives no rows."""
    out = None
    for name, provider in registry.providers.items():
        rows = covered_tasks(tasks, provider).transform(provider.transform).withColumn("provider", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return tasks.sparkSession.createDataFrame([], f"{schema}, provider string") if out is None else out


def captured(responses: DataFrame, keys: list[str]) -> Callable[[DataFrame], DataFrame]:
    """A transform that answers tasks from a table of captured outcomes."""
    return lambda tasks: tasks.select(*keys).join(responses, keys)
