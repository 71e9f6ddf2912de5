"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from farmledger.session import tune
from farmledger.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None

    def run(self, spark: SparkSession, directory: str) -> DataFrame:
        return self.build(Tables(tune(spark), directory))


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    """Register a function from :class:`Tables` to a frame, with its SQL twin where SQL can say it."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, oracle)
        return build

    return register
