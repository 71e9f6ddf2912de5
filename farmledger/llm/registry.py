"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register a function from (spark, directory) to a frame, with its SQL twin where SQL can say it."""

    def add(build: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return add


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")
