"""Set operations, always by column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*dfs: DataFrame, fill_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not rows of ``b``; NULLs compare equal."""
    return a.subtract(b.select(*a.columns))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()
