"""Row filters and per-key selections."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from farmledger.functions.text import zero_blank as _zero_blank

Expr = str | Column


def where(df: DataFrame, *preds: Column) -> DataFrame:
    """Conjunction of predicates."""
    return df.where(reduce(lambda a, b: a & b, preds))


def semi(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys.select(*on), list(on), "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """``NOT IN``: a NULL key in ``df`` never qualifies; NULL entries of ``keys`` are left out of the comparison."""
    return df.where(F.col(on).isNotNull()).join(keys.select(on).where(F.col(on).isNotNull()), on, "left_anti")


def split_by(df: DataFrame, col: str, values: Sequence) -> list[DataFrame]:
    """One frame per indicator value; each is a pushed-down filter over the same plan."""
    return [df.where(F.col(col) == v) for v in values]


def keep_max(df: DataFrame, key: Sequence[str], col: str, pred: Column | None = None) -> DataFrame:
    """All rows that carry the key's highest ``col`` (optionally the highest among rows satisfying ``pred``)."""
    source = df if pred is None else df.where(pred)
    best = source.groupBy(*key).agg(F.max(col).alias(col))
    return df.join(best, [*key, col], "left_semi")


def first_n(df: DataFrame, order: Sequence[Expr], n: int) -> DataFrame:
    """First ``n`` rows of the whole result."""
    return df.orderBy(*order).limit(n)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in ascending ``order``; an aggregate, so a hot key is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in (*key, *order)]
    best = df.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("__row"))
    return best.select(*key, "__row.*").select(*df.columns)


def zero_blank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Blank or NULL numeric text becomes 0 in every listed column."""
    return df.withColumns({c: _zero_blank(c) for c in cols})


def cast_decimal(df: DataFrame, cols: Sequence[str], precision: int, scale: int) -> DataFrame:
    """Cast to a fixed decimal; text that is no number becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(DecimalType(precision, scale)) for c in cols})
