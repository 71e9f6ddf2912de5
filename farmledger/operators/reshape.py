"""Pivot, unpivot and ranked causes. Pivots name their values, so no extra job discovers them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farmledger.functions.ratios import fixed
from farmledger.operators.joins import join_same

Expr = str | Column


def _col(c: Expr) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pivot(df: DataFrame, key: Sequence[str], on: str, values: Sequence, agg: Column) -> DataFrame:
    """One column per listed value."""
    return df.groupBy(*key).pivot(on, list(values)).agg(agg)


def pivot_case(
    df: DataFrame, key: Sequence[str], on: str, mapping: Mapping, value: Expr, default: float = 0.0
) -> DataFrame:
    """Sum of ``value`` in one named column per category; several categories may share a column."""
    columns: dict[str, list] = {}
    for category, name in mapping.items():
        columns.setdefault(name, []).append(category)
    return df.groupBy(*key).agg(
        *[
            F.coalesce(F.sum(F.when(F.col(on).isin(cats), _col(value))), F.lit(default)).alias(name)
            for name, cats in columns.items()
        ]
    )


def pivot_multi(
    df: DataFrame, key: Sequence[str], on: str, values: Sequence, measures: Mapping[str, Column], sep: str = "_"
) -> DataFrame:
    """Several measures per value: columns ``<value><sep><measure>``; NULL cells become 0."""
    wide = df.groupBy(*key).pivot(on, list(values)).agg(*[c.alias(n) for n, c in measures.items()])
    cells = [c for c in wide.columns if c not in key]
    names = {c: c if sep == "_" else c.replace("_", sep, 1) for c in cells}
    return wide.select(*key, *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(names[c]) for c in cells])


def unpivot(
    df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str, value: str, drop_zero: bool = False
) -> DataFrame:
    """One row per listed column, from one scan; columns are brought to double first. Rows stay in the task of their ids."""
    cells = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])
    long = df.select(*ids, F.inline(cells))
    return long.where(F.coalesce(F.col(value), F.lit(0.0)) != 0) if drop_zero else long


def top_n_others(
    df: DataFrame, key: Sequence[str], cat: str, val: Expr, n: int = 3, scale: int = 4, unique: bool = False
) -> DataFrame:
    """The ``n`` largest categories per key as columns (name, quantity, percent) and the remainder as "others".

    Ties go to the smaller category. The rank is filtered, so each task forwards at most ``n`` categories of a key. ``unique``
    says that ``df`` has one row a key and category, as after an unpivot of one row a key: all are ranked and totalled in one
    aggregate, without a join, and rows that lie together by some of ``key`` are not shuffled again.
    """
    if unique:
        totals = df.select(*key, cat, _col(val).alias("__q"))
    else:
        totals = df.groupBy(*key, cat).agg(F.sum(_col(val)).alias("__q"))
    w = Window.partitionBy(*key).orderBy(F.col("__q").desc(), F.col(cat).asc())
    ranked = totals.select("*", F.row_number().over(w).alias("__rank"))
    top = F.col("__rank") <= n
    cells = [
        *[F.max(F.when(F.col("__rank") == i, F.col(cat))).alias(f"name_{i}") for i in range(1, n + 1)],
        *[F.max(F.when(F.col("__rank") == i, F.col("__q"))).alias(f"qty_{i}") for i in range(1, n + 1)],
        F.sum(F.when(top, F.col("__q"))).alias("__top"),
    ]
    if unique:
        joined = ranked.groupBy(*key).agg(*cells, F.sum("__q").alias("qty_total"))
    else:
        whole = totals.groupBy(*key).agg(F.sum("__q").alias("qty_total"))
        joined = join_same(ranked.where(top).groupBy(*key).agg(*cells), whole, key)
    pct = [fixed(F.try_divide(F.col(f"qty_{i}"), F.col("qty_total")) * 100, scale).alias(f"pct_{i}") for i in range(1, n + 1)]
    return joined.select(
        *key,
        *[f"name_{i}" for i in range(1, n + 1)],
        *[f"qty_{i}" for i in range(1, n + 1)],
        *pct,
        (F.col("qty_total") - F.col("__top")).alias("qty_others"),
        "qty_total",
    )


def list_weeks(df: DataFrame, key: Sequence[str], week: str, product: str, day: str, sep: str = ",") -> DataFrame:
    """Products given in a week and the number of lines of each, as two texts on one row per key and week; every week stays."""
    counted = df.groupBy(*key, week, product).agg(F.count(day).alias("__n"))
    pair = F.struct(F.col(product).cast("string").alias("p"), F.col("__n").cast("string").alias("n"))
    listed = counted.groupBy(*key, week).agg(F.sort_array(F.collect_list(pair)).alias("__l"))
    return listed.select(
        *key, week,
        F.array_join(F.transform("__l", lambda e: e["p"]), sep).alias("products"),
        F.array_join(F.transform("__l", lambda e: e["n"]), sep).alias("lines"),
    )


def list_pivot(
    df: DataFrame, key: Sequence[str], week: str, product: str, day: str, weeks: Mapping[int, str], sep: str = ","
) -> DataFrame:
    """The texts of :func:`list_weeks` in two columns for each of the given weeks; other weeks have no column."""
    texts = list_weeks(df, key, week, product, day, sep)
    return texts.groupBy(*key).agg(
        *[F.max(F.when(F.col(week) == w, F.col("products"))).alias(f"products_{label}") for w, label in weeks.items()],
        *[F.max(F.when(F.col(week) == w, F.col("lines"))).alias(f"lines_{label}") for w, label in weeks.items()],
    )


def stack_pairs(df: DataFrame, ids: Sequence[str], pairs: Mapping[str, Mapping[str, Expr]], tag: str) -> DataFrame:
    """Paired measure sets of one row become one row per set, from one scan."""
    sets = [
        F.struct(F.lit(label).alias(tag), *[_col(e).alias(n) for n, e in cols.items()]) for label, cols in pairs.items()
    ]
    return df.select(*ids, F.explode(F.array(*sets)).alias("__set")).select(*ids, "__set.*")
