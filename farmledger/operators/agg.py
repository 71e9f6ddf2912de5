"""Aggregations and hierarchy roll-ups.

Everything here is a two-phase aggregate (partial sums before the shuffle), so a hot key costs one row per task.
Values go back onto rows by a join with the aggregate instead of a window over the raw key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farmledger.functions.ratios import fixed
from farmledger.functions.text import string_list
from farmledger.operators.joins import join_same

Expr = str | Column


def _col(c: Expr) -> Column:
    return F.col(c) if isinstance(c, str) else c


def agg(df: DataFrame, keys: Sequence[Expr], **aggs: Column) -> DataFrame:
    """Grouped aggregate; keys may be expressions with an alias."""
    return df.groupBy(*keys).agg(*[c.alias(name) for name, c in aggs.items()])


def agg_string_list(df: DataFrame, keys: Sequence[str], col: str, out: str, sep: str = ",") -> DataFrame:
    """Distinct sorted values per key as one text; duplicates go before values of a key meet."""
    return df.select(*keys, col).distinct().groupBy(*keys).agg(string_list(col, sep).alias(out))


def two_level_agg(
    df: DataFrame, inner_keys: Sequence[str], inner: Mapping[str, Column],
    outer_keys: Sequence[Expr], outer: Mapping[str, Column],
) -> DataFrame:
    """Aggregate of an aggregate, such as the weekly sum of daily maxima."""
    return agg(agg(df, inner_keys, **inner), outer_keys, **outer)


def rollup_levels(
    df: DataFrame, levels: Mapping[str, Sequence[str]], x: Expr, w: Expr, scale: int = 4, nonzero: bool = False
) -> DataFrame:
    """Weighted mean of ``x`` at every level on one row per finest key; levels run from finest to coarsest.

    Each coarser level is summed from the one below it, so the raw rows are aggregated once.
    """
    names = list(levels)
    weight = F.when(_col(x) != 0, _col(w)) if nonzero else _col(w)
    sums = {n: None for n in names}
    current = df.groupBy(*levels[names[0]]).agg(F.sum(_col(x) * _col(w)).alias("__xw"), F.sum(weight).alias("__w"))
    sums[names[0]] = current
    for name in names[1:]:
        current = current.groupBy(*levels[name]).agg(F.sum("__xw").alias("__xw"), F.sum("__w").alias("__w"))
        sums[name] = current

    def ratio(frame: DataFrame, name: str) -> DataFrame:
        value = F.coalesce(fixed(F.try_divide(F.col("__xw"), F.col("__w")), scale), F.lit(0.0))
        return frame.select(*levels[name], value.alias(name))

    out = ratio(sums[names[0]], names[0])
    for name in names[1:]:
        out = join_same(out, ratio(sums[name], name), levels[name])
    return out


def dominant(df: DataFrame, key: Sequence[str], cat: str, w: Expr, scale: int = 4) -> DataFrame:
    """Category with the highest total per key (ties: smallest category) and its share of the key's total."""
    by_cat = df.groupBy(*key, cat).agg(F.sum(_col(w)).alias("__w"))
    best = F.min(F.struct((-F.col("__w")).alias("__neg"), F.col(cat).alias("__cat"))).alias("__best")
    per_key = by_cat.groupBy(*key).agg(best, F.sum("__w").alias("__total"))
    share = fixed(F.try_divide(-F.col("__best.__neg"), F.col("__total")), scale)
    return per_key.select(*key, F.col("__best.__cat").alias(cat), share.alias("share"))


def share(df: DataFrame, key: Sequence[str], preds: Mapping[str, Column], w: Expr, scale: int = 4) -> DataFrame:
    """Share of the key's total that satisfies each predicate; 0 for none."""
    w = _col(w)
    parts = [
        F.coalesce(fixed(F.try_divide(F.sum(F.when(p, w)), F.sum(w)), scale), F.lit(0.0)).alias(name)
        for name, p in preds.items()
    ]
    return df.groupBy(*key).agg(*parts)


def latest(df: DataFrame, key: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Values of the row with the highest ``order`` per key."""
    pick = F.max_by(F.struct(*cols), F.struct(*order)).alias("__last")
    return df.groupBy(*key).agg(pick).select(*key, "__last.*")


def span(df: DataFrame, key: Sequence[str], date: str) -> DataFrame:
    day = F.col(date).cast("date")
    return df.groupBy(*key).agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"))


def rollup_chain(
    df: DataFrame,
    levels: Sequence[tuple[str, Sequence[str]]],
    sums: Mapping[str, Expr],
    ratios: Mapping[str, Column],
) -> dict[str, DataFrame]:
    """Levels from finest to coarsest, each summed from the one before; ratios are derived anew from the sums."""
    out = {}
    current = None
    for name, keys in levels:
        if current is None:
            current = df.groupBy(*keys).agg(*[F.sum(_col(e)).alias(s) for s, e in sums.items()])
        else:
            current = current.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums])
        out[name] = current.select("*", *[r.alias(n) for n, r in ratios.items()])
    return out


def with_and_without(
    df: DataFrame, keep: Column, keys: Sequence[str], aggs: Mapping[str, Column], tag: str | None = None
) -> DataFrame:
    """The full roll-up and its twin over the rows that ``keep`` admits.

    With ``tag`` each twin is labelled (2 = all rows, 1 = without atypical rows) and every twin stays. Without it, a
    twin is added only where it differs from the full result. Rows are dealt to one or both scopes, so one scan and one
    aggregate serve both.
    """
    scope = tag or "__scope"
    scopes = F.when(keep, F.array(F.lit(2), F.lit(1))).otherwise(F.array(F.lit(2)))
    both = agg(df.select("*", F.explode(scopes).alias(scope)), [*keys, scope], **aggs)
    if tag is not None:
        return both.select(*keys, *aggs, tag)
    pack = F.struct(*aggs)
    twins = both.groupBy(*keys).agg(
        F.max(F.when(F.col(scope) == 2, pack)).alias("full"), F.max(F.when(F.col(scope) == 1, pack)).alias("part")
    )
    differs = F.col("part").isNotNull() & ~F.col("part").eqNullSafe(F.col("full"))
    kept = F.when(differs, F.array("full", "part")).otherwise(F.array("full"))
    return twins.select(*keys, F.explode(kept).alias("__t")).select(*keys, "__t.*")


def band_sums(df: DataFrame, key: Sequence[str], col: str, value: Expr, bands: Mapping[str, tuple]) -> DataFrame:
    """Sum of ``value`` per band of ``col`` (bounds inclusive, ``None`` is open); 0 for an empty band."""

    def inside(lo, hi) -> Column:
        c = F.col(col)
        test = F.lit(True)
        if lo is not None:
            test = test & (c >= lo)
        return test & (c <= hi) if hi is not None else test

    return df.groupBy(*key).agg(
        *[F.coalesce(F.sum(F.when(inside(*b), _col(value))), F.lit(0.0)).alias(n) for n, b in bands.items()]
    )


def fill_from_group_max(df: DataFrame, key: Sequence[str], cols: Sequence[str], cond: Column) -> DataFrame:
    """Rows satisfying ``cond`` take the key's highest value in every listed column."""
    top = df.groupBy(*key).agg(*[F.max(c).alias(f"__m_{c}") for c in cols])
    joined = join_same(df, top, key)
    return joined.select(
        *[F.when(cond, F.col(f"__m_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def split_movements(df: DataFrame, keys: Sequence[str], qty: Expr, rules: Mapping[str, Column]) -> DataFrame:
    """Absolute quantities in one column per movement rule; 0 where a rule finds nothing."""
    size = F.abs(_col(qty))
    return df.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(rule, size)), F.lit(0.0)).alias(n) for n, rule in rules.items()]
    )


def detail_plus_summary(
    df: DataFrame, detail_keys: Sequence[str], summary_keys: Sequence[str], aggs: Mapping[str, Expr], placeholder
) -> DataFrame:
    """Detail rows and their summary in one table; keys the summary lacks hold a placeholder. Totals are sums."""
    detail = df.groupBy(*detail_keys).agg(*[F.sum(_col(e)).alias(n) for n, e in aggs.items()])
    total = detail.groupBy(*summary_keys).agg(*[F.sum(n).alias(n) for n in aggs])
    types = {f.name: f.dataType for f in detail.schema.fields}
    for k in detail_keys:
        if k not in summary_keys:
            total = total.withColumn(k, F.lit(placeholder).cast(types[k]))
    return detail.withColumn("row_kind", F.lit("detail")).unionByName(total.withColumn("row_kind", F.lit("summary")))


def with_total(df: DataFrame, part: Sequence[str], sums: Mapping[str, Expr]) -> DataFrame:
    """Partition totals on every row."""
    totals = df.groupBy(*part).agg(*[F.sum(_col(e)).alias(n) for n, e in sums.items()])
    return join_same(df, totals, part)

