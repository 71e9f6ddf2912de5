"""Running totals, row numbers, ranks and previous values that do not need one task per key.

A plain window sends all rows of a key to one task, which fails when one key holds a large part of the table. Here
each key's timeline is cut into *slices*: one or more expressions that never decrease along the ordering (a month for
a date, a range of ids within one day, ...). The work then takes the form of an account statement:

1. every (key, slice) is reduced to one row by an ordinary two-phase aggregate;
2. a window over those few rows yields the balance brought forward into each slice;
3. the balance enters the slice as an opening line, and a window over (key, slice) carries on from it.

The rows are shuffled once, on (key, slice), as often as a plain window would shuffle them on the key alone. NULL keys
behave as in a window, because no join is involved. ``order`` is ascending; negate an expression to descend. For a
row-wise frame ``order`` has to be total, and a slice may depend on leading order expressions only.

A frame with at most one row per key and day (or age, week, month) needs no slices: the calendar bounds every group to a
few thousand rows. Aggregate to that grain first where the measure allows it, then leave ``slices`` empty; the result is
one plain window and the input is evaluated once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Expr = str | Column

_AGG = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}
_CARRY = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.sum}


def _col(c: Expr) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clock_slices(ts: Expr, unit: str = "minute") -> list[Column]:
    """Slice a timestamp ordering by day, hour or minute.

    The finer the unit, the smaller the largest group: a key with a third of a month's rows is spread over 720 hours or
    43,200 minutes. The parts are separate columns because truncating a zone-less timestamp would go through the
    session's time zone.
    """
    ts = _col(ts)
    parts = {"day": ts.cast("date"), "hour": F.hour(ts), "minute": F.minute(ts)}
    names = list(parts)
    return [parts[n] for n in names[: names.index(unit) + 1]]


def width_slice(value: Expr, width: float) -> Column:
    """Slice a numeric ordering into ranges of equal width."""
    return F.floor(_col(value) / F.lit(width))


class _Sliced:
    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[Expr], slices: Sequence[Expr]):
        self.columns = df.columns
        self.keys = list(keys)
        self.o = [f"__o{i}" for i in range(len(order))]
        self.s = [f"__s{i}" for i in range(len(slices))]
        self.base = df.select(
            "*",
            *[_col(c).alias(n) for c, n in zip(order, self.o)],
            *[_col(c).alias(n) for c, n in zip(slices, self.s)],
            F.lit(1).alias("__line"),
        )

    def per_slice(self, rows: DataFrame, *aggregates: Column) -> DataFrame:
        return rows.groupBy(*self.keys, *self.s).agg(*aggregates)

    def before(self):
        return Window.partitionBy(*self.keys).orderBy(*self.s).rowsBetween(Window.unboundedPreceding, -1)

    def opened(self, rows: DataFrame, opening: DataFrame) -> DataFrame:
        lines = opening.withColumn("__line", F.lit(0))
        return rows.unionByName(lines, allowMissingColumns=True)

    def inside(self):
        return Window.partitionBy(*self.keys, *self.s).orderBy("__line", *self.o)

    def finish(self, df: DataFrame, outs: Sequence[str]) -> DataFrame:
        return df.where(F.col("__line") == 1).select(*self.columns, *outs)


def cumulate(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Expr],
    slices: Sequence[Expr],
    measures: Mapping[str, tuple[str, Expr]],
    frame: str = "rows",
    exclude_current: bool = False,
) -> DataFrame:
    """Running aggregates: ``measures`` maps an output name to ``("sum" | "max" | "min" | "count", expression)``.

    ``frame="range"`` gives rows with equal order values the same total. ``exclude_current`` stops at the row before.
    """
    end = -1 if exclude_current else Window.currentRow

    def framed(w):
        if frame == "range":
            return w.rangeBetween(Window.unboundedPreceding, end)
        return w.rowsBetween(Window.unboundedPreceding, end)

    if not slices:
        w = framed(Window.partitionBy(*keys).orderBy(*order))
        return df.select("*", *[_AGG[k](_col(e)).over(w).alias(o) for o, (k, e) in measures.items()])
    sl = _Sliced(df, keys, order, slices)
    rows = sl.base.select(
        "*",
        *[
            (F.when(_col(e).isNotNull(), 1).otherwise(0) if kind == "count" else _col(e)).alias(f"__v_{out}")
            for out, (kind, e) in measures.items()
        ],
    )
    kinds = {out: ("sum" if kind == "count" else kind) for out, (kind, _) in measures.items()}
    totals = sl.per_slice(rows, *[_AGG[k](f"__v_{o}").alias(f"__v_{o}") for o, k in kinds.items()])
    opening = totals.select(
        *sl.keys, *sl.s, *[_CARRY[k](f"__v_{o}").over(sl.before()).alias(f"__v_{o}") for o, k in kinds.items()]
    )
    w = framed(sl.inside())
    out = sl.opened(rows, opening).select("*", *[_AGG[k](f"__v_{o}").over(w).alias(o) for o, k in kinds.items()])
    return sl.finish(out, list(kinds))


def cumulate_peers(
    df: DataFrame, keys: Sequence[str], order: str, measures: Mapping[str, tuple[str, Expr]]
) -> DataFrame:
    """Running aggregates in which rows with equal ``order`` (a day, a week, an age) share the total up to that value.

    The rows are aggregated to (key, order) first, so the window sees one row per key and calendar step however many
    rows a day holds; the totals return to the rows by a join, whose hot partitions can be split.
    """
    values = df.select(*keys, order, *[_col(e).alias(f"__v_{o}") for o, (_, e) in measures.items()])
    per = values.groupBy(*keys, order).agg(*[_AGG[k](f"__v_{o}").alias(f"__v_{o}") for o, (k, _) in measures.items()])
    kinds = {o: ("sum" if k == "count" else k, f"__v_{o}") for o, (k, _) in measures.items()}
    run = cumulate(per, keys, [order], [], kinds).select(*keys, order, *measures)
    side = run.withColumnsRenamed({c: f"__j_{c}" for c in (*keys, order)})
    same = [F.col(c).eqNullSafe(F.col(f"__j_{c}")) for c in (*keys, order)]
    return df.join(side, same, "left").select(*df.columns, *measures)


def row_number(df: DataFrame, keys: Sequence[str], order: Sequence[Expr], slices: Sequence[Expr], out: str) -> DataFrame:
    """Position of the row within its key."""
    return cumulate(df, keys, order, slices, {out: ("sum", F.lit(1))})


def dense_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Expr], slices: Sequence[Expr], out: str) -> DataFrame:
    """Rank without gaps; equal order values share a rank.

    Only the distinct order values of a key are ranked, so rows that tie cost nothing; the ranks return to the rows by a
    join, whose hot partitions can be split. Leave ``slices`` empty when the order is a date, age or week.
    """
    names, cuts = [f"__rank{i}" for i in range(len(order))], [f"__cut{i}" for i in range(len(slices))]
    stamped = df.select("*", *[_col(c).alias(n) for c, n in zip(order, names)])
    values = df.select(
        *keys, *[_col(c).alias(n) for c, n in zip(order, names)], *[_col(c).alias(n) for c, n in zip(slices, cuts)]
    ).distinct()
    ranked = row_number(values, keys, names, cuts, out).select(*keys, *names, F.col(out).cast("int").alias(out))
    side = ranked.withColumnsRenamed({c: f"__j_{c}" for c in (*keys, *names)})
    same = [F.col(c).eqNullSafe(F.col(f"__j_{c}")) for c in (*keys, *names)]
    return stamped.join(side, same, "left").select(*df.columns, out)


def previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[Expr], slices: Sequence[Expr], cols: Mapping[str, Expr]
) -> DataFrame:
    """Values of the row before within the key; NULL on the first row."""
    if not slices:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[F.lag(_col(e)).over(w).alias(o) for o, e in cols.items()])
    sl = _Sliced(df, keys, order, slices)
    rows = sl.base.withColumn("__pack", F.struct(*[_col(e).alias(o) for o, e in cols.items()]))
    last = sl.per_slice(rows, F.max_by("__pack", F.struct(*sl.o)).alias("__pack"))
    by_slice = Window.partitionBy(*sl.keys).orderBy(*sl.s)
    opening = last.select(*sl.keys, *sl.s, F.lag("__pack").over(by_slice).alias("__pack"))
    out = sl.opened(rows, opening).select("*", F.lag("__pack").over(sl.inside()).alias("__prev"))
    out = out.select("*", *[F.col(f"__prev.{o}").alias(o) for o in cols])
    return sl.finish(out, list(cols))
