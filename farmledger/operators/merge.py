"""Incremental loads: change capture, period replacement, column updates, reconciliation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from farmledger.functions.calendar import _shift, month_start

Expr = str | Column


def _col(c: Expr) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_change(changes: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """One row per key: the change with the highest ``order_col``, ties broken by the whole row."""
    rest = [c for c in changes.columns if c not in (*keys, order_col)]
    newest = F.max(F.struct(order_col, *rest)).alias("__row")
    return changes.groupBy(*keys).agg(newest).select(*keys, "__row.*").select(*changes.columns)


def cdc_apply(
    target: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    flag: str,
    initial: str = "all_but_deletes",
    order_col: str | None = None,
) -> DataFrame:
    """Apply I/U/D rows to ``target``; keys may be composite.

    With a target, rows whose flag is blank or NULL (an initial extract) are ignored. Without one, the result is the
    first load: every row that is not a delete, or with ``initial="blank_only"`` only the rows of the initial extract.
    With ``order_col`` the last change of a key wins; without it all changes of a key are kept.
    """
    mark = F.coalesce(F.upper(F.trim(F.col(flag))), F.lit(""))
    if target is None:
        keep = mark == "" if initial == "blank_only" else mark != "D"
        if order_col is not None:
            changes = latest_change(changes, keys, order_col)
        return changes.where(keep).drop(flag)
    changes = changes.where(mark.isin("I", "U", "D"))
    if order_col is not None:
        changes = latest_change(changes, keys, order_col)
    dropped = changes.where(mark.isin("U", "D")).select(*keys)
    added = changes.where(mark.isin("I", "U")).drop(flag).select(*target.columns)
    return target.join(dropped, list(keys), "left_anti").select(*target.columns).unionByName(added)


def _outside(c: Column, lo: Column, hi: Column | None) -> Column:
    inside = (c >= lo) if hi is None else (c >= lo) & (c < hi)
    return c.isNull() | ~inside


def _boundary(day: dt.date) -> Column:
    return F.lit(dt.datetime(day.year, day.month, day.day)).cast("timestamp_ntz")


def replace_range(
    target: DataFrame, source: DataFrame, date_col: str | None, lo: dt.date | None = None, hi: dt.date | None = None
) -> DataFrame:
    """Target rows of the months ``lo``..``hi`` give way to the source rows of those months; the rest stays.

    Rows without a date are outside every range. A table without a date column is reloaded whole.
    """
    if date_col is None:
        return source
    low, high = _boundary(_shift(lo, 0)), (None if hi is None else _boundary(_shift(hi, 1)))
    c = F.col(date_col)
    kept = target.where(_outside(c, low, high))
    fresh = source.where(~_outside(c, low, high)).select(*target.columns)
    return kept.unionByName(fresh)


def replace_rolling(target: DataFrame, source: DataFrame, date_col: str, as_of: dt.date, months: int) -> DataFrame:
    """As :func:`replace_range`, from the first day of the month ``months`` before ``as_of``, open above."""
    return replace_range(target, source, date_col, month_start(as_of, months), None)


def new_rows(target: DataFrame, candidate: DataFrame) -> DataFrame:
    """The distinct candidate rows that the target does not hold yet; NULLs compare equal.

    The target is only probed, neither regrouped nor rewritten; give the part of it (the months, say) that the candidate
    can meet.
    """
    fresh = candidate.select(*target.columns).distinct().alias("c")
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"t.{c}")) for c in target.columns]
    return fresh.join(target.alias("t"), same, "left_anti")


def append_new(target: DataFrame, candidate: DataFrame) -> DataFrame:
    """Target plus the distinct candidate rows that it does not hold yet; a job appends :func:`new_rows` only."""
    return target.unionByName(new_rows(target, candidate))


def one_per_key(df: DataFrame, key: Sequence[str], cols: Sequence[str], latest: str | None = None) -> DataFrame:
    """One row per key: the one with the highest ``latest``, then with the highest ``cols`` in their order."""
    row = F.struct(*([latest] if latest else []), *[c for c in cols if c != latest])
    best = df.groupBy(*key).agg(F.max(row).alias("__row"))
    return best.select(*key, *[F.col(f"__row.{c}").alias(c) for c in cols])


def keep_own_or_once(df: DataFrame, cols: Sequence[str], own: str) -> DataFrame:
    """Rows equal in ``cols`` come out as often as ``own`` is 1 among them, or once when it never is."""
    counted = df.groupBy(*cols).agg(F.sum(own).alias("__n"))
    return counted.select(*cols, F.explode(F.sequence(F.lit(1), F.greatest("__n", F.lit(1)).cast("int"))).alias("__i")).drop("__i")


def update_from(
    df: DataFrame, lookup: DataFrame, on: Sequence[str], cols: Mapping[str, str], guard: Column | None = None
) -> DataFrame:
    """Overwrite ``cols`` (target name -> lookup name) where the key matches and ``guard`` holds.

    Of several lookup rows with one key the one with the highest values counts; ``guard`` speaks about the target's columns.
    """
    lookup = one_per_key(lookup, on, list(dict.fromkeys(cols.values())))
    side = lookup.select(
        *[F.col(k).alias(f"__k_{k}") for k in on],
        *[F.col(src).alias(f"__n_{dst}") for dst, src in cols.items()],
        F.lit(True).alias("__matched"),
    )
    cond = [F.col(k) == F.col(f"__k_{k}") for k in on]
    hit = F.col("__matched").isNotNull()
    if guard is not None:
        hit = hit & F.coalesce(guard, F.lit(False))
    joined = df.join(side, cond, "left")
    return joined.select(
        *[F.when(hit, F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns]
    )


def rewrite_when(df: DataFrame, rules: Mapping[str, Sequence[tuple[Column, Expr]]]) -> DataFrame:
    """Replace a column by the value of the first condition that holds; otherwise leave it. One pass, no join."""

    def chain(name: str, branches: Sequence[tuple[Column, Expr]]) -> Column:
        (cond, value), *rest = branches
        out = F.when(cond, value)
        for cond, value in rest:
            out = out.when(cond, value)
        return out.otherwise(F.col(name))

    return df.withColumns({name: chain(name, branches) for name, branches in rules.items()})


def reconciled_load(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], flag: str, store: Callable[[DataFrame], None],
    order_col: str | None = None,
) -> DataFrame:
    """Apply the changes, hand the result to ``store``, and return one row with the counts before, of each kind and after.

    The target and the result are counted while ``store`` writes, so the merge runs once; only the changes, which are few,
    are read again.
    """
    mark = F.coalesce(F.upper(F.trim(F.col(flag))), F.lit(""))
    before, after = Observation(), Observation()
    merged = cdc_apply(target.observe(before, F.count(F.lit(1)).alias("n")), changes, keys, flag, order_col=order_col)
    store(merged.observe(after, F.count(F.lit(1)).alias("n")))
    kinds = {"rows_inserted": "I", "rows_updated": "U", "rows_deleted": "D"}
    counts = changes.agg(*[F.count_if(mark == kind).alias(name) for name, kind in kinds.items()])
    return counts.select(
        F.lit(before.get["n"]).cast("long").alias("rows_before"), *kinds, F.lit(after.get["n"]).cast("long").alias("rows_after")
    )
