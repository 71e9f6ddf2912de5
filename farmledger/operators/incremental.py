"""Measures kept up to date from stored state: a run reads what is new and what it touches, not the history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farmledger.functions.calendar import month_start
from farmledger.operators.cost import cycle_label
from farmledger.operators.joins import join_same
from farmledger.operators.ordered import cumulate

Expr = str | Column


def _col(c: Expr) -> Column:
    return F.col(c) if isinstance(c, str) else c


def closing_balances(df: DataFrame, keys: Sequence[str], month: str, sums: Mapping[str, Expr], before: DataFrame | None = None) -> DataFrame:
    """(keys, month, sums): the running totals of each key at the end of each month in which it moves.

    ``before`` holds the balances of earlier months; with it ``df`` needs the later months only. A key's months are few, so
    the window over them is small whatever the number of rows.
    """
    moved = df.groupBy(*keys, month).agg(*[F.sum(_col(e)).alias(o) for o, e in sums.items()])
    if before is not None:
        moved = moved.unionByName(opening_balances(before, keys, month, list(sums)))
    w = Window.partitionBy(*keys).orderBy(F.asc_nulls_first(month)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = moved.select(*keys, month, *[F.sum(o).over(w).alias(o) for o in sums])
    return out if before is None else out.where(F.col(month).isNotNull())


def opening_balances(balances: DataFrame, keys: Sequence[str], month: str, sums: Sequence[str], until: dt.date | None = None) -> DataFrame:
    """Each key's last balance, of months before ``until``; its ``month`` is null, as it opens whatever follows."""
    rows = balances if until is None else balances.where(F.col(month) < F.lit(until))
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*sums), month).alias("__last"))
    return last.select(*keys, F.lit(None).cast(balances.schema[month].dataType).alias(month), *[F.col(f"__last.{s}").alias(s) for s in sums])


def cumulate_on(
    window: DataFrame, balances: DataFrame, keys: Sequence[str], order: Sequence[Expr], slices: Sequence[Expr], month: str,
    sums: Mapping[str, Expr], since: dt.date,
) -> DataFrame:
    """Running totals of the rows since ``since`` that carry on from the balances of the months before it.

    Equal to the totals over the whole history, of which only one row a key is read. ``window`` holds the rows since then;
    ``balances`` come from :func:`closing_balances`.
    """
    run = cumulate(window, keys, order, slices, {o: ("sum", e) for o, e in sums.items()})
    opened = opening_balances(balances, keys, month, list(sums), since).drop(month).withColumnsRenamed({s: f"__open_{s}" for s in sums})
    met = join_same(run, opened, keys)
    total = [F.when(F.col(f"__open_{s}").isNull(), F.col(s)).otherwise(F.coalesce(F.col(s), F.lit(0)) + F.col(f"__open_{s}")).alias(s) for s in sums]
    return met.select(*window.columns, *total)


def change_sums(before: DataFrame, after: DataFrame, keys: Sequence[str], sums: Mapping[str, Expr]) -> DataFrame:
    """(keys, sums, n_rows): by how much each key's sums change when the rows ``before`` become ``after``.

    Give exact numbers (whole or decimal): sums that are added to and taken from must come out even.
    """

    def signed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*keys, *[(_col(e) * sign).alias(o) for o, e in sums.items()], F.lit(sign).cast("long").alias("n_rows"))

    both = signed(before, -1).unionByName(signed(after, 1))
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*sums, "n_rows")])


def rollup_changes(change: DataFrame, levels: Sequence[tuple[str, Sequence[str]]], sums: Sequence[str]) -> dict[str, DataFrame]:
    """The change of each level, each summed from the one before, finest first; keys whose sums stay as they are drop out."""
    out, current = {}, change
    for name, keys in levels:
        current = current.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*sums, "n_rows")])
        moved = F.col("n_rows") != 0
        for s in sums:
            moved = moved | (F.coalesce(F.col(s), F.lit(0)) != 0)
        out[name] = current.where(moved)
    return out


def merge_level(published: DataFrame, change: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """New rows of the keys that change: published sums plus the change; a key whose rows are all gone has no row.

    The published table is only probed for those keys. Replace the partitions they lie in, or the keys themselves.
    """
    held = join_same(change.select(*keys), published, keys, "inner").select(*keys, *sums, "n_rows")
    merged = held.unionByName(change.select(*keys, *sums, "n_rows")).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*sums, "n_rows")])
    return merged.where("n_rows > 0")


def distinct_by_level(df: DataFrame, levels: Sequence[tuple[str, Sequence[str]]], number: str, out: str) -> dict[str, DataFrame]:
    """Exact distinct counts of a whole number at several levels, finest first, from one scan: each from the level before.

    ``number`` is not negative (nulls do not count) and should be dense, as surrogate keys are. A key of a fine level meets few
    numbers, so (key, number) pairs are handed on; only the coarsest level, whose keys meet most of them, holds bitmaps, of
    32,768 bits for every range of that many numbers. They are built and counted where a range's pairs meet, so none is shuffled.
    """
    current, counted = df.where(F.col(number).isNotNull()), {}
    for name, keys in levels[: max(1, len(levels) - 1)]:
        current = current.select(*keys, number).distinct()
        counted[name] = current.groupBy(*keys).agg(F.count(number).alias(out))
    if len(levels) > 1:
        name, keys = levels[-1]
        pairs = current.select(*keys, number, F.bitmap_bucket_number(number).alias("__range")).repartition(*keys, "__range")
        bits = pairs.groupBy(*keys, "__range").agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("__bits"))
        counted[name] = bits.groupBy(*keys).agg(F.sum(F.bitmap_count("__bits")).alias(out))
    return counted


def missing_cycles(closed: DataFrame, published: DataFrame, month: str, cycle: str, as_of: dt.date, months: int = 12) -> DataFrame:
    """(month, cycle) pairs of the recent closed months that are not published yet: a month under each cycle from its own on.

    ``closed`` has the closed months, ``published`` the pairs published so far; both a few rows (the pairs of a table
    partitioned by them come from its partitions).
    """
    recent = F.col(month) >= F.lit(month_start(as_of, months))
    known = closed.where(recent).select(month).distinct()
    later = known.select(F.col(month).alias("__later"))
    pairs = known.withColumn("__one", F.lit(1)).join(later.withColumn("__one", F.lit(1)), "__one").where(F.col("__later") >= F.col(month))
    wanted = pairs.select(month, cycle_label("__later").alias(cycle)).distinct()
    return wanted.join(published.select(month, cycle).distinct(), [month, cycle], "left_anti")


def publish_missing(unit: DataFrame, missing: DataFrame, month: str, cycle: str) -> DataFrame:
    """The rows to append: the lines of each month under each cycle that it lacks. Nothing published is read or rewritten."""
    return unit.join(F.broadcast(missing), month).select(*unit.columns, cycle)  # at most (months + 1)^2 pairs
