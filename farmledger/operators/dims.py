"""Dimensions: members, surrogate keys, lookups, refresh."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farmledger.operators.merge import one_per_key, update_from
from farmledger.session import scratch_path

Expr = str | Column


def build_dimension(src: DataFrame, cols: Sequence[str], default_row: Mapping[str, Any]) -> DataFrame:
    """Distinct business keys and the default member."""
    members = src.select(*cols).distinct()
    default = _one_row(members, default_row)
    return members.unionByName(default).distinct()


def _one_row(like: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    one = like.sparkSession.range(1)
    return one.select(*[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def assign_sk(
    df: DataFrame, order_cols: Sequence[str], sk: str, start: int | Column = 1, path: str | None = None
) -> DataFrame:
    """Number the members 1, 2, 3, ... in the order of their business key, without a single-task sort.

    The members are range-partitioned and sorted once and written to the shared scratch folder, which fixes which
    member lies in which range. A member's number is its position in its range plus the members of earlier ranges; that
    sum runs over one row per range. ``order_cols`` have to identify a member. ``path`` names the folder to write to; the
    caller then removes it once the result is stored.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "ranked")
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    (
        df.repartitionByRange(*[F.col(c) for c in order_cols])
        .sortWithinPartitions(*order_cols)
        .select("*", F.spark_partition_id().alias("__range"), position.alias("__pos"))
        .write.parquet(path)
    )
    ranked = spark.read.parquet(path)
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranked.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    start = F.lit(start) if isinstance(start, int) else start
    number = F.col("__pos") + F.col("__before") + start
    return ranked.join(offsets, "__range").select(*df.columns, number.cast("long").alias(sk))


def extend_sk(target: DataFrame, source: DataFrame, nk: Sequence[str], sk: str) -> DataFrame:
    """Known members keep their key; new ones are numbered after the highest key in use.

    Of several source rows for a new member the one with the highest attributes counts.
    """
    rest = [c for c in target.columns if c not in (sk, *nk)]
    fresh = one_per_key(source, nk, rest) if rest else source.select(*nk).distinct()
    fresh = fresh.join(target.select(*nk), list(nk), "left_anti")
    top = target.agg(F.coalesce(F.max(sk), F.lit(0)).cast("long").alias("__top")).scalar()
    numbered = assign_sk(fresh, nk, sk)
    numbered = numbered.withColumn(sk, F.col(sk) + top)
    return target.withColumn(sk, F.col(sk).cast("long")).unionByName(numbered.select(*target.columns))


def star_lookup(fact: DataFrame, lookups: Sequence[tuple[DataFrame, Mapping[str, str], str, Column]]) -> DataFrame:
    """Left join each dimension and fall back to its default member; of members with one natural key the highest counts.

    A lookup is (dimension, {fact column: dimension column}, key to fetch, predicate of the default member). Only the
    join columns and the key of the dimension are read; the default is one scalar subquery per dimension.
    """
    for dim, on, sk, is_default in lookups:
        default = dim.where(is_default).agg(F.max(sk).alias("__default")).scalar()
        side = dim.select(*[F.col(d).alias(f"__d_{f}") for f, d in on.items()], F.col(sk).alias("__sk"))
        side = one_per_key(side, [f"__d_{f}" for f in on], ["__sk"])
        cond = [F.col(f) == F.col(f"__d_{f}") for f in on]
        kept = fact.columns
        fact = fact.join(side, cond, "left").select(*kept, F.coalesce("__sk", default).alias(sk))
    return fact


def merge_dim(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All source members, and the target members the source does not know."""
    kept = target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(source.select(*target.columns))


def scd1_refresh(
    dim: DataFrame, src: DataFrame, key: Sequence[str], cols: Sequence[str], guard: Column | None = None
) -> DataFrame:
    """Overwrite attributes from the source for the members that ``guard`` admits."""
    return update_from(dim, src, key, {c: c for c in cols}, guard)


def enum_dim(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Fixed members given as literals."""
    return spark.createDataFrame(list(rows), schema)


def repair_date(text: Expr, year: Expr, month: Expr, day: Expr) -> Column:
    """The date written in ``text``; when that is malformed, the date made of its parts."""
    text = F.col(text) if isinstance(text, str) else text
    parts = F.format_string("%04d-%02d-%02d", *[F.col(p).cast("int") if isinstance(p, str) else p.cast("int") for p in (year, month, day)])
    return F.coalesce(text.try_cast("date"), parts.try_cast("date"))


def calendar_attributes(df: DataFrame, day: str) -> DataFrame:
    """Year, month, quarter and week labels and ids of a date column."""
    d = F.col(day)
    return df.select(
        "*",
        F.date_format(d, "yyyyMMdd").cast("int").alias("day_id"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "yyyyMM").alias("month_id"),
        F.concat(F.lit("T"), F.quarter(d).cast("string")).alias("quarter_label"),
        F.concat(F.lit("W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0")).alias("week_label"),
    )


def calendar(spark: SparkSession, lo: dt.date, hi: dt.date) -> DataFrame:
    """One row per day from ``lo`` to ``hi``."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("day"))
    return calendar_attributes(days, "day")


def calendar_of(df: DataFrame, day: str) -> DataFrame:
    """One row per day between the first and the last date of a column."""
    ends = df.agg(F.min(F.col(day)).cast("date").alias("__lo"), F.max(F.col(day)).cast("date").alias("__hi"))
    days = ends.where(F.col("__lo").isNotNull()).select(F.explode(F.sequence("__lo", "__hi")).alias("day"))
    return calendar_attributes(days, "day")


def age_dim(df: DataFrame, age: Column) -> DataFrame:
    """Distinct ages in days from 0 on, with their code (two digits at least), label and week of life (week 1 is day 0)."""
    days = df.select(age.alias("age_day")).where("age_day >= 0").distinct()
    text = F.col("age_day").cast("string")
    code = F.concat(F.lit("D"), F.when(F.col("age_day") > 9, text).otherwise(F.concat(F.lit("0"), text)))
    week = F.when(F.col("age_day") == 0, F.lit(1)).otherwise((F.ceil(F.col("age_day") / 7) + 1).cast("int"))
    return days.select("age_day", code.alias("age_code"), F.concat(F.lit("Dia "), text).alias("age_label"), week.alias("age_week"))


def priority_union(dfs: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Rows of the first source, then of each later one only those whose key no earlier source holds.

    The sources are tagged with their rank and the rows of the lowest rank of each key stay, so each source is scanned
    twice however many there are. A key with a NULL equals no other key: its rows all stay.
    """
    cols = dfs[0].columns
    tagged = [df.select(*cols, F.lit(k).alias("__rank")) for k, df in enumerate(dfs)]
    every, *rest = tagged
    for df in rest:
        every = every.unionByName(df)
    named = [F.col(k).isNotNull() for k in key]
    whole = named[0]
    for c in named[1:]:
        whole = whole & c
    first = every.where(whole).groupBy(*key).agg(F.min("__rank").alias("__first"))
    joined = every.join(first, list(key), "left")
    return joined.where(F.col("__first").isNull() | (F.col("__rank") == F.col("__first"))).select(*cols)


def regroup(df: DataFrame, col: str, mapping: Mapping[str, Sequence], default: str, out: str) -> DataFrame:
    """Group label by code list."""
    (label, codes), *rest = mapping.items()
    group = F.when(F.col(col).isin(list(codes)), label)
    for label, codes in rest:
        group = group.when(F.col(col).isin(list(codes)), label)
    return df.withColumn(out, group.otherwise(F.lit(default)))


def campaign_sequence(df: DataFrame, part: Sequence[str], order: Sequence[Expr], start: str, end: str) -> DataFrame:
    """Number the campaigns within a house and put this campaign's first and the previous one's last date on each row.

    ``order`` is a date or another value with few distinct entries per house.
    """
    from farmledger.operators.joins import lag_join
    from farmledger.operators.ordered import dense_rank

    ranked = dense_rank(df, part, order, [], "campaign")
    dates = ranked.groupBy(*part, "campaign").agg(
        F.min(start).alias("campaign_start"), F.max(end).alias("campaign_end")
    )
    gaps = lag_join(dates, part, "campaign", {"previous_end": "campaign_end"})
    return ranked.join(gaps, [*part, "campaign"], "left")
