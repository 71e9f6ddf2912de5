"""Gap filling, standard curves and extrapolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from farmledger.functions.ratios import fixed
from farmledger.operators.joins import lookahead_max
from farmledger.operators.ordered import cumulate, previous, row_number

Expr = str | Column


def densify_tail(
    df: DataFrame, key: Sequence[str], grp: Sequence[str], day: str, carry: Sequence[str], zero: Sequence[str],
    flag: str = "flag",
) -> DataFrame:
    """Add rows to entities that stop before their group does, up to the group's last day.

    Added rows carry the entity's last values in ``carry`` (of several rows on its last day the highest), 0 in ``zero``, 2 in
    ``flag`` (1 for real rows) and NULL in every other column. The day may be a number or a date. Missing days come from a generated sequence per entity, not from a join with all days.
    """
    is_date = isinstance(df.schema[day].dataType, DateType)
    held = [c for c in (*grp, *carry) if c not in key]
    last = df.groupBy(*key).agg(
        F.max(day).alias("__last"), F.max_by(F.struct(*held, F.lit(0).alias("__pad")), F.struct(day, *held)).alias("__held")
    ).select(*key, "__last", *[F.col(f"__held.{c}").alias(c) for c in held])
    end = last.groupBy(*grp).agg(F.max("__last").alias("__end"))
    start = F.date_add("__last", 1) if is_date else F.col("__last") + 1
    short = last.join(end, list(grp)).where(F.col("__last") < F.col("__end"))
    added = short.select(*key, *held, F.explode(F.sequence(start, F.col("__end"))).alias(day), F.lit(2).alias(flag))
    types = {f.name: f.dataType for f in df.schema.fields}
    added = added.select("*", *[F.lit(0).cast(types[c]).alias(c) for c in zero])
    real = df.select("*", F.lit(1).alias(flag))
    return real.unionByName(added.withColumn(day, F.col(day).cast(types[day])), allowMissingColumns=True)


def cap_standard(df: DataFrame, key: Sequence[str], age: str, cols: Sequence[str], limit: int, pred: Column) -> DataFrame:
    """Ages beyond ``limit`` take the values at ``limit`` where ``pred`` holds and such values exist."""
    at = df.where(F.col(age) == limit).groupBy(*key).agg(*[F.max(c).alias(f"__c_{c}") for c in cols])
    late = (F.col(age) > limit) & pred
    joined = df.join(at, list(key), "left")
    return joined.select(
        *[
            F.when(late, F.coalesce(F.col(f"__c_{c}"), F.col(c))).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
            for c in df.columns
        ]
    )


def carry_last_valid(df: DataFrame, key: Sequence[str], day: str, col: str, after: int) -> DataFrame:
    """Past day ``after``, zero or missing values take the key's last value that is neither (of one day the highest)."""
    valid = F.coalesce(F.col(col), F.lit(0)) != 0
    last = df.where(valid).groupBy(*key).agg(F.max_by(col, F.struct(day, col)).alias("__last"))
    filled = F.when((F.col(day) > after) & ~valid, F.coalesce("__last", F.col(col))).otherwise(F.col(col))
    return df.join(last, list(key), "left").select(
        *[filled.alias(col) if c == col else F.col(c) for c in df.columns]
    )


def extrapolate_linear(
    df: DataFrame, key: Sequence[str], day: str, col: str, out: str
) -> DataFrame:
    """Continue a curve past its last known day by its last daily increment.

    The curve ends the day before its first zero. A zero at position p gets ``last + p x (last - day before)``; a curve
    without two known points before the zero keeps its values. Days are unique within a key.
    """
    first_zero = df.where(F.col(col) == 0).groupBy(*key).agg(F.min(day).alias("__z"))
    marked = df.join(first_zero, list(key), "left")
    ends = marked.groupBy(*key).agg(
        F.max(F.when(F.col(day) == F.col("__z") - 1, F.col(col))).alias("__a"),
        F.max(F.when(F.col(day) == F.col("__z") - 2, F.col(col))).alias("__b"),
    )
    zeros = row_number(df.where(F.col(col) == 0).select(*key, day), key, [day], [], "__p")
    extended = F.coalesce(F.col("__a") + (F.col("__a") - F.col("__b")) * F.col("__p"), F.col(col))
    return (
        df.join(ends, list(key), "left")
        .join(zeros, [*key, day], "left")
        .select(*df.columns, F.when(F.col(col) == 0, extended).otherwise(F.col(col)).alias(out))
    )


def growth_rate(
    df: DataFrame, key: Sequence[str], day: str, val: str, scale: int = 4
) -> DataFrame:
    """Daily gain between successive readings: difference of values over difference of days, 0 on the first.

    Zero readings are left out, and a value that repeats counts on its first day only.
    """
    daily = df.groupBy(*key, day).agg(F.sum(val).alias("reading")).where(F.col("reading") != 0)
    first = daily.groupBy(*key, "reading").agg(F.min(day).alias(day))
    seq = previous(first, key, [day], [], {"__pv": "reading", "__pd": F.col(day)})
    diff, days = F.col("reading") - F.col("__pv"), F.col(day) - F.col("__pd")
    return seq.select(
        *key, day, "reading",
        fixed(F.coalesce(diff, F.lit(0.0)), scale).alias("difference"),
        F.coalesce(days, F.lit(0)).cast("int").alias("days_between"),
        F.coalesce(fixed(F.try_divide(diff, days), scale), F.lit(0.0)).alias("daily_gain"),
    )


def cum_standard(df: DataFrame, key: Sequence[str], day: str, col: str, out: str) -> DataFrame:
    """Cumulative percentage of a daily standard."""
    return cumulate(df, key, [day], [], {out: ("sum", col)})


def weekly_reading_fill(df: DataFrame, key: Sequence[str], day: str, col: str, n: int, weigh_day: Column, out: str) -> DataFrame:
    """A weigh day that reads 0 takes the best reading of the ``n`` days after it."""
    seen = lookahead_max(df, key, day, col, n, "__best")
    return seen.select(*df.columns, F.when(weigh_day & (F.col(col) == 0), F.col("__best")).otherwise(F.col(col)).alias(out))


def backfill_from_group(df: DataFrame, key: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    """A missing attribute takes the smallest value that a sibling of the same group has."""
    known = df.where(F.col(col).isNotNull()).groupBy(*key).agg(F.min(col).alias("__known"))
    filled = F.coalesce(F.col(col), F.col("__known"))
    joined = df.join(known, list(key), "left")
    if out is None:
        return joined.select(*[filled.alias(c) if c == col else F.col(c) for c in df.columns])
    return joined.select(*df.columns, filled.alias(out))
