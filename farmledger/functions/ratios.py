"""Ratios that yield zero, not an error, on an empty denominator."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from farmledger.functions.calendar import DAY_EPOCH


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed(c: str | Column, scale: int = 4) -> Column:
    """Round half up as a decimal of eight places, so the noise of a floating-point sum cannot decide a tie."""
    return F.round(_col(c).cast("decimal(30,8)"), scale).cast("double")


def safe_ratio(x: str | Column, y: str | Column, scale: int = 4) -> Column:
    return F.coalesce(fixed(F.try_divide(_col(x), _col(y)), scale), F.lit(0.0))


def safe_pct(x: str | Column, y: str | Column, scale: int = 4) -> Column:
    return F.coalesce(fixed(F.try_divide(_col(x), _col(y)) * 100, scale), F.lit(0.0))


def per_thousand(x: str | Column, heads: str | Column, scale: int = 4) -> Column:
    return F.coalesce(fixed(F.try_divide(_col(x) * 1000, _col(heads)), scale), F.lit(0.0))


def wavg(x: str | Column, w: str | Column) -> Column:
    """Aggregate: mean of ``x`` weighted by ``w``; NULL when the weights sum to zero."""
    return F.try_divide(F.sum(_col(x) * _col(w)), F.sum(_col(w)))


def wavg_nonzero(x: str | Column, w: str | Column) -> Column:
    """Aggregate: weighted mean over the readings that are not zero, so a missing reading carries no weight."""
    x, w = _col(x), _col(w)
    return F.try_divide(F.sum(x * w), F.sum(F.when(x != 0, w)))


def wavg_date(day: str | Column, w: str | Column, epoch: dt.date = DAY_EPOCH) -> Column:
    """Aggregate: head-weighted mean date, floored to a whole day."""
    offset = F.datediff(_col(day).cast("date"), F.lit(epoch))
    return F.date_add(F.lit(epoch), F.floor(wavg(offset, w)).cast("int"))


def efficiency_index(mort_pct: Column, weight: Column, age: Column, conversion: Column, scale: int = 4) -> Column:
    """((100 - mortality %) x weight) / (age x conversion) x 100, zero when age or conversion is zero."""
    return F.coalesce(fixed(F.try_divide((F.lit(100) - mort_pct) * weight, age * conversion) * 100, scale), F.lit(0.0))


def adjusted_conversion(weight: Column, conversion: Column, ref: Column, divisor: Column, scale: int = 4) -> Column:
    """Feed conversion moved to a reference weight."""
    return fixed((ref - weight) / divisor + conversion, scale)
