"""Date expressions. Every one takes the reporting date as an argument; none reads the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date the source systems store for "not set", and the origin of numbered days.
DATE_SENTINEL = dt.date(1899, 11, 30)
DAY_EPOCH = dt.date(1900, 1, 1)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _shift(day: dt.date, months: int) -> dt.date:
    index = day.year * 12 + day.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


def month_start(as_of: dt.date, months_back: int = 0) -> dt.date:
    """First day of the month ``months_back`` before the month of ``as_of``."""
    return _shift(as_of, -months_back)


def previous_month(as_of: dt.date) -> dt.date:
    """First day of the month before ``as_of``."""
    return _shift(as_of, -1)


def _boundary(day: dt.date) -> Column:
    # A timestamp literal leaves the bare column on the other side, so the comparison reaches the Parquet reader.
    return F.lit(dt.datetime(day.year, day.month, day.day)).cast("timestamp_ntz")


def in_month(c: str | Column, month: dt.date) -> Column:
    """The date lies in the month of ``month``, as a half-open range on the bare column."""
    c = _col(c)
    return (c >= _boundary(_shift(month, 0))) & (c < _boundary(_shift(month, 1)))


def in_month_range(c: str | Column, lo: dt.date, hi: dt.date) -> Column:
    """The date lies in the months ``lo``..``hi``, as a half-open range on the bare column."""
    c = _col(c)
    return (c >= _boundary(_shift(lo, 0))) & (c < _boundary(_shift(hi, 1)))


def rolling_months(c: str | Column, as_of: dt.date, months: int) -> Column:
    """The month of the date is not older than ``months`` before the month of ``as_of``; open above."""
    return _col(c) >= _boundary(month_start(as_of, months))


def from_year_start(c: str | Column, as_of: dt.date, months: int) -> Column:
    """From 1 January of the year that contains ``as_of`` minus ``months`` months."""
    return _col(c) >= _boundary(dt.date(_shift(as_of, -months).year, 1, 1))


def age_days(event: str | Column, birth: str | Column, sentinel: dt.date = DATE_SENTINEL) -> Column:
    """Days from birth to event; 0 when the birth date is missing or the sentinel."""
    birth = _col(birth).cast("date")
    known = birth.isNotNull() & (birth != F.lit(sentinel))
    return F.when(known, F.datediff(_col(event).cast("date"), birth)).otherwise(F.lit(0))


def week_of_life(day: str | Column) -> Column:
    """Days 1-7 are week 1, 8-14 week 2, and so on."""
    return F.floor((_col(day) + 6) / 7).cast("int")


def age_week_decimal(day: str | Column) -> Column:
    """Age as weeks with the remaining days in the first decimal place."""
    day = _col(day)
    return F.round(F.round(day / 7, 0) + (day % 7) / 10, 1)


def cycle_label(month: str | Column) -> Column:
    """Closing cycle of a cost month: ``C`` and the number of the month that follows."""
    return F.concat(F.lit("C"), F.date_format(F.add_months(_col(month).cast("date"), 1), "MM"))


def day_number(ts: str | Column, markers: tuple[tuple[int, int, int], ...], epoch: dt.date = DAY_EPOCH) -> Column:
    """Day number since ``epoch``; any time of day after midnight counts as the next day, except the marker times."""
    ts = _col(ts)
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    marked = clock.isin([h * 3600 + m * 60 + s for h, m, s in markers])
    bump = F.when(marked | (clock == 0), 0).otherwise(1)
    return F.datediff(ts.cast("date"), F.lit(epoch)) + bump
