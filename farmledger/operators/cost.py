"""Costing and planning operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farmledger.functions.calendar import cycle_label, in_month, rolling_months
from farmledger.functions.ratios import fixed, safe_ratio
from farmledger.operators.merge import keep_own_or_once
from farmledger.operators.reshape import pivot_case
from farmledger.operators.setops import union_all

Expr = str | Column


def _first(rules: Sequence[tuple[Column, Expr]], default) -> Column:
    out = F.lit(default) if not isinstance(default, Column) else default
    for cond, value in reversed(rules):
        out = F.when(cond, value).otherwise(out)
    return out


def journal_decode(
    journal: DataFrame, accounts: DataFrame, roles: Mapping[str, str], account_key: str, label: str
) -> DataFrame:
    """Decode several account columns of a journal with one chart of accounts: ``roles`` maps an output to a column."""
    for out, col in roles.items():
        side = accounts.select(F.col(account_key).alias("__k"), F.col(label).alias(out))
        kept = journal.columns
        journal = journal.join(side, F.col(col) == F.col("__k"), "left").select(*kept, out)
    return journal


def cost_pivot(df: DataFrame, key: Sequence[str], cols: Mapping[str, str], mapping: Mapping[str, str]) -> DataFrame:
    """Amount per cost element in columns, with the sign turned (costs are booked negative)."""
    return pivot_case(df, key, cols["element"], mapping, -F.col(cols["amount"]))


def cost_classify(df: DataFrame, rules: Mapping[str, Sequence[tuple[Column, str]]], default: str) -> DataFrame:
    """One label column per rule list; the first rule that holds decides."""
    return df.withColumns({name: _first(chain, default) for name, chain in rules.items()})


def cost_allocation_base(
    lines: DataFrame, volumes: DataFrame, entity: Sequence[str], month: str, kilos: str
) -> DataFrame:
    """Attach the month's kilos and the entity's kilos of the month to each cost line; 0 when there are none."""
    by_both = volumes.groupBy(*entity, month).agg(F.sum(kilos).alias("kilos_entity"))
    by_month = by_both.groupBy(month).agg(F.sum("kilos_entity").alias("kilos_month"))
    out = lines.join(by_both, [*entity, month], "left").join(by_month, month, "left")
    return out.select(
        *lines.columns,
        F.coalesce("kilos_entity", F.lit(0.0)).alias("kilos_entity"),
        F.coalesce("kilos_month", F.lit(0.0)).alias("kilos_month"),
    )


def cost_eliminations(
    lines: DataFrame, stock: DataFrame, cols: Mapping[str, str], month: dt.date, by_element: Sequence[str],
    out: str = "eliminated",
) -> DataFrame:
    """Cost of stock eliminated in ``month`` on that month's cost lines; 0 when there is none, NULL in other months.

    The amount is summed per cost object, and per object and element for the objects in ``by_element``. Both lookups are
    unique on their keys, so no cost line multiplies.
    """
    obj, element, amount, date = (cols[k] for k in ("object", "element", "amount", "date"))
    gone = stock.where(in_month(date, month))
    per_element = gone.groupBy(obj, element).agg(F.sum(amount).alias("__by_element"))
    per_object = per_element.groupBy(obj).agg(F.sum("__by_element").alias("__by_object"))
    joined = lines.join(per_element, [obj, element], "left").join(per_object, obj, "left")
    value = F.when(F.col(obj).isin(list(by_element)), F.col("__by_element")).otherwise(F.col("__by_object"))
    return joined.select(
        *lines.columns, F.when(in_month(date, month), F.coalesce(value, F.lit(0.0))).alias(out)
    )


def with_cycle(df: DataFrame, month: str, out: str = "cycle") -> DataFrame:
    """Closing cycle of each cost month."""
    return df.withColumn(out, cycle_label(month))


def cycle_fanout(
    df: DataFrame, month: str, cycle: str, as_of: dt.date, months: int = 12, closed: DataFrame | None = None
) -> DataFrame:
    """Publish the rows of recent months again under each later closing cycle; only new rows are added.

    Seeds are the rows that lie in the last ``months`` months and carry their own month's cycle. Each is offered under the
    cycle of every closed month from its own on, and what the recent months hold already is dropped. Rows before the
    window pass through untouched. ``month`` is the first day of the cost month; ``closed`` has the closed months in a
    column of that name (default: the recent months of ``df``), at most ``months`` + 1 and later ones.
    """
    recent = rolling_months(month, as_of, months)
    closed = df if closed is None else closed
    known = closed.where(recent).agg(F.sort_array(F.collect_set(F.col(month).cast("date"))).alias("__all")).scalar()
    day = F.col(month).cast("date")
    window = df.where(recent).withColumn("__all", known)
    later = F.transform(F.filter("__all", lambda m: m >= day), lambda m: F.struct(cycle_label(m).alias("c"), F.lit(0).alias("own")))
    seed = F.col(cycle) == cycle_label(month)
    own = F.array(F.struct(F.col(cycle).alias("c"), F.lit(1).alias("own")))
    lines = window.select("*", F.explode(F.when(seed, F.concat(own, later)).otherwise(own)).alias("__l"))
    published = lines.select(
        *[F.col("__l.c").alias(cycle) if c == cycle else F.col(c) for c in df.columns], F.col("__l.own").alias("__own")
    )
    history = df.where(F.col(month).isNull() | ~recent)
    return history.unionByName(keep_own_or_once(published, df.columns, "__own"))


def current_extract(df: DataFrame, month: str, as_of: dt.date, months_back: int) -> DataFrame:
    """Rows from the month ``months_back`` before ``as_of`` on."""
    return df.where(rolling_months(month, as_of, months_back))


def ledger_extract_union(df: DataFrame, criteria: Sequence[tuple[str, Column]], tag: str, cols: Sequence[str]) -> DataFrame:
    """UNION ALL of several ledger extracts of one table, each labelled.

    A line that satisfies several criteria appears once per criterion. The labels of a line are gathered in an array
    and exploded, so the table is scanned once and not once per extract.
    """
    hits = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in criteria]), lambda x: x.isNotNull())
    any_of = criteria[0][1]
    for _, c in criteria[1:]:
        any_of = any_of | c
    return df.where(any_of).select(*cols, F.explode(hits).alias(tag))


def sales_standardise(df: DataFrame, mapping: Mapping[str, Expr], date: str) -> DataFrame:
    """Project invoice lines to the profitability layout, with year and month of the posting date."""
    return df.select(
        *[(F.col(e) if isinstance(e, str) else e).alias(n) for n, e in mapping.items()],
        F.year(date).alias("year"),
        F.month(date).alias("month"),
    )


def expense_per_unit(
    df: DataFrame, keys: Sequence[str], total_keys: Sequence[str], amount: str, units: str, label: str = "TOTAL",
    scale: int = 4,
) -> DataFrame:
    """Expense per unit by group, and the subtotal rows of the coarser keys in the same table."""
    fine = df.groupBy(*keys).agg(F.sum(amount).alias("amount"), F.sum(units).alias("units"))
    coarse = fine.groupBy(*total_keys).agg(F.sum("amount").alias("amount"), F.sum("units").alias("units"))
    coarse = coarse.withColumns({k: F.lit(label) for k in keys if k not in total_keys})
    both = fine.unionByName(coarse)
    return both.select(
        *keys,
        fixed("amount", 2).alias("amount"),
        fixed("units", 2).alias("units"),
        safe_ratio("amount", "units", scale).alias("per_unit"),
    )


def weighted_period_price(
    df: DataFrame, article: str, date: str, price: str, qty: str, scale: int = 4
) -> DataFrame:
    """Quantity-weighted price per article and month."""
    month = F.date_format(date, "yyyyMM").alias("month_id")
    return df.groupBy(article, month).agg(
        fixed(F.try_divide(F.sum(F.col(price) * F.col(qty)), F.sum(qty)), scale).alias("price"),
        F.sum(qty).alias("quantity"),
    )


def revalue_split(
    df: DataFrame, date: str, cutover: dt.date, before: Mapping[str, Sequence[tuple[Column, Expr]]],
    after: Mapping[str, Sequence[tuple[Column, Expr]]],
) -> DataFrame:
    """Different revaluation rules before and from a cutover date; rows without a date are revalued as before.

    The two branches of one table become one pass: each rule is guarded by its side of the cutover.
    """
    late = F.coalesce(F.col(date) >= F.lit(dt.datetime(cutover.year, cutover.month, cutover.day)).cast("timestamp_ntz"), F.lit(False))
    columns = {}
    for name in {**before, **after}:
        rules = [(late & c, v) for c, v in after.get(name, [])] + [(~late & c, v) for c, v in before.get(name, [])]
        columns[name] = _first(rules, F.col(name))
    return df.withColumns(columns)


def latest_closed_month(df: DataFrame, closed_on: str, event: str) -> DataFrame:
    """Rows whose event lies in the year and month of the latest close date."""
    last = df.agg(F.trunc(F.max(closed_on).cast("date"), "month").alias("__m")).scalar()
    # the bare column on one side, so that the bounds can reach the scan
    return df.where((F.col(event) >= last) & (F.col(event) < F.add_months(last, 1)))


def measure_rows(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Different measures as rows of one table, labelled; columns a measure lacks are NULL."""
    return union_all(*[df.withColumn(tag, F.lit(name)) for name, df in frames.items()], fill_missing=True)
