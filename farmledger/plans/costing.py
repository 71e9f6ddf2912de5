"""Costing and planning jobs built from the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farmledger.functions import fixed, month_start, previous_month, safe_ratio
from farmledger.operators import cost, dims, gaps, joins, reshape
from farmledger.operators import agg as A
from farmledger.operators.merge import replace_rolling, update_from
from farmledger.operators.ordered import cumulate

SALTS = 64


def live_bird_cost(
    journal: DataFrame, accounts: DataFrame, stock: DataFrame, published: DataFrame | None,
    roles: Mapping[str, str], rules: Mapping[str, Sequence[tuple[Column, str]]], cols: Mapping[str, str],
    by_element: Sequence, as_of: dt.date,
) -> DataFrame:
    """Cost lines decoded and classified, with last month's eliminations, replacing last month in the published table."""
    decoded = cost.journal_decode(journal, accounts, roles, "account", "account_name")
    classified = cost.cost_classify(decoded, rules, "OTROS")
    lines = cost.cost_eliminations(classified, stock, cols, previous_month(as_of), by_element)
    return lines if published is None else replace_rolling(published, lines, cols["date"], as_of, 1)


def cost_indicators(
    journal: DataFrame, volumes: DataFrame, key: Sequence[str], month: str, cols: Mapping[str, str],
    elements: Mapping[str, str],
) -> DataFrame:
    """Cost per kilo of each cost element, one row per entity, month and indicator."""
    wide = cost.cost_pivot(journal, [*key, month], cols, elements)
    kilos = volumes.groupBy(*key, month).agg(F.sum("kilos").alias("kilos"))
    names = list(dict.fromkeys(elements.values()))
    long = reshape.unpivot(wide, [*key, month], names, "indicator", "amount")
    joined = long.join(kilos, [*key, month], "left")
    return joined.select(
        *key, month, "indicator", fixed("amount", 2).alias("amount"), safe_ratio("amount", "kilos").alias("per_kilo")
    )


def cost_structure(
    lines: DataFrame, entity: Sequence[str], month: str, amount: str, kilos: Column, as_of: dt.date, months: int = 12
) -> DataFrame:
    """Cost per entity and month with its kilos, published under the closing cycle and again under every later one.

    One aggregate makes the costs and the kilos. The kilos of all months, one number each, come as a scalar of a second,
    narrow pass; they also say which months are closed. A row of a recent month is repeated for the closing cycles from its
    own on, a cycle once; older rows keep their own.
    """
    closed = lines.groupBy(month).agg(F.sum(kilos).alias("__k")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(month), F.coalesce("__k", F.lit(0.0))))).alias("__all")
    ).scalar()
    by_entity = lines.groupBy(*entity, month).agg(F.sum(amount).alias("amount"), F.coalesce(F.sum(kilos), F.lit(0.0)).alias("__k"))
    unit = by_entity.withColumn("__closed", closed).select(
        *entity, month, fixed("amount", 2).alias("amount"), fixed("__k", 2).alias("kilos_entity"),
        safe_ratio("amount", "__k").alias("unit_cost"), safe_ratio("__k", F.element_at("__closed", F.col(month)), 6).alias("share"), "__closed",
    )
    recent = F.lit(month_start(as_of, months))
    own = F.array(cost.cycle_label(F.col(month)))
    later = F.filter(F.map_keys("__closed"), lambda m: (m >= F.col(month)) & (m >= recent))
    cycles = F.when(F.col(month) >= recent, F.array_union(own, F.transform(later, cost.cycle_label))).otherwise(own)
    return unit.withColumn("cycle", F.explode(cycles)).drop("__closed")


def current_structure(structure: DataFrame, month: str, as_of: dt.date) -> DataFrame:
    return cost.current_extract(structure, month, as_of, 1)


def layer_journal(journal: DataFrame, capitalised: DataFrame, keep: Column) -> DataFrame:
    """Layer cost lines with the capitalisation date of their lot."""
    return joins.push_down(journal.where(keep), capitalised, ["lot"], ["capitalised_on"])


def commercial_plan(
    sales: DataFrame, cutover: dt.date, before: Mapping, after: Mapping, prices: DataFrame
) -> DataFrame:
    """Sales lines with the period price of their article, revalued before and after the cutover."""
    priced = update_from(sales, prices, ["article", "month_id"], {"price": "price"})
    return cost.revalue_split(priced, "posted_on", cutover, before, after)


def production_detail(
    readings: DataFrame, lookups, categories: DataFrame, curve: DataFrame, transfers: DataFrame, std_after: int
) -> DataFrame:
    """Readings with dimension keys, the house's category list, cumulative standard and the destination's attributes.

    Houses and days of a breed are few and hold many readings, so both are joined with the readings dealt by lot.
    """
    keyed = dims.star_lookup(readings, lookups)
    listed = A.agg_string_list(categories, ["house"], "category", "categories")
    valid = gaps.carry_last_valid(curve, ["breed"], "age", "std", std_after)
    cumulative = cumulate(valid, ["breed"], ["age"], [], {"std_so_far": ("sum", "std")})
    out = joins.salted_join(keyed, listed, ["house"], ["lot"], SALTS)
    out = joins.salted_join(out, cumulative, ["breed", "age"], ["lot"], SALTS)
    return joins.reattribute(out, transfers, "lot", {"house": "new_house"})


def conformed_dimension(published: DataFrame | None, source: DataFrame, nk: Sequence[str], sk: str) -> DataFrame:
    """A dimension whose known members keep their key; the source's attributes win."""
    if published is None:
        return dims.assign_sk(source, nk, sk)
    extended = dims.extend_sk(published.select(*nk, sk), source.select(*nk), nk, sk)
    current = source.join(extended, list(nk)).select(*published.columns)
    return dims.merge_dim(published.withColumn(sk, F.col(sk).cast("long")), current, nk)


def commercial_measures(
    lines: DataFrame, sale: Column, expense: Column, closed_on: str, keys: Sequence[str]
) -> DataFrame:
    """The plan's measure rows: sales and expense per unit of the latest closed month of each, and stock, each tagged ``obs``.

    The latest months of both come from one narrow pass, all measures from one conditional aggregate.
    """
    at = F.trunc(closed_on, "month")
    last = lines.agg(F.struct(F.max(F.when(sale, at)).alias("sale"), F.max(F.when(expense, at)).alias("expense")).alias("__m")).scalar()
    lines = lines.withColumn("__last", last).withColumn("__at", at)
    sold, spent = (cond & (F.col("__at") == F.col(f"__last.{name}")) for cond, name in ((sale, "sale"), (expense, "expense")))

    def total(cond: Column, c: str) -> Column:
        return F.sum(F.when(cond, F.col(c)))

    wide = lines.groupBy(*keys).agg(
        F.count_if(sold).alias("__sold"), F.count_if(spent).alias("__spent"), fixed(total(sold, "amount"), 2).alias("__amount"),
        total(sold, "quantity").alias("__quantity"), safe_ratio(total(spent, "amount"), total(spent, "quantity")).alias("__per_unit"),
        F.sum("heads").alias("__heads"),
    )
    none = F.lit(None).cast("double")

    def row(obs: str, cond: Column, **held: str) -> Column:
        values = [F.col(held[c]) if c in held else none for c in ("amount", "quantity", "per_unit", "heads")]
        fields = [v.cast("double").alias(c) for v, c in zip(values, ("amount", "quantity", "per_unit", "heads"), strict=True)]
        return F.when(cond, F.struct(F.lit(obs).alias("obs"), *fields))

    rows = F.array(
        row("sales", F.col("__sold") > 0, amount="__amount", quantity="__quantity"), row("expense", F.col("__spent") > 0, per_unit="__per_unit"),
        row("stock", F.lit(True), heads="__heads"),
    )
    return wide.select(*keys, F.inline(F.filter(rows, lambda r: r.isNotNull())))
