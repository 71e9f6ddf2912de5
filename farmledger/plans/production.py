"""Production jobs: from daily field readings to mortality, weight, feed, sales, hatchery, breeder and lot figures.

Each job takes frames with these columns and returns frames:

* field days: ``zone, lot, house, pen, day, age`` (days since placement), ``deaths, kilos, feed`` and cause columns;
* heads: initial population per pen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farmledger.functions import (
    age_days,
    day_number,
    fixed,
    per_thousand,
    rolling_months,
    safe_pct,
    safe_ratio,
    wavg_date,
    week_of_life,
)
from farmledger.operators import agg as A
from farmledger.operators import dims, gaps, joins, kpi, reshape
from farmledger.operators.merge import replace_rolling
from farmledger.operators.ordered import cumulate, previous
from farmledger.operators.setops import union_all

PEN = ["zone", "lot", "house", "pen"]
LEVELS = [("pen", PEN), ("house", ["zone", "lot", "house"]), ("lot", ["zone", "lot"])]


def daily_field_detail(
    readings: DataFrame, entities: DataFrame, farms: DataFrame, transfers: DataFrame, as_of: dt.date, months: int = 9
) -> DataFrame:
    """Readings of the last months with their entity, farm, age and, for moved entities, the destination.

    Only the first transfer of a (source, destination) pair counts, and only for readings up to its date.
    """
    recent = readings.where(rolling_months("event_date", as_of, months))
    first_move = transfers.groupBy("entity", "destination").agg(F.min("moved_on").alias("moved_on"))
    detail = recent.join(entities, "entity").join(farms, "farm")
    moved = joins.join_where(detail, first_move, ["entity"], F.col("a.event_date") <= F.col("b.moved_on"), "left")
    return moved.select(
        *detail.columns,
        age_days("event_date", "placed").alias("age"),
        F.coalesce("destination", "entity").alias("destination"),
        F.when(F.col("destination").isNull(), 0).otherwise(1).alias("moved"),
    )


def mortality_daily(days: DataFrame) -> DataFrame:
    """Deaths per pen and age with running and weekly totals; pens that stop early
    are carried to the lot's last age with the total reached by their last week."""
    placed = days.select(*PEN, "age", "deaths").repartition(*PEN)  # the days of a pen lie together from here on
    daily = placed.groupBy(*PEN, "age").agg(F.sum("deaths").alias("deaths"))
    daily = daily.withColumn("week", week_of_life("age"))
    # A pen has one row per day of life, so plain windows serve; all three share the shuffle on the pen and, as days follow
    # one another within weeks, one sort by week and day.
    by_week = Window.partitionBy(*PEN, "week")
    run = cumulate(daily, PEN, ["week", "age"], [], {"deaths_so_far": ("sum", "deaths")})
    run = cumulate(run, PEN, ["week"], [], {"deaths_to_week": ("sum", "deaths")}, frame="range")
    full = run.withColumn("deaths_week", F.sum("deaths").over(by_week))
    dense = gaps.densify_tail(
        full.drop("week"), PEN, ["zone", "lot"], "age", ["deaths_to_week"], ["deaths", "deaths_week", "deaths_so_far"]
    )
    return dense.withColumn("week", week_of_life("age"))


def mortality_causes(days: DataFrame, causes: Sequence[str], keys: Sequence[str], n: int = 3) -> DataFrame:
    """Leading causes of death per key and week of life."""
    weekly = days.withColumn("week", week_of_life("age")).groupBy(*keys, "week").agg(*[F.sum(c).alias(c) for c in causes])
    long = reshape.unpivot(weekly, [*keys, "week"], causes, "cause", "deaths", drop_zero=True)
    return reshape.top_n_others(long, [*keys, "week"], "cause", "deaths", n, unique=True)


def mortality_levels(days: DataFrame, heads: DataFrame, typical: Column) -> DataFrame:
    """Deaths and mortality per pen, house and lot, each with its twin without atypical rows (scope 2 = all, 1 = without)."""
    placed = heads.groupBy(*PEN).agg(F.max("heads").alias("heads"))
    pens = A.with_and_without(days, typical, PEN, {"deaths": F.sum("deaths")}, tag="scope").join(placed, PEN)
    chain = A.rollup_chain(
        pens, [(name, [*keys, "scope"]) for name, keys in LEVELS], {"deaths": "deaths", "heads": "heads"},
        {"mort_pct": safe_pct("deaths", "heads", 4)},
    )
    return union_all(*[df.withColumn("level", F.lit(name)) for name, df in chain.items()], fill_missing=True)


def weight_weekly(days: DataFrame, weeks: Mapping[int, str], weigh: Column, slot: Column, ahead: int = 2) -> DataFrame:
    """Weigh-day weights per pen; a weigh day without weight takes the best of the next days.

    ``weigh`` tells weigh days by ``age``; ``slot`` is the number of a row's column in ``weeks``, from its ``week`` of life.
    """
    daily = days.groupBy(*PEN, "age").agg(F.max("weight").alias("weight"))
    filled = gaps.weekly_reading_fill(daily, PEN, "age", "weight", ahead, weigh, "filled")
    weighed = filled.where(weigh).withColumn("week", week_of_life("age")).withColumn("slot", slot)
    return reshape.pivot_case(weighed, PEN, "slot", weeks, "filled")


def weight_gain(days: DataFrame) -> DataFrame:
    """Daily gain between successive weights of a pen."""
    return gaps.growth_rate(days, PEN, "age", "weight")


def feed_by_type(
    use: DataFrame, key: Sequence[str], feed_types: Mapping[str, str]
) -> DataFrame:
    """Feed per day in one column per feed type, with a running total of each and of all."""
    wide = reshape.pivot_case(use, [*key, "age"], "feed_type", feed_types, "kilos")
    names = list(dict.fromkeys(feed_types.values()))
    total = use.groupBy(*key, "age").agg(F.sum("kilos").alias("kilos"))
    joined = wide.join(total, [*key, "age"])
    measures = {f"{n}_so_far": ("sum", n) for n in [*names, "kilos"]}
    return cumulate(joined, key, ["age"], [], measures)


def feed_lists(use: DataFrame, key: Sequence[str]) -> DataFrame:
    """Formulas an entity was fed, as one text."""
    return A.agg_string_list(use, key, "formula", "formulas")


def sales_running(loads: DataFrame, transfers: DataFrame) -> DataFrame:
    """Heads and kilos sold per pen and day with running totals; loads of a moved lot count for its destination."""
    moved = joins.reattribute(loads, transfers, "lot", {"house": "new_house"})
    daily = moved.groupBy("zone", "lot", "house", "pen", "day").agg(F.sum("heads").alias("heads"), F.sum("kilos").alias("kilos"))
    return cumulate(
        daily, PEN, ["day"], [], {"heads_so_far": ("sum", "heads"), "kilos_so_far": ("sum", "kilos")}
    )


def sales_age(loads: DataFrame) -> DataFrame:
    """Head-weighted age at sale on pen, house and lot level, one row per pen."""
    levels = {"age_pen": PEN, "age_house": ["zone", "lot", "house"], "age_lot": ["zone", "lot"]}
    return A.rollup_levels(loads, levels, "age", "heads")


def breeder_running(days: DataFrame, cols: Sequence[str]) -> dict[str, DataFrame]:
    """Running totals restarted by production phase, at pen, house and lot level."""
    out, current = {}, days
    for name, keys in LEVELS:
        current = current.groupBy(*keys, "phase", "day").agg(*[F.sum(c).alias(c) for c in cols])
        out[name] = cumulate(
            current, [*keys, "phase"], ["day"], [], {f"{c}_so_far": ("sum", c) for c in cols}
        )
    return out


def breeder_indicators(house: DataFrame) -> DataFrame:
    """Daily house indicators: mortality and viability by stage denominator, feed per head and its change from day before."""
    base = kpi.kpi_stage_denominator(
        house.withColumn("alive", F.col("intake") - F.col("deaths_so_far")),
        {"stage": "phase", "intake": "intake", "capitalised": "capitalised"},
        1,
        {"mort_pct": "deaths_so_far", "viability_pct": "alive"},
        2,
    )
    grams = base.withColumn("grams", fixed(F.try_divide(F.col("feed") * 1000, F.col("alive")), 2))
    grams = grams.withColumn("grams", F.coalesce("grams", F.lit(0.0)))
    key = ["zone", "lot", "house", "phase"]
    seq = previous(grams, key, ["day"], [], {"__before": "grams"})
    change = fixed(F.coalesce(F.col("grams") - F.col("__before"), F.lit(0.0)), 2)
    return seq.select(*base.columns, "grams", change.alias("grams_change"))


def placement(intake: DataFrame, category: str, parent_age: str) -> DataFrame:
    """Placement per house: heads, mean placement date, leading origin with its share, weighted parent age, origin list."""
    key = ["zone", "lot", "house"]
    totals = intake.groupBy(*key).agg(
        F.sum("heads").alias("heads"),
        wavg_date("day", "heads").alias("placed_on"),
        fixed(F.try_divide(F.sum(F.col(parent_age) * F.col("heads")), F.sum("heads"))).alias("parent_age"),
    )
    lead = A.dominant(intake, key, category, "heads").withColumnRenamed("share", "origin_share")
    origins = A.agg_string_list(intake, key, category, "origins")
    return totals.join(lead, key).join(origins, key)


def intake_consolidated(
    intake: DataFrame, published: DataFrame | None, keys: Sequence[str], as_of: dt.date, horizon: int = 9, months: int = 4
) -> DataFrame:
    """Intake per key over the horizon, merged into the published table by replacing the last months."""
    fresh = intake.where(rolling_months("event_date", as_of, horizon)).groupBy(*keys).agg(
        F.min("event_date").alias("event_date"), F.sum("heads").alias("heads")
    )
    return fresh if published is None else replace_rolling(published, fresh, "event_date", as_of, months)


def consolidated(
    days: DataFrame, heads: DataFrame, loads: DataFrame, rules: Sequence[tuple[Column, float, float]],
    default: tuple[float, float],
) -> DataFrame:
    """Pen, house and lot figures: mortality, mean weight, conversion, adjusted conversion, sale age, efficiency index.

    Every level is summed from the one below and its ratios are derived from the sums.
    """
    produced = days.groupBy(*PEN).agg(F.sum("deaths").alias("deaths"), F.sum("feed").alias("feed"))
    sold = loads.groupBy(*PEN).agg(
        F.sum("heads").alias("sold"), F.sum("kilos").alias("kilos"), F.sum(F.col("age") * F.col("heads")).alias("age_heads")
    )
    placed = heads.groupBy(*PEN).agg(F.max("heads").alias("heads"))
    zero = {c: F.coalesce(c, F.lit(0.0)) for c in ("deaths", "feed", "sold", "kilos", "age_heads")}
    pens = placed.join(produced, PEN, "left").join(sold, PEN, "left").withColumns(zero)
    ratios = {
        "mort_pct": safe_pct("deaths", "heads", 4),
        "weight": safe_ratio("kilos", "sold", 4),
        "conversion": safe_ratio("feed", "kilos", 4),
        "sale_age": safe_ratio("age_heads", "sold", 4),
    }
    sums = {c: c for c in ("heads", "deaths", "feed", "sold", "kilos", "age_heads")}
    chain = A.rollup_chain(pens, LEVELS, sums, ratios)
    levels = union_all(*[df.withColumn("level", F.lit(n)) for n, df in chain.items()], fill_missing=True)
    cols = {"mort_pct": "mort_pct", "weight": "weight", "age": "sale_age", "conversion": "conversion"}
    levels = kpi.kpi_adjusted_conversion(levels, cols, rules, default)
    return kpi.kpi_efficiency_index(levels, cols)


def consumption_daily(
    use: DataFrame, heads: DataFrame, bands: Mapping[str, tuple]
) -> tuple[DataFrame, DataFrame]:
    """Running use per 1000 placed, per pen and age, and use per band of weeks."""
    daily = use.groupBy(*PEN, "age").agg(F.sum("kilos").alias("kilos"))
    run = cumulate(daily, PEN, ["age"], [], {"kilos_so_far": ("sum", "kilos")})
    with_heads = joins.push_down(run, heads, PEN, ["heads"])
    per = kpi.kpi_per_thousand_by_state(with_heads, {"quantity": "kilos_so_far"}, [], "heads")
    weekly = A.band_sums(daily.withColumn("week", week_of_life("age")), PEN, "week", "kilos", bands)
    return per, weekly


def hatchery(hatches: DataFrame, std: DataFrame) -> DataFrame:
    """Hatch results per parent lot and day against the standard of the flock's age in weeks, rounded up."""
    daily = hatches.groupBy("lot", "breed", "day").agg(
        F.sum("set_eggs").alias("set_eggs"), F.sum("hatched").alias("hatched"), F.max("flock_age").alias("flock_age")
    )
    daily = daily.withColumn("hatch_pct", safe_pct("hatched", "set_eggs", 4))
    cols = {"age": "flock_age", "std_age": "std_age", "actual": "hatch_pct", "standard": "std_hatch_pct"}
    return kpi.kpi_vs_standard(daily, std, ["breed"], cols)


def standards(curves: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Standard curves in which a day without any value takes the curve's highest values."""
    total = F.lit(0.0)
    for c in cols:
        total = total + F.coalesce(F.col(c), F.lit(0.0))
    return A.fill_from_group_max(curves, ["curve"], cols, total == 0)


def utilities(placements: DataFrame, use: DataFrame, factors: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Gas, litter and water per 1000 heads; entity codes are matched without regard to case and blanks."""
    clean = F.upper(F.trim(F.col("entity")))
    return kpi.kpi_use_per_thousand(
        placements.withColumn("entity", clean), use.withColumn("entity", clean), "entity",
        {"heads": "heads", "product": "product", "quantity": "quantity"}, factors,
    )


def mortality_monthly(days: DataFrame, typical: Column) -> DataFrame:
    """Deaths and pens per zone and month, with the twin without atypical rows (scope 2 = all, 1 = without)."""
    monthly = days.withColumn("month_id", F.date_format("day", "yyyyMM"))
    aggs = {"deaths": F.sum("deaths"), "pens": F.count_distinct(F.struct("lot", "house", "pen"))}
    return A.with_and_without(monthly, typical, ["zone", "month_id"], aggs, tag="scope")


def mortality_lot_week(days: DataFrame) -> DataFrame:
    """Deaths per lot and week of life with the running total; lots that end early are carried to the zone's last week."""
    weekly = days.groupBy("zone", "lot", week_of_life("age").alias("week")).agg(F.sum("deaths").alias("deaths"))
    run = cumulate(weekly, ["zone", "lot"], ["week"], [], {"deaths_so_far": ("sum", "deaths")})
    return gaps.densify_tail(run, ["zone", "lot"], ["zone"], "week", ["deaths_so_far"], ["deaths"])


def mortality_causes_running(days: DataFrame, causes: Sequence[str], keys: Sequence[str], n: int = 3) -> DataFrame:
    """Leading causes per key by all deaths up to each week of life."""
    weekly = days.groupBy(*keys, week_of_life("age").alias("week")).agg(*[F.sum(c).alias(c) for c in causes])
    totals = {c: ("sum", c) for c in causes}
    run = cumulate(weekly.withColumnsRenamed({c: f"__{c}" for c in causes}), keys, ["week"], [], {c: ("sum", f"__{c}") for c in totals})
    long = reshape.unpivot(run, [*keys, "week"], causes, "cause", "deaths", drop_zero=True)
    return reshape.top_n_others(long, [*keys, "week"], "cause", "deaths", n, unique=True)


def sales_detail(
    loads: DataFrame, spans: DataFrame, key: Sequence[str], markers: tuple[tuple[int, int, int], ...]
) -> DataFrame:
    """Loads with the campaign they fall into, their age by the day-number rule and a missing product filled from the lot.

    ``loads`` has ``loaded_at`` and ``product``; ``spans`` has ``lot``, ``lo`` and ``hi`` (zone-less timestamps).
    """
    placed = joins.interval_join(loads, spans, key, "loaded_at", "lo", "hi")
    aged = placed.withColumn("age", day_number("loaded_at", markers) - day_number("lo", markers))
    return gaps.backfill_from_group(aged, ["lot"], "product")


def breeder_weekly(days: DataFrame, curve: DataFrame, cap: int, capped: Column) -> DataFrame:
    """House figures per week: deaths, feed, change from exactly the week before, and the standard held past its last age."""
    key = ["zone", "lot", "house"]
    weekly = days.groupBy(*key, "breed", week_of_life("age").alias("week")).agg(
        F.sum("deaths").alias("deaths"), F.sum("feed").alias("feed")
    )
    seq = joins.lag_join(weekly, [*key, "breed"], "week", {"feed_before": "feed"})
    std = gaps.cap_standard(curve, ["breed"], "week", ["std"], cap, capped)
    met = seq.join(std, ["breed", "week"], "left")
    return met.select(
        *weekly.columns, F.coalesce(F.col("feed") - F.col("feed_before"), F.lit(0.0)).alias("feed_change"), "std"
    )


def period_totals(days: DataFrame, keys: Sequence[str], period: str, sums: Sequence[str]) -> DataFrame:
    """Sums of a level by day of life, week of life or calendar month, with the totals reached so far.

    ``period`` is ``age``, ``week`` or ``month_id``; a level has one row for each of its periods before anything is windowed.
    """
    at = {"age": F.col("age"), "week": week_of_life("age"), "month_id": F.date_format("day", "yyyyMM")}[period]
    totals = days.groupBy(*keys, at.alias(period)).agg(*[F.sum(c).alias(c) for c in sums])
    return cumulate(totals, keys, [period], [], {f"{c}_so_far": ("sum", c) for c in sums})


def mortality_causes_levels(days: DataFrame, causes: Sequence[str], n: int = 3) -> DataFrame:
    """Leading causes per week of life at pen, house and lot level."""
    frames = [mortality_causes(days, causes, keys, n).withColumn("level", F.lit(name)) for name, keys in LEVELS]
    return union_all(*frames, fill_missing=True)


def breeder_liquidation(days: DataFrame, keys: Sequence[str] = ("zone", "lot")) -> DataFrame:
    """Closing figures per lot or house: last day of each pen, and the pens' closing ages weighted by their heads."""
    totals = days.groupBy(*PEN).agg(F.sum("deaths").alias("deaths"))
    last = A.latest(days, PEN, ["age"], ["age", "day"]).withColumnRenamed("day", "closed_on")
    return (
        totals.join(last, PEN)
        .groupBy(*keys)
        .agg(
            F.max("closed_on").alias("closed_on"),
            F.sum("deaths").alias("deaths"),
            fixed(F.try_divide(F.sum(F.col("age") * F.col("deaths")), F.sum("deaths"))).alias("closing_age"),
        )
    )


def consolidated_daily(days: DataFrame, heads: DataFrame) -> DataFrame:
    """Pen and day: deaths, birds at the start of the day (needs the day before) and the day's mortality of the start."""
    daily = days.groupBy(*PEN, "age").agg(F.sum("deaths").alias("deaths"))
    balance = kpi.opening_balance(joins.push_down(daily, heads, PEN, ["heads"]), PEN, "age", "deaths", "heads")
    return balance.withColumn("mort_pct", safe_pct("deaths", "opening", 4))


def consolidated_monthly(loads: DataFrame) -> DataFrame:
    """Lots closed per zone and month of their last load, with ratios derived from the sums."""
    lots = loads.groupBy("zone", "lot").agg(
        F.max("day").alias("closed_on"), F.sum("heads").alias("sold"), F.sum("kilos").alias("kilos"),
        F.sum(F.col("age") * F.col("heads")).alias("age_heads"),
    )
    return lots.groupBy("zone", F.date_format("closed_on", "yyyyMM").alias("month_id")).agg(
        F.count(F.lit(1)).alias("lots"),
        F.sum("sold").alias("sold"),
        fixed(F.try_divide(F.sum("kilos"), F.sum("sold"))).alias("weight"),
        fixed(F.try_divide(F.sum("age_heads"), F.sum("sold"))).alias("sale_age"),
    )


def idle_days(lots: DataFrame, house: Sequence[str], start: str, end: str) -> DataFrame:
    """Days a house stood empty before each campaign (NULL before the first), on every lot of the campaign."""
    seq = dims.campaign_sequence(lots, house, [start], start, end)
    return seq.withColumn("idle_days", F.datediff("campaign_start", "previous_end"))


def weighted_standards_weeks(days: DataFrame, heads: DataFrame, curve: DataFrame) -> DataFrame:
    """Pen and week of life: the week's standard weighted by heads on pen, house and lot level, for every week that has days."""
    present = days.select(*PEN, "breed", week_of_life("age").alias("week")).distinct()
    rows = joins.push_down(present, heads, PEN, ["heads"]).join(curve, ["breed", "week"], "left")
    rows = rows.withColumn("std", F.coalesce("std", F.lit(0.0)))
    levels = {f"std_{name}": [*keys, "week"] for name, keys in LEVELS}
    return A.rollup_levels(rows, levels, "std", "heads", nonzero=True)


def weighted_standards(days: DataFrame, heads: DataFrame, curve: DataFrame, weeks: Mapping[int, str]) -> DataFrame:
    """Standard of selected weeks weighted by heads on pen, house and lot level; weeks without a standard carry no weight.

    Pens without a day in one of these weeks have no row; :func:`weighted_standards_weeks` has all weeks.
    """
    long = weighted_standards_weeks(days.where(week_of_life("age").isin(list(weeks))), heads, curve)
    return long.groupBy(*PEN).agg(
        *[
            F.coalesce(F.max(F.when(F.col("week") == w, F.col(f"std_{name}"))), F.lit(0.0)).alias(f"std_{name}_{label}")
            for w, label in weeks.items()
            for name, _ in LEVELS
        ]
    )


def water_use(placements: DataFrame, use: DataFrame, shipped: DataFrame, per_head: Column, scale: int = 4) -> DataFrame:
    """Water per 1000 heads for the entities ``per_head`` admits, per 1000 kilos shipped for all others."""
    quantity = use.groupBy("entity").agg(F.sum("quantity").alias("quantity"))
    kilos = shipped.groupBy("entity").agg(F.sum("kilos").alias("kilos"))
    joined = placements.join(quantity, "entity", "left").join(kilos, "entity", "left")
    base = F.when(per_head, F.col("heads")).otherwise(F.coalesce("kilos", F.lit(0.0)))
    return joined.select("entity", per_thousand(F.coalesce("quantity", F.lit(0.0)), base, scale).alias("water"))


def consumption_levels(use: DataFrame, level_dims: Mapping[str, tuple[DataFrame, str]], scale: int = 4) -> DataFrame:
    """Use per 1000 with the base of the level (lot, house, pen) that each line was booked on."""
    based = joins.lookup_by_level(use, "level", level_dims, "base", "base")
    return based.withColumn("per_thousand", per_thousand("quantity", "base", scale))
