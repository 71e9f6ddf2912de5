"""Hatchery, climate, journal and cost tables on small fixtures, and how often they read their input."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from farmledger.plans.catalog import REGISTRY
from farmledger.plans.division_month import breeder_feed, division_month, expense_by_province, lot_weeks
from farmledger.plans.hatchery import EGGS, SAMPLED, STANDARDS, hatch_daily, hatch_weekly
from farmledger.plans.house_climate import evaluated, level_bases, use_by_state
from farmledger.plans.journal_extracts import Extract, extracts, industry_costs, publish_tasks

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("name", "times"), [("plan_cost_structure", 2), ("plan_commercial_measures", 2), ("plan_journal_sections", 1), ("plan_task_extracts", 2), ("plan_industry_costs", 2), ("plan_hatch_weekly", 1), ("plan_lot_weeks", 1), ("plan_division_month", 1), ("plan_expense_provinces", 1), ("plan_breeder_feed", 2)])
def test_how_often_lines_are_read(spark, name, times):
    """Scans of the lines, those of subqueries included; a published table that is made from the lines is one."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    df = REGISTRY[name].run(spark, SMALL)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    seen = {m for m in re.findall(r"FileScan parquet \[([^]]*)\]", plan) if "l_" in m}  # a reused subquery shows its scan again
    assert len(seen) <= times, plan


def test_a_line_comes_once_for_each_extract(spark):
    df = spark.createDataFrame([(1, "a", "f"), (2, "b", "f"), (3, None, "g"), (4, "c", "g")], "id int, code string, farm string")
    parts = [Extract("one", F.col("code").isin("a", "b"), ["id", "code", "farm"]), Extract("two", F.col("code") == "b", ["id", "code"], blank=("farm",)), Extract("three", F.col("id") == 3, ["id"])]
    got = rows(extracts(df, parts, ["id", "code", "farm"]))
    assert got == sorted([("one", 1, "a", "f"), ("one", 2, "b", "f"), ("two", 2, "b", ""), ("three", 3, None, None)], key=repr)


def test_tasks_replace_their_month_only(spark):
    d = lambda m, k: dt.datetime(2001, m, k)
    lines = spark.createDataFrame([(1, "a", d(7, 1)), (2, "a", d(6, 30)), (3, "b", d(7, 31)), (4, "a", d(8, 1))], "id int, code string, at timestamp_ntz")
    old = spark.createDataFrame([("t", 8, "a", d(7, 5)), ("t", 9, "a", d(6, 5)), ("t", 10, "a", d(8, 5)), ("t", 11, "a", None)], "task string, id int, code string, at timestamp_ntz")
    got = publish_tasks(lines, [Extract("t", F.col("code") == "a", ["id", "code", "at"])], ["id", "code", "at"], old, "at", dt.date(2001, 8, 15))
    assert sorted(r.id for r in got.collect()) == [1, 9, 10, 11]
    again = publish_tasks(lines, [Extract("t", F.col("code") == "a", ["id", "code", "at"])], ["id", "code", "at"], got, "at", dt.date(2001, 8, 15))
    assert rows(again) == rows(got)


def test_the_first_business_takes_a_line(spark):
    at = dt.datetime(2001, 7, 3)
    lines = spark.createDataFrame([("x", "f", 10.0, 2.0, at), ("y", "f", 5.0, 0.0, at), ("z", "f", 7.0, 1.0, at)], "kind string, farm string, amount double, kilos double, at timestamp_ntz")
    rules = {"p": F.col("kind") == "x", "q": F.col("kind").isin("x", "y")}
    got = industry_costs(lines, rules, F.col("kilos"), ["farm"], "at", "amount", None, dt.date(2001, 8, 1))
    assert rows(got.select("business", "cost", "unit_cost")) == [("p", 10.0, 5.0), ("q", 5.0, 0.0)]


def test_a_silent_house_keeps_its_first_day(spark):
    df = spark.createDataFrame([(1, 5, 0.0, None), (1, 3, 0.0, 0.0), (1, 3, None, None), (2, 1, 0.0, 0.0), (2, 2, 7.0, None), (3, 1, -2.0, 2.0), (3, 4, 1.0, 0.0)], "house int, at int, a double, b double")
    assert [(r.house, r.at) for r in evaluated(df, ["house"], "at", ["a", "b"]).orderBy("house", "at").collect()] == [(1, 3), (1, 3), (2, 2), (3, 4)]


def test_a_pen_counts_once_in_each_level(spark):
    pens = spark.createDataFrame([(1, "a", 1, 10.0, 2.0, 1), (1, "a", 2, 20.0, 4.0, 3), (1, "b", 1, 5.0, 1.0, 2)], "lot int, house string, pen int, heads double, kilos double, state int")
    bases = level_bases(pens, {"F": ["lot"], "H": ["lot", "house"]})
    assert rows(bases.select("level", "entity", "heads_placed", "state")) == [("F", "1", 35.0, 3), ("H", "1-a", 30.0, 3), ("H", "1-b", 5.0, 2)]
    use = spark.createDataFrame([("F", "1", 1, 7.0, 4), ("H", "1-b", 1, 5.0, 4), ("H", "none", 1, 5.0, 1)], "level string, entity string, day int, quantity double, kind int")
    running = spark.createDataFrame([("1-b", 1, 2.0)], "entity string, day int, so_far double")
    got = use_by_state(use, bases, running, [((F.col("kind") == 4) & (F.col("state") == 3), "kilos_sold")], "so_far")
    assert {r.entity: r.per_thousand for r in got.collect()} == {"1": 1000.0, "1-b": 2500.0, "none": 0.0}


def test_a_week_without_eggs_or_standard(spark):
    tray = {"lot": 1, "breed": "x", "age": 30, "day": dt.date(2001, 7, 2), **{c: 0.0 for c in [*EGGS, *SAMPLED]}}
    full = {**tray, "lot": 2, "set_eggs": 100.0, "first_chicks": 70.0, "culled": 10.0, "week1": 3.0, "infertile": 1.0, "day": dt.date(2001, 7, 3)}
    types = "lot int, breed string, age int, day date, " + ", ".join(f"{c} double" for c in [*EGGS, *SAMPLED])
    trays = spark.createDataFrame([tuple(t.values()) for t in (tray, full, {**full, "day": dt.date(2001, 7, 4)})], types)
    std = spark.createDataFrame([], "breed string, age int, " + ", ".join(f"{s} double" for s in STANDARDS))
    daily = hatch_daily(trays, ["lot", "breed"])
    empty, week = hatch_weekly(daily, std, ["lot", "breed"], {"x": "x"}).orderBy("lot").collect()
    assert (empty.pct_first, empty.pct_embryo, empty.accounted, empty.due_first) == (0.0, 0.0, 0.0, None)
    assert (week.set_eggs, week.set_eggs_x, week.pct_hatch, week.pct_embryo, week.pct_fertile) == (200.0, 200.0, 80.0, 15.0, 95.0)
    assert week.accounted == 100.0 and week.age_group == "Joven" and week.gap_first is None


DAILY = "month_id string, company string, division int, lot int, state string, placed_on date, sold_on date, age int, heads double, deaths long, weight double, feed double, kilos double"


def _pen(month, company, lot, state, age, heads, deaths, weight):
    return (month, company, 1, lot, state, dt.date(2001, 1, 1), dt.date(2001, 1, 1), age, heads, deaths, weight, 2 * heads, 3 * heads)


def test_weeks_hold_every_day_of_a_lot(spark):
    daily = spark.createDataFrame([_pen("200101", "a", 1, "F", age, 10.0, 1, 0.5) for age in (-5, 0, 1, 7, 8, 21, 22, 400, None)], DAILY)
    out = lot_weeks(daily, ["lot"], weeks=3).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.dead_1, r.dead_2, r.dead_3, r.deaths) == (4, 1, 3, 9)  # a row without an age counts in the total only
    assert (r.dead_to_1, r.dead_to_2, r.dead_to_3) == (4, 5, 8)
    assert (r.weight_x_heads_1, r.weight_x_heads_2, r.weight_x_heads_3) == (20.0, 5.0, 15.0)


def test_weights_of_a_month_spread_over_other_lots(spark):
    daily = spark.createDataFrame([
        _pen("200101", "a", 1, "closed", 3, 100.0, 4, 0.5), _pen("200101", "a", 2, "paid", 3, 50.0, 1, 0.2), _pen("200101", "b", 3, "closed", 10, 40.0, 2, 1.0),
        _pen("200101", "c", 4, "open", 3, 900.0, 9, 9.0), _pen("200102", "a", 5, "paid", 3, 10.0, 1, 2.0),
    ], DAILY)
    lots = lot_weeks(daily, ["month_id", "company", "division", "lot", "state", "placed_on"], weeks=2)
    out = {(r.month_id, r.company): r for r in division_month(lots, F.col("state").isin("closed", "paid"), F.col("state").isin("closed", "open"), weeks=2).collect()}
    assert set(out) == {("200101", "a"), ("200101", "b"), ("200102", "a")}  # an open lot is in the base, not in a row
    a = out["200101", "a"]
    assert (a.lots, a.heads, a.deaths, a.base_heads, a.dead_1, a.dead_to_2) == (2, 150.0, 5, 1040.0, 5, 5)
    assert a.weight_1 == round((0.5 * 100 + 0.2 * 50) / 1040, 4) and a.weight_2 == 0.0
    assert (a.mean_age, a.dead_pct, a.mean_weight, a.conversion) == (3, 3.3333, 3.0, 0.666666)
    assert out["200101", "b"].weight_2 == round(40 / 1040, 4)
    assert out["200102", "a"].base_heads == 1.0 and out["200102", "a"].weight_1 == 20.0
    assert division_month(lots.limit(0), F.lit(True), F.lit(True), weeks=2).count() == 0


def test_feed_before_placement_goes_to_the_second_day(spark):
    rows_ = [(k, dt.date(2001, m, 5), age, 10.0, 0.0, "x", "y", 2.0) for k, (m, age) in enumerate([(7, 0), (7, -1), (7, -9), (7, 3)])]
    rows_ += [(0, dt.date(2000, 7, 31), 0, 5.0, 1.0, "x", None, 2.0), (0, dt.date(2001, 7, 6), 2, 1.0, 0.0, "x", "y", 2.0)]
    field = spark.createDataFrame(rows_, "lot int, day date, age int, f double, m double, formula_f string, formula_m string, price double")
    fed = breeder_feed(field, ["lot"], {"F": ("f", "formula_f"), "M": ("m", "formula_m")}, F.col("lot") == 2, dt.date(2001, 8, 1))
    got = {(r.lot, r.sex, r.life_day): (r.feed, r.value, r.formula) for r in fed.collect()}
    assert got == {(0, "F", 2): (11.0, 22.0, "x"), (1, "F", 2): (10.0, 20.0, "x"), (2, "F", 2): (10.0, 20.0, "x"), (3, "F", 3): (10.0, 20.0, "x"),
                   (0, "F", 0): (5.0, 10.0, "x"), (0, "M", 0): (1.0, 2.0, None)}


def test_expenses_add_up_at_all_levels(spark):
    lines = spark.createDataFrame([
        ("200101", "1", "p", 1.0, 2.0, 10.0), ("200101", "2", "p", 3.0, 0.0, 0.0), ("200101", "2", "q", 1.0, 1.0, 4.0), ("200101", "3", "p", 9.0, 9.0, 9.0), ("200101", "1", None, 9.0, 9.0, 9.0),
    ], "month_id string, org string, province string, sales double, freight double, kilos double")
    out = expense_by_province(lines, ["sales", "freight"], {"1": "live", "2": "processed"})
    got = {(r.level, r.channel, r.province): (r.sales, r.freight, r.spent, r.kilos, r.per_kilo) for r in out.collect()}
    assert got == {
        ("province of channel", "live", "p"): (1.0, 2.0, 3.0, 10.0, 0.3), ("province of channel", "processed", "p"): (3.0, 0.0, 3.0, 0.0, 0.0),
        ("province of channel", "processed", "q"): (1.0, 1.0, 2.0, 4.0, 0.5), ("channel", "live", None): (1.0, 2.0, 3.0, 10.0, 0.3),
        ("channel", "processed", None): (4.0, 1.0, 5.0, 4.0, 1.25), ("province", None, "p"): (4.0, 2.0, 6.0, 10.0, 0.6), ("province", None, "q"): (1.0, 1.0, 2.0, 4.0, 0.5),
        ("month", None, None): (5.0, 3.0, 8.0, 14.0, 0.571),
    }
