"""Stored state, rule tables, dated moves and long spans, on hot keys and small changes."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from farmledger.operators import gaps, incremental, joins
from farmledger.operators.rules import classify


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_sweep_join_agrees_with_all_pairs(spark):
    rng = random.Random(3)
    events = [(rng.choice("hhhhk"), day(rng.randrange(400)), k) for k in range(600)] + [("h", None, 900), (None, day(1), 901), ("x", day(5), 902)]
    spans = [(rng.choice("hhk"), day(lo), day(lo + rng.choice([0, 3, 90, 10_000])), f"s{j}") for j, lo in enumerate(rng.randrange(-50, 420) for _ in range(80))]
    spans += [("h", day(9), day(3), "turned"), ("h", None, day(9), "null"), (None, day(0), day(9), "nokey"), ("none", day(0), day(9), "noevents")]
    want = sorted(((k, n, s) for k, t, n in events for key, lo, hi, s in spans if None not in (k, t, lo, hi) and k == key and lo <= t <= hi), key=repr)
    e = spark.createDataFrame(events, "k string, t date, n int").repartition(3)
    s = spark.createDataFrame(spans, "k string, lo date, hi date, s string").repartition(2)
    for size in (1, 20, 10_000):
        assert rows(joins.sweep_join(e, s, ["k"], "t", "lo", "hi", size).select("k", "n", "s")) == want
    assert rows(joins.interval_join(e, s, ["k"], "t", "lo", "hi", bucket_days=8, long_span=4).select("k", "n", "s")) == want


def test_a_hot_key_with_open_spans_meets_in_many_slices(spark):
    e = spark.range(40_000).select(F.expr("if(id >= 0, 'h', 'x')").alias("k"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, id)").alias("t"), "id")
    s = spark.createDataFrame([("h", dt.datetime(2020, 1, 1), dt.datetime(9999, 12, 31), 1)], "k string, lo timestamp_ntz, hi timestamp_ntz, s int")
    out = joins.sweep_join(e, s, ["k"], "t", "lo", "hi", 1000)
    assert out.count() == 40_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "__slice" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def place(moves, entity, at):
    since, where = dt.date.min, entity
    first = True
    while True:
        later = [(d, t) for s, t, d in moves if s == where and d <= at and d >= since]
        if not later:
            return where
        # an entity's rows follow its last move; what arrives somewhere follows that place's last move since then
        d = max(x for x, _ in later)
        since, where, first = d, max(t for x, t in later if x == d), False


def test_dated_moves_and_chains(spark):
    moves = [("a", "b", day(10)), ("a", "c", day(20)), ("b", "d", day(15)), ("d", "e", day(15)), ("c", "x", day(5)), ("e", "f", day(40)), ("f", "g", day(40))]
    moves += [(f"n{k}", f"n{k + 1}", day(k)) for k in range(60)]
    frame = spark.createDataFrame([*moves, (None, "q", day(1)), ("q", "r", None)], "src string, dst string, at date")
    resolved = joins.resolved_moves(frame, "src", "dst", "at")
    entities = ["a", "b", "c", "d", "e", "f", "zz", "n0", "n7", "n59"]
    facts = [(x, day(n)) for x in entities for n in (0, 5, 9, 10, 14, 15, 19, 20, 39, 40, 70)]
    got = joins.reattribute_dated(spark.createDataFrame(facts, "e string, d date"), resolved, "e", "d", "src", "dst", "place")
    assert rows(got) == sorted(((x, d, place(moves, x, d)) for x, d in facts), key=repr)
    with pytest.raises(ValueError, match="circle"):
        joins.resolved_moves(spark.createDataFrame([("a", "b", day(1)), ("b", "a", day(1))], "src string, dst string, at date"), "src", "dst", "at")


def test_running_totals_carry_on_from_balances(spark):
    rng = random.Random(5)
    data = [(rng.choice(["x", "y", None]), day(rng.randrange(200)), rng.choice([1, 2, None]), k) for k in range(300)]
    df = spark.createDataFrame(data, "k string, d date, v int, n int").withColumn("month", F.trunc("d", "month"))
    since = day(120).replace(day=1)
    whole = joins.cumulate(df, ["k"], ["d", "n"], [], {"total": ("sum", "v")}).where(F.col("d") >= F.lit(since))
    old = df.where(F.col("d") < F.lit(since))
    stored = incremental.closing_balances(old.where(F.col("d") < F.lit(day(60).replace(day=1))), ["k"], "month", {"total": "v"})
    more = incremental.closing_balances(old.where(F.col("d") >= F.lit(day(60).replace(day=1))), ["k"], "month", {"total": "v"}, stored)
    got = incremental.cumulate_on(df.where(F.col("d") >= F.lit(since)), stored.unionByName(more), ["k"], ["d", "n"], [], "month", {"total": "v"}, since)
    assert rows(got.select("n", "total")) == rows(whole.select("n", "total"))


def test_a_change_of_one_month_touches_its_keys_only(spark):
    base = spark.createDataFrame([("m1", "z", "a", 1), ("m1", "z", "a", 2), ("m2", "z", "a", 3), ("m2", "z", "b", 4), ("m2", "w", "c", 5)], "month string, zone string, pen string, v int")
    levels, sums = [("pen", ["month", "zone", "pen"]), ("zone", ["month", "zone"])], {"v": F.col("v")}
    before = base.where("month = 'm2'")
    after = spark.createDataFrame([("m2", "z", "a", 30), ("m2", "z", "d", 7), ("m2", "w", "c", 5)], base.schema)
    changes = incremental.rollup_changes(incremental.change_sums(before, after, levels[0][1], sums), levels, ["v"])
    assert rows(changes["pen"]) == [("m2", "z", "a", 27, 0), ("m2", "z", "b", -4, -1), ("m2", "z", "d", 7, 1)]
    assert rows(changes["zone"]) == [("m2", "z", 30, 0)]  # w stays as it is and is not touched
    published = base.groupBy("month", "zone", "pen").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n_rows"))
    assert rows(incremental.merge_level(published, changes["pen"], levels[0][1], ["v"])) == [("m2", "z", "a", 30, 1), ("m2", "z", "d", 7, 1)]


def test_distinct_counts_add_up(spark):
    df = spark.range(5000).selectExpr("id % 7 as zone", "id % 70 as farm", "case when id % 11 = 0 then null else id * 37 % 90000 end as n")
    counted = incremental.distinct_by_level(df, [("farm", ["zone", "farm"]), ("zone", ["zone"])], "n", "c")
    for name, keys in (("farm", ["zone", "farm"]), ("zone", ["zone"])):
        assert rows(counted[name]) == rows(df.groupBy(*keys).agg(F.countDistinct("n").alias("c")))
    scans = counted["zone"]._jdf.queryExecution().optimizedPlan().toString().count("Range (")
    assert scans == 1


def test_rules_are_rows(spark):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), rng.choice(["x", "y"]), rng.choice([None, *range(20)])) for _ in range(200)]
    table = [(rng.randrange(50), rng.choice(["a", "b", None]), rng.choice(["x", None]), rng.choice([None, 3, 9]), rng.choice([None, 5, 12]), f"r{k}") for k in range(60)]
    df = spark.createDataFrame(data, "f string, g string, q int")
    schema = "priority int, f string, g string, lo int, hi int, kind string"

    def first(f, g, q):
        fit = [(p, kind) for p, rf, rg, lo, hi, kind in table if (rf is None or rf == f) and (rg is None or rg == g) and (lo is None or (q is not None and q >= lo)) and (hi is None or (q is not None and q <= hi))]
        return min(fit, default=(0, "other"))[1]

    got = classify(df, spark.createDataFrame(table, schema), ["f", "g"], "kind", "kind", ranged="q", default="other")
    assert rows(got) == sorted(((f, g, q, first(f, g, q)) for f, g, q in data), key=repr)
    joined = [classify(df, spark.createDataFrame(table * n, schema), ["f", "g"], "kind", "kind", ranged="q")._jdf.queryExecution().analyzed().toString().count("Join") for n in (1, 20)]
    assert joined[0] == joined[1]  # the plan does not grow with the rules
    assert {r.kind for r in classify(df, spark.createDataFrame([], schema), ["f", "g"], "kind", "kind", default="none").collect()} == {"none"}


def test_cycles_are_appended_once(spark):
    months = spark.createDataFrame([(dt.date(2024, m, 1),) for m in (1, 2, 3)], "month date")
    none = spark.createDataFrame([], "month date, cycle string")
    first = incremental.missing_cycles(months.where("month < '2024-03-01'"), none, "month", "cycle", dt.date(2024, 2, 29))
    assert rows(first) == [(dt.date(2024, 1, 1), "C02"), (dt.date(2024, 1, 1), "C03"), (dt.date(2024, 2, 1), "C03")]
    second = incremental.missing_cycles(months, first, "month", "cycle", dt.date(2024, 3, 31))
    assert rows(second) == [(dt.date(2024, m, 1), "C04") for m in (1, 2, 3)]
    assert second.join(first, ["month", "cycle"]).count() == 0
    assert incremental.missing_cycles(months, first.union(second), "month", "cycle", dt.date(2024, 3, 31)).isEmpty()
    unit = months.withColumn("v", F.month("month"))
    assert rows(incremental.publish_missing(unit, second, "month", "cycle").select("v", "cycle")) == [(1, "C04"), (2, "C04"), (3, "C04")]


def test_carried_values_do_not_depend_on_the_order_of_rows(spark):
    data = [("g", "a", 1, 5, 0), ("g", "a", 2, 3, 1), ("g", "a", 2, 9, 0), ("g", "b", 4, 1, 0)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "grp string, k string, day int, v int, w int").coalesce(1)
        added = gaps.densify_tail(df, ["k"], ["grp"], "day", ["v", "w"], [], "flag").where("flag = 2")
        assert rows(added.select("k", "day", "v", "w")) == [("a", 3, 9, 0), ("a", 4, 9, 0)]
        curve = spark.createDataFrame([("a", d, v) for _, _, d, v, _ in order] + [("a", 7, 0)], "k string, day int, v int")
        assert ("a", 7, 1) in rows(gaps.carry_last_valid(curve, ["k"], "day", "v", 5))
