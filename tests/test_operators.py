"""Edge rules of the operators on hand-made frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from farmledger import functions as fn
from farmledger.operators import agg, cost, dims, filters, gaps, joins, kpi, reshape
from farmledger.operators.ordered import clock_slices, cumulate, cumulate_peers, dense_rank, previous, row_number, width_slice
from farmledger.plans import production


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, one key is NULL, days repeat and values are missing."""
    rnd = random.Random(7)
    data = []
    for i in range(600):
        key = "hot" if rnd.random() < 0.7 else rnd.choice(["a", "b", None])
        data.append((key, rnd.randint(1, 40), i, None if rnd.random() < 0.1 else float(rnd.randint(-9, 9))))
    return spark.createDataFrame(data, "k string, day int, id int, v double").repartition(5).cache()


SLICES = {
    "day": lambda: ["day"],
    "week": lambda: [width_slice("day", 7)],
    "one": lambda: [width_slice("day", 1000)],
    "two-level": lambda: ["day", width_slice("id", 50)],
    "none": lambda: [],
}


@pytest.mark.parametrize("kind", SLICES)
def test_sliced_window_equals_plain_window(spark, skewed, kind):
    slices = SLICES[kind]()
    w = Window.partitionBy("k").orderBy("day", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.select(
        "k", "id", F.sum("v").over(upto).alias("s"), F.max("v").over(upto).alias("x"), F.min("v").over(upto).alias("n"),
        F.count("v").over(upto).alias("c"),
    )
    run = cumulate(
        skewed, ["k"], ["day", "id"], slices, {"s": ("sum", "v"), "x": ("max", "v"), "n": ("min", "v"), "c": ("count", "v")}
    )
    assert rows(run.select(*plain.columns)) == rows(plain)

    before = skewed.select("k", "id", F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("x"))
    assert rows(cumulate(skewed, ["k"], ["day", "id"], slices, {"x": ("max", "v")}, exclude_current=True).select("k", "id", "x")) == rows(before)

    numbered = skewed.select("k", "id", F.row_number().over(w).alias("r"))
    assert rows(row_number(skewed, ["k"], ["day", "id"], slices, "r").select("k", "id", "r")) == rows(numbered)

    lagged = skewed.select("k", "id", F.lag("v").over(w).alias("p"))
    assert rows(previous(skewed, ["k"], ["day", "id"], slices, {"p": "v"}).select("k", "id", "p")) == rows(lagged)


@pytest.mark.parametrize("kind", ["day", "week", "one", "none"])
def test_sliced_peers(spark, skewed, kind):
    slices = SLICES[kind]()
    w = Window.partitionBy("k").orderBy("day")
    plain = skewed.select("k", "id", F.sum("v").over(w).alias("s"))
    assert rows(cumulate(skewed, ["k"], ["day"], slices, {"s": ("sum", "v")}, frame="range").select("k", "id", "s")) == rows(plain)
    assert rows(cumulate_peers(skewed, ["k"], "day", {"s": ("sum", "v")}).select("k", "id", "s")) == rows(plain)
    ranked = skewed.select("k", "id", F.dense_rank().over(w).alias("r"))
    assert rows(dense_rank(skewed, ["k"], ["day"], slices, "r").select("k", "id", "r")) == rows(ranked)


def test_clock_slices_follow_time(spark):
    ts = spark.sql("select cast(t as timestamp_ntz) ts from values ('2024-03-31 01:59:59'),('2024-03-31 02:30:00'),('2024-03-31 03:00:00') v(t)")
    got = [tuple(r) for r in ts.select(*clock_slices("ts")).collect()]
    assert got == [(dt.date(2024, 3, 31), 1, 59), (dt.date(2024, 3, 31), 2, 30), (dt.date(2024, 3, 31), 3, 0)]


def test_running_total_ends_at_group_total(spark, skewed):
    run = cumulate(skewed, ["k"], ["day", "id"], ["day"], {"s": ("sum", "v"), "n": ("sum", F.lit(1))})
    last = filters.keep_max(run.where("k is not null"), ["k"], "n").select("k", "s")
    assert rows(last) == rows(skewed.where("k is not null").groupBy("k").agg(F.sum("v")))


def test_surrogate_keys_are_dense_ordered_and_stable(spark):
    names = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("nk")).repartition(7)
    keyed = dims.assign_sk(names, ["nk"], "sk")
    got = sorted((r["nk"], r["sk"]) for r in keyed.collect())
    assert [sk for _, sk in got] == list(range(1, 1001))
    known = keyed.where("sk > 300")
    grown = {r["nk"]: r["sk"] for r in dims.extend_sk(known, names, ["nk"], "sk").collect()}
    assert len(set(grown.values())) == 1000
    assert all(grown[nk] == sk for nk, sk in got if sk > 300)
    assert sorted(grown[nk] for nk, sk in got if sk <= 300) == list(range(1001, 1301))
    empty = dims.assign_sk(names.where("false"), ["nk"], "sk")
    assert empty.count() == 0


def test_default_member_and_duplicates(spark):
    src = spark.createDataFrame([("a",), ("a",), ("b",)], "code string")
    assert rows(dims.build_dimension(src, ["code"], {"code": "Sin"})) == [("Sin",), ("a",), ("b",)]
    dim = spark.createDataFrame([("a", 1), ("Sin", 9)], "code string, sk int")
    fact = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    got = dims.star_lookup(fact, [(dim, {"c": "code"}, "sk", F.col("code") == "Sin")])
    assert rows(got) == [("a", 1), ("z", 9), (None, 9)]


def test_calendar_leap_and_cycle(spark):
    cal = dims.calendar(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 1))
    assert [r["day_id"] for r in cal.orderBy("day").collect()] == [20240228, 20240229, 20240301]
    months = spark.sql("select cast(m as date) m from values ('2023-12-01'), ('2024-01-31'), ('2024-02-29') v(m)")
    assert [r[0] for r in months.select(fn.cycle_label("m")).collect()] == ["C01", "C02", "C03"]


def test_age_sentinel_and_weeks(spark):
    df = spark.sql("select cast('2024-01-10' as date) e, cast(b as date) b from values ('2024-01-01'), ('1899-11-30'), (null) v(b)")
    assert [r[0] for r in df.select(fn.age_days("e", "b")).collect()] == [9, 0, 0]
    days = spark.createDataFrame([(1,), (7,), (8,), (14,), (15,)], "d int")
    assert [r[0] for r in days.select(fn.week_of_life("d")).collect()] == [1, 1, 2, 2, 3]


def test_day_number_markers(spark):
    markers = ((11, 59, 59), (11, 59, 0), (11, 29, 0))
    times = ["00:00:00", "11:59:59", "11:59:00", "11:29:00", "11:29:01", "00:00:01", "23:00:00"]
    df = spark.createDataFrame([(f"1900-01-03 {t}",) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert [r[0] for r in df.select(fn.day_number("t", markers)).collect()] == [2, 2, 2, 2, 3, 3, 3]


def test_ratios_on_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 8.0)], "x double, y double")
    assert [r[0] for r in df.select(fn.safe_pct("x", "y", 2)).collect()] == [0.0, 0.0, 12.5]
    none = df.where("y = 0").agg(fn.wavg("x", "y").alias("w"), fn.wavg_nonzero(F.lit(0.0), "x").alias("z")).first()
    assert none["w"] is None and none["z"] is None
    tie = spark.sql("select 12530.72375D as x").select(fn.fixed("x", 4)).first()[0]
    assert tie == 12530.7238


def test_not_in_ignores_null_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(filters.anti(df, keys, "k")) == [(2,)]


def test_keep_max_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 0, 4)], "k string, v int, id int")
    assert sorted(r["id"] for r in filters.keep_max(df, ["k"], "v").collect()) == [2, 3, 4]


def test_interval_join_crosses_buckets_and_bounds(spark):
    ev = spark.sql("select 'h' k, cast(d as date) d from values ('2024-01-01'),('2024-06-30'),('2024-07-01') v(d)")
    en = spark.sql("select 'h' k, cast('2024-01-01' as date) lo, cast('2024-06-30' as date) hi, 1 lot union all select 'h', date '2024-05-01', date '2024-04-01', 2")
    assert rows(joins.interval_join(ev, en, ["k"], "d", "lo", "hi").select("d", "lot")) == [(dt.date(2024, 1, 1), 1), (dt.date(2024, 6, 30), 1)]


def test_lag_join_needs_the_exact_step(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 20.0), ("a", 4, 40.0), (None, 2, 5.0)], "k string, d int, v double")
    assert rows(joins.lag_join(df, ["k"], "d", {"p": "v"})) == sorted(
        [("a", 1, 10.0, None), ("a", 2, 20.0, 10.0), ("a", 4, 40.0, None), (None, 2, 5.0, None)], key=repr
    )


def test_lag_join_keeps_every_row(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 1, 7.0), ("a", 2, 9.0), ("a", None, 3.0)], "k string, d int, v double")
    assert rows(joins.lag_join(df, ["k"], "d", {"p": "v"})) == sorted(
        [("a", 1, 5.0, None), ("a", 1, 7.0, None), ("a", 2, 9.0, 7.0), ("a", None, 3.0, None)], key=repr
    )


def test_lag_join_gathers_no_rows(spark):
    df = spark.createDataFrame([("a", None, 1.0), (None, None, 2.0), ("a", 3, 3.0), ("a", 5, 4.0), (None, 5, 5.0)], "k string, d int, v double")
    got = joins.lag_join(df, ["k"], "d", {"p": "v"}, 2)
    assert rows(got) == sorted([("a", None, 1.0, None), (None, None, 2.0, None), ("a", 3, 3.0, None), ("a", 5, 4.0, 3.0), (None, 5, 5.0, None)], key=repr)
    assert "collect_list" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_interval_join_takes_open_ended_spans(spark):
    ev = spark.sql("select 'h' k, cast(d as date) d from values ('2024-01-01'),('2030-06-30'),('1999-07-01') v(d)")
    en = spark.sql("select 'h' k, date '2000-01-01' lo, date '9999-12-31' hi, 1 lot")
    assert rows(joins.interval_join(ev, en, ["k"], "d", "lo", "hi").select("d")) == [(dt.date(2024, 1, 1),), (dt.date(2030, 6, 30),)]


def test_ages_and_priority(spark):
    ages = dims.age_dim(spark.sql("select explode(array(-3, 0, 5, 7, 8, 12, 12345)) a"), F.col("a"))
    assert {r["age_day"]: (r["age_code"], r["age_week"]) for r in ages.collect()} == {
        0: ("D00", 1), 5: ("D05", 2), 7: ("D07", 2), 8: ("D08", 3), 12: ("D12", 3), 12345: ("D12345", 1765)
    }
    sources = [spark.createDataFrame(r, "k string, v int") for r in ([("a", 1), (None, 1)], [("a", 2), ("b", 2), ("b", 3)], [("b", 9), ("c", 9), (None, 9)])]
    assert rows(dims.priority_union(sources, ["k"])) == sorted([("a", 1), (None, 1), ("b", 2), ("b", 3), ("c", 9), (None, 9)], key=repr)
    plan = dims.priority_union([spark.range(9).toDF("k") for _ in range(9)], ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 18


def test_cycle_fanout_leaves_history_alone(spark):
    df = spark.sql("select 'e' k, date '1999-01-01' m, 'C02' c union all select 'e', date '2001-05-01', 'C06' union all select 'f', date '2001-06-01', 'C07' union all select 'g', date '2001-05-01', 'C09'")
    got = rows(cost.cycle_fanout(df, "m", "c", dt.date(2001, 7, 15), 12))
    assert got == sorted([tuple(r) for r in df.collect()] + [("e", dt.date(2001, 5, 1), "C07")], key=repr)


def test_salted_join_equals_join(spark, skewed):
    small = spark.createDataFrame([("hot", 1), ("a", 2)], "k string, n int")
    for how in ("left", "inner"):
        assert rows(joins.salted_join(skewed, small, ["k"], ["id"], 5, how).select("k", "id", "n")) == rows(
            skewed.join(small, "k", how).select("k", "id", "n")
        )


def test_reattribute_and_levels(spark):
    df = spark.createDataFrame([("m", "x"), ("s", "y")], "lot string, house string")
    moved = spark.createDataFrame([("m", None)], "lot string, nh string")
    assert rows(joins.reattribute(df, moved, "lot", {"house": "nh"})) == [("m", None), ("s", "y")]


def test_unpivot_inverts_pivot(spark):
    cells = spark.createDataFrame([("a", "p", 1.0), ("a", "q", 2.0), ("b", "q", 3.0)], "k string, c string, v double")
    wide = reshape.pivot_case(cells, ["k"], "c", {"p": "p", "q": "q"}, "v")
    assert rows(reshape.unpivot(wide, ["k"], ["p", "q"], "c", "v", drop_zero=True)) == rows(cells)


def test_top_causes(spark):
    data = [("w1", "a", 0.0), ("w2", "a", 5.0)]
    data += [("w3", c, v) for c, v in [("a", 1.0), ("b", 9.0), ("c", 9.0)]]
    data += [("w5", c, float(v)) for c, v in [("a", 5), ("b", 4), ("c", 3), ("d", 2), ("e", 1)]]
    got = {r["k"]: r for r in reshape.top_n_others(spark.createDataFrame(data, "k string, c string, v double"), ["k"], "c", "v").collect()}
    assert [got["w3"][f"name_{i}"] for i in (1, 2, 3)] == ["b", "c", "a"]
    assert got["w2"]["name_2"] is None and got["w2"]["qty_others"] == 0
    assert got["w5"]["qty_others"] == 3.0 and got["w5"]["qty_total"] == 15.0
    assert got["w1"]["pct_1"] is None


def test_densify_has_no_gaps(spark):
    lots = spark.createDataFrame(
        [("p1", "L", 1, 5.0, 1), ("p1", "L", 2, 6.0, 2), ("p2", "L", 6, 9.0, 3), ("p3", "M", 4, 1.0, 1)],
        "pen string, lot string, day int, carried double, n int",
    )
    got = gaps.densify_tail(lots, ["pen"], ["lot"], "day", ["carried"], ["n"])
    added = rows(got.where("flag = 2").select("pen", "day", "carried", "n"))
    assert added == [("p1", d, 6.0, 0) for d in (3, 4, 5, 6)]
    assert got.where("flag = 1").count() == lots.count()
    wide = gaps.densify_tail(lots.withColumn("extra", F.lit("x")), ["pen"], ["lot"], "day", ["carried"], ["n"])
    assert {(r["flag"], r["extra"]) for r in wide.collect()} == {(1, "x"), (2, None)}


def test_curve_edges(spark):
    curve = spark.createDataFrame(
        [("a", 1, 10.0), ("a", 2, 12.0), ("a", 3, 0.0), ("a", 4, 0.0), ("one", 1, 5.0), ("one", 2, 0.0), ("full", 1, 3.0)],
        "k string, d int, v double",
    )
    got = {(r["k"], r["d"]): r["e"] for r in gaps.extrapolate_linear(curve, ["k"], "d", "v", "e").collect()}
    assert got[("a", 3)] == 14.0 and got[("a", 4)] == 16.0
    assert got[("one", 2)] == 0.0 and got[("full", 1)] == 3.0
    held = {(r["k"], r["d"]): r["v"] for r in gaps.carry_last_valid(curve, ["k"], "d", "v", 2).collect()}
    assert held[("a", 3)] == 12.0 and held[("one", 2)] == 0.0


def test_growth_rate_skips_zero_and_repeats(spark):
    readings = spark.createDataFrame(
        [("a", 1, 0.0), ("a", 2, 10.0), ("a", 5, 16.0), ("a", 6, 16.0), ("a", 7, 0.0), ("a", 9, 20.0), ("solo", 3, 4.0)],
        "k string, d int, v double",
    )
    got = rows(gaps.growth_rate(readings, ["k"], "d", "v").select("k", "d", "difference", "days_between", "daily_gain"))
    assert got == [("a", 2, 0.0, 0, 0.0), ("a", 5, 6.0, 3, 2.0), ("a", 9, 4.0, 4, 1.0), ("solo", 3, 0.0, 0, 0.0)]


def test_rollup_chain_totals_agree(spark, skewed):
    chain = agg.rollup_chain(skewed, [("row", ["k", "day", "id"]), ("day", ["k", "day"]), ("key", ["k"])], {"v": "v"}, {})
    totals = [df.agg(F.sum("v")).first()[0] for df in chain.values()]
    assert len(set(totals)) == 1


def test_twin_rollup_untagged_drops_equal_rows(spark):
    df = spark.createDataFrame([("a", 1, True), ("a", 2, False), ("b", 3, True)], "k string, v int, typical boolean")
    aggs = {"v": F.sum("v")}
    assert rows(agg.with_and_without(df, F.col("typical"), ["k"], aggs)) == [("a", 1), ("a", 3), ("b", 3)]
    assert rows(agg.with_and_without(df, F.col("typical"), ["k"], aggs, "t")) == [("a", 1, 1), ("a", 3, 2), ("b", 3, 1), ("b", 3, 2)]


def test_dominant_tie_takes_smaller_category(spark):
    df = spark.createDataFrame([("a", "z", 5.0), ("a", "b", 5.0), ("a", "c", 1.0)], "k string, c string, w double")
    r = agg.dominant(df, ["k"], "c", "w").first()
    assert (r["c"], r["share"]) == ("b", 0.4545)


def test_opening_balance_needs_the_day_before(spark):
    df = spark.createDataFrame([("a", 1, 5.0, 100.0), ("a", 2, 7.0, 100.0), ("a", 4, 1.0, 100.0)], "k string, d int, out double, pop double")
    got = {r["d"]: r["opening"] for r in kpi.opening_balance(df, ["k"], "d", "out", "pop").collect()}
    assert got == {1: None, 2: 95.0, 4: None}


def test_eliminations_do_not_multiply_lines(spark):
    df = spark.sql("""select o obj, e element, a amount, cast(d as timestamp_ntz) d from values
        ('m', 'x', 1.0D, '2024-05-01'), ('m', 'y', 2.0D, '2024-05-02'), ('n', 'x', 4.0D, '2024-05-03'), ('n', 'y', 8.0D, '2024-05-31'), ('n', 'y', 16.0D, '2024-06-01'), ('q', 'x', 1.0D, '2024-05-05') v(o, e, a, d)""")
    cols = {"object": "obj", "element": "element", "amount": "amount", "date": "d"}
    stock = df.where("obj <> 'q'")
    got = rows(cost.cost_eliminations(df, stock, cols, dt.date(2024, 5, 20), ["m"]).select("obj", "element", "amount", "eliminated"))
    assert got == [
        ("m", "x", 1.0, 1.0), ("m", "y", 2.0, 2.0), ("n", "x", 4.0, 12.0), ("n", "y", 16.0, None), ("n", "y", 8.0, 12.0), ("q", "x", 1.0, 0.0),
    ]


def test_ledger_line_may_meet_several_criteria(spark):
    df = spark.createDataFrame([(1, 5), (2, 50)], "id int, v int")
    got = cost.ledger_extract_union(df, [("all", F.col("v") > 0), ("big", F.col("v") > 9), ("never", F.lit(None).cast("boolean"))], "tag", ["id"])
    assert rows(got) == [(1, "all"), (2, "all"), (2, "big")]


def test_weighted_date_is_floored(spark):
    df = spark.sql("select cast(d as date) d, h from values ('2024-01-01', 1.0D), ('2024-01-02', 1.0D) v(d, h)")
    assert df.agg(fn.wavg_date("d", "h")).first()[0] == dt.date(2024, 1, 1)


def test_date_filters_are_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "f")
    spark.sql("select cast('2024-01-01' as timestamp_ntz) ts, 1 id").write.parquet(path)
    df = spark.read.parquet(path).where(fn.rolling_months("ts", dt.date(2024, 3, 1), 4)).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan


def test_medication_keeps_every_week(spark):
    df = spark.createDataFrame([("a", 1, "x", 1), ("a", 1, "y", 2), ("a", 1, "x", 3), ("a", 500, "z", 9), ("b", None, "x", 4)], "k string, week int, p string, d int")
    assert rows(reshape.list_weeks(df, ["k"], "week", "p", "d")) == sorted([("a", 1, "x,y", "2,1"), ("a", 500, "z", "1"), ("b", None, "x", "1")], key=repr)


def test_weighted_standards_keep_every_week(spark):
    days = spark.createDataFrame([("z", 1, "h", 1, 1, "b"), ("z", 1, "h", 1, 700, "b"), ("z", 1, "h", 2, 2, "c"), ("z", 2, "h", 1, 9, "b")], "zone string, lot int, house string, pen int, age int, breed string")
    heads = days.select("zone", "lot", "house", "pen").distinct().withColumn("heads", F.lit(10.0))
    curve = spark.createDataFrame([("b", 1, 4.0), ("c", 1, 8.0), ("b", 100, 5.0)], "breed string, week int, std double")
    got = production.weighted_standards_weeks(days, heads, curve).select("zone", "lot", "house", "pen", "week", "std_pen", "std_house", "std_lot")
    assert rows(got) == sorted(
        [("z", 1, "h", 1, 1, 4.0, 6.0, 6.0), ("z", 1, "h", 2, 1, 8.0, 6.0, 6.0), ("z", 1, "h", 1, 100, 5.0, 5.0, 5.0), ("z", 2, "h", 1, 2, 0.0, 0.0, 0.0)], key=repr
    )


def test_weigh_days_have_no_end(spark):
    days = spark.createDataFrame([("z", 1, "h", 1, 7, 1.0), ("z", 1, "h", 1, 8, 9.0), ("z", 1, "h", 1, 7000, 2.0), ("z", 1, "h", 2, 70000, 0.0), ("z", 1, "h", 2, 70002, 4.0)], "zone string, lot int, house string, pen int, age int, weight double")
    wide = production.weight_weekly(days, {k: f"w{k}" for k in range(8)}, F.col("age") % 7 == 0, F.col("week") % 8)
    assert rows(wide.select("pen", "w0", "w1")) == [(1, 2.0, 1.0), (2, 4.0, 0.0)]
