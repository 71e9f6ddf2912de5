"""What keeps a task, a shuffle or a plan from growing faster than the input."""

import random

from pyspark.sql import functions as F

from farmledger.operators import incremental, joins, reshape
from farmledger.plans import costing
from farmledger.plans import production as P
from farmledger.session import TASK_BYTES, tune


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_task_scans_and_reads_a_bounded_part(spark):
    tune(spark)
    assert {k: spark.conf.get(k) for k in TASK_BYTES} == TASK_BYTES
    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(key, "1m")  # named by the session
    try:
        assert tune(spark).conf.get(key) == "1m"
    finally:
        spark.conf.set(key, TASK_BYTES[key])


def _timeline(spark):
    e = spark.range(300).selectExpr("id % 3 as k", "date_add(date'2024-01-01', cast(id % 100 as int)) as t", "id")
    s = spark.range(12).selectExpr("id % 4 as k", "date_add(date'2024-01-01', cast(id * 7 as int)) as lo", "date_add(date'2024-01-01', cast(id * 9 as int)) as hi", "id as s")
    return e, s


def test_sweep_join_evaluates_its_events_once_a_use(spark):
    e, s = _timeline(spark)
    out = joins.sweep_join(e, s, ["k"], "t", "lo", "hi", 10)
    assert optimised(out).count("Range (0, 300") == 4  # rows, slices, and borders at both ends of a span
    want = e.join(s, "k").where("t between lo and hi").select("id", "s")
    assert rows(out.select("id", "s")) == rows(want)


def test_interval_join_gives_the_sweep_what_long_spans_reach(spark):
    e, s = _timeline(spark)
    long = s.selectExpr("k", "lo", "case when s = 5 then date'2024-02-20' else hi end as hi", "s")
    for spans in (s, long):
        out = joins.interval_join(e, spans, ["k"], "t", "lo", "hi", bucket_days=4, long_span=6)
        assert "scalar-subquery" in optimised(out)
        assert rows(out.select("id", "s")) == rows(e.join(spans, "k").where("t between lo and hi").select("id", "s"))


def test_only_the_coarsest_level_holds_bitmaps(spark):
    rng = random.Random(2)
    data = [(rng.choice([0, 1, None]), rng.randrange(5), rng.randrange(40), rng.choice([None, *range(0, 90_000, 4321)])) for _ in range(900)]
    df = spark.createDataFrame(data, "zone int, farm int, lot int, n int")
    levels = [("lot", ["zone", "farm", "lot"]), ("farm", ["zone", "farm"]), ("zone", ["zone"])]
    for some in (levels, levels[1:], levels[2:]):
        counted = incremental.distinct_by_level(df, some, "n", "c")
        assert "bitmap_construct_agg" not in optimised(counted[some[0][0]])
        for name, keys in some:
            assert rows(counted[name]) == rows(df.where("n is not null").groupBy(*keys).agg(F.countDistinct("n").alias("c")))


def _days(spark):
    return spark.range(600).selectExpr(
        "id % 2 as zone", "id % 6 as lot", "id % 3 as house", "id % 4 as pen", "cast(if(id % 97 = 0, null, id % 50) as int) as age",
        "cast(id % 7 as double) as deaths", "cast(id % 3 as double) as a", "cast(id % 5 as double) as b", "cast(id % 2 as double) as c", "cast(0 as double) as d",
    )


def test_ranked_causes_stay_in_the_task_of_their_week(spark):
    days, causes, keys = _days(spark), ["a", "b", "c", "d"], ["zone", "lot"]
    for job, shuffles in ((P.mortality_causes, 1), (P.mortality_causes_running, 2)):
        plan = physical(job(days, causes, keys))
        assert plan.count("Exchange ") <= shuffles and "Join" not in plan
    long = reshape.unpivot(days.groupBy(*keys, "age").agg(*[F.sum(x).alias(x) for x in causes]), [*keys, "age"], causes, "cause", "q", drop_zero=True)
    ranked = [reshape.top_n_others(long, [*keys, "age"], "cause", "q", 2, unique=u) for u in (False, True)]
    assert ranked[0].columns == ranked[1].columns and rows(ranked[0]) == rows(ranked[1])


def test_days_of_a_pen_lie_together(spark):
    plan = physical(P.mortality_daily(_days(spark)))
    assert not [line for line in plan.splitlines() if "Exchange hash" in line and "age#" in line]


def test_few_houses_are_met_by_readings_dealt_by_lot(spark):
    readings = spark.range(200).selectExpr("id as lot", "if(id % 9 = 0, null, concat('h', id % 2)) as house", "'x' as breed", "cast(id % 5 as int) as age", "id % 3 as sup")
    sup = spark.range(2).selectExpr("id as s", "id + 10 as sk")
    curve = spark.range(4).selectExpr("'x' as breed", "cast(id as int) as age", "cast(id + 1 as double) as std")
    moved = spark.createDataFrame([(4, "n")], "lot long, new_house string")
    categories = readings.select("house", F.concat(F.lit("c"), F.col("age")).alias("category"))
    out = costing.production_detail(readings, [(sup, {"sup": "s"}, "sk", F.col("s") == -999)], categories, curve, moved, 42)
    assert optimised(out).count("__salt") >= 4
    got = {r["lot"]: r for r in out.collect()}
    assert len(got) == 200 and got[4]["house"] == "n" and got[4]["std_so_far"] is None and got[0]["categories"] is None
    assert got[1]["categories"] == "c0,c1,c2,c3,c4" and got[3]["std_so_far"] == 10.0
