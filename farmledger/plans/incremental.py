"""Queries over stored state, rule tables, dated moves and long spans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farmledger.operators import incremental, joins
from farmledger.operators.ordered import width_slice
from farmledger.operators.rules import classify
from farmledger.plans.registry import query
from farmledger.plans.standins import AS_OF, FARM_LINES, farm_lines
from farmledger.session import scratch_path
from farmledger.sources.tables import Tables


def _stored(t: Tables, df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(t.spark, label)
    df.write.parquet(path)
    return t.spark.read.schema(df.schema).parquet(path)


@query(
    "sweep_join_open_spans",
    """WITH s AS (SELECT o_custkey, o_orderkey AS lot, o_orderdate AS lo, CASE WHEN o_orderkey % 10 = 0 THEN TIMESTAMP '9999-12-31 00:00:00' ELSE o_orderdate + INTERVAL 200 DAY END AS hi FROM orders),
    e AS (SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_shipdate, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
    SELECT e.o_custkey, e.l_orderkey, e.l_linenumber, e.l_quantity, s.lot FROM e JOIN s ON e.o_custkey = s.o_custkey AND e.l_shipdate BETWEEN s.lo AND s.hi""",
)
def sweep_join_open_spans(t: Tables):
    """Lines in the spans of their farm's lots, a tenth of which never end."""
    owner = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    events = t.lineitem.join(owner, "l_orderkey").select("o_custkey", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    never = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    lo = F.col("o_orderdate")
    hi = F.when(F.col("o_orderkey") % 10 == 0, never).otherwise(lo + F.expr("interval 200 days"))
    spans = t.orders.select("o_custkey", F.col("o_orderkey").alias("lot"), lo.alias("lo"), hi.alias("hi"))
    return joins.sweep_join(events, spans, ["o_custkey"], "l_shipdate", "lo", "hi", 4096).drop("l_shipdate", "lo", "hi")


# Each lot moves to the next one (by number within its farm) 300 days after it was placed, when that is placed by then.
_MOVES = """(SELECT o_orderkey AS src, dst, CAST(o_orderdate AS DATE) + 300 AS moved_on FROM (SELECT o_orderkey, o_orderdate,
    lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS dst FROM orders) WHERE dst IS NOT NULL)"""


@query(
    "reattribute_dated",
    f"""WITH RECURSIVE moves AS {_MOVES},
    walk(l_orderkey, l_linenumber, l_quantity, day, place, since, hops) AS (
        SELECT DISTINCT l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS DATE), l_orderkey, DATE '0001-01-01', 0 FROM lineitem
        UNION ALL SELECT w.l_orderkey, w.l_linenumber, w.l_quantity, w.day, m.dst, m.moved_on, w.hops + 1
        FROM walk w JOIN moves m ON m.src = w.place AND m.moved_on >= w.since AND m.moved_on <= w.day)
    SELECT l_orderkey, l_linenumber, l_quantity, day, arg_max(place, hops) AS place FROM walk GROUP BY 1, 2, 3, 4""",
)
def reattribute_dated(t: Tables):
    """Lines under the lot that their lot has become by the day of shipment, over any number of moves."""
    after = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    moves = t.orders.select(F.col("o_orderkey").alias("src"), after.alias("dst"), F.date_add(F.col("o_orderdate").cast("date"), 300).alias("moved_on")).where("dst IS NOT NULL")
    resolved = joins.resolved_moves(moves, "src", "dst", "moved_on")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_shipdate").cast("date").alias("day")).distinct()
    return joins.reattribute_dated(lines, resolved, "l_orderkey", "day", "src", "dst", "place")


SINCE = dt.date(2001, 1, 1)


@query(
    "running_total_from_balances",
    """SELECT * FROM (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day, COUNT(*) OVER w AS n_lots,
    SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) OVER w AS cents FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)) WHERE day >= DATE '2001-01-01'""",
)
def running_total_from_balances(t: Tables):
    """Running totals of the last months from the stored balances of the earlier ones; those are themselves carried on."""
    rows = t.orders.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), F.round(F.col("o_totalprice") * 100).cast("long").alias("value"))
    rows = rows.withColumn("month", F.trunc("day", "month"))
    sums = {"n_lots": F.lit(1), "cents": F.col("value")}
    early, later = F.col("day") < F.lit(dt.date(2000, 1, 1)), (F.col("day") >= F.lit(dt.date(2000, 1, 1))) & (F.col("day") < F.lit(SINCE))
    first = _stored(t, incremental.closing_balances(rows.where(early), ["o_custkey"], "month", sums), "balances")
    second = _stored(t, incremental.closing_balances(rows.where(later), ["o_custkey"], "month", sums, first), "balances")
    window = rows.where(F.col("day") >= F.lit(SINCE))
    run = incremental.cumulate_on(window, first.unionByName(second), ["o_custkey"], ["day", "o_orderkey"], [width_slice(F.datediff("day", F.lit(SINCE)), 32)], "month", sums, SINCE)
    return run.select("o_custkey", "o_orderkey", "day", F.col("n_lots").cast("long").alias("n_lots"), "cents")


_LEVELS = [("lot", ["month_id", "zone", "farm", "l_orderkey"]), ("farm", ["month_id", "zone", "farm"]), ("zone", ["month_id", "zone"])]


@query(
    "rollup_one_month_change",
    f"""WITH after AS (SELECT strftime(l_shipdate, '%Y%m') AS month_id, zone, farm, l_orderkey, CASE WHEN strftime(l_shipdate, '%Y%m') = '200003' THEN 2 * l_quantity ELSE l_quantity END AS q
    FROM {FARM_LINES} WHERE NOT (strftime(l_shipdate, '%Y%m') = '200003' AND l_returnflag = 'A'))
    SELECT 'lot' AS level, month_id, zone, farm, l_orderkey, CAST(SUM(q) AS BIGINT) AS quantity, COUNT(*) AS n_rows FROM after GROUP BY ALL
    UNION ALL SELECT 'farm', month_id, zone, farm, NULL, CAST(SUM(q) AS BIGINT), COUNT(*) FROM after GROUP BY ALL
    UNION ALL SELECT 'zone', month_id, zone, NULL, NULL, CAST(SUM(q) AS BIGINT), COUNT(*) FROM after GROUP BY ALL""",
)
def rollup_one_month_change(t: Tables):
    """Three levels after one month's lines have changed: only the keys that change are computed anew at each level."""
    lines = farm_lines(t).select(F.date_format("l_shipdate", "yyyyMM").alias("month_id"), "zone", "farm", "l_orderkey", "l_returnflag", F.col("l_quantity").cast("long").alias("quantity"))
    before = lines.where("month_id = '200003'")
    after = before.where("l_returnflag <> 'A'").withColumn("quantity", F.col("quantity") * 2)
    sums = {"quantity": F.col("quantity")}
    change = _stored(t, incremental.change_sums(before, after, _LEVELS[0][1], sums), "change")
    changes = incremental.rollup_changes(change, _LEVELS, list(sums))
    out = None
    current = lines
    for name, keys in _LEVELS:
        current = _stored(t, current.groupBy(*keys).agg(F.sum("quantity").alias("quantity"), (F.sum("n_rows") if "n_rows" in current.columns else F.count(F.lit(1))).alias("n_rows")), f"level-{name}")
        fresh = incremental.merge_level(current, changes[name], keys, list(sums))
        kept = current.join(changes[name].select(*keys), keys, "left_anti")
        rows = kept.unionByName(fresh.select(*kept.columns)).withColumn("level", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out.select("level", "month_id", "zone", "farm", "l_orderkey", "quantity", "n_rows")


@query(
    "distinct_by_level",
    f"""SELECT 'lot' AS level, zone, farm, l_orderkey, COUNT(DISTINCT l_partkey) AS n_products FROM {FARM_LINES} GROUP BY ALL
    UNION ALL SELECT 'farm', zone, farm, NULL, COUNT(DISTINCT l_partkey) FROM {FARM_LINES} GROUP BY ALL
    UNION ALL SELECT 'zone', zone, NULL, NULL, COUNT(DISTINCT l_partkey) FROM {FARM_LINES} GROUP BY ALL""",
)
def distinct_by_level(t: Tables):
    levels = [(name, [k for k in keys if k != "month_id"]) for name, keys in _LEVELS]
    counted = incremental.distinct_by_level(farm_lines(t), levels, "l_partkey", "n_products")
    rows = [df.withColumn("level", F.lit(name)) for name, df in counted.items()]
    out = rows[0].unionByName(rows[1], allowMissingColumns=True).unionByName(rows[2], allowMissingColumns=True)
    return out.select("level", "zone", "farm", "l_orderkey", "n_products")


_RULES = """(SELECT * FROM (VALUES (1, 'A', 'F', NULL, NULL, 'closed'), (2, 'R', NULL, 45, NULL, 'large return'), (3, 'R', NULL, NULL, 5, 'small return'),
    (4, NULL, 'O', 1, 25, 'open, small'), (5, 'R', 'F', NULL, NULL, 'return'), (6, NULL, 'O', NULL, NULL, 'open'), (9, NULL, NULL, 50, 50, 'rest')) r(priority, flag, status, lo, hi, kind))"""


@query(
    "classify_by_rules",
    f"""SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_partkey, l.l_shipdate AS shipped, COALESCE((SELECT arg_min(kind, priority) FROM {_RULES} r WHERE (r.flag IS NULL OR r.flag = l.l_returnflag) AND (r.status IS NULL OR r.status = l.l_linestatus)
    AND (r.lo IS NULL OR l.l_quantity >= r.lo) AND (r.hi IS NULL OR l.l_quantity <= r.hi)), 'other') AS kind FROM lineitem l""",
)
def classify_by_rules(t: Tables):
    """Lines classified by a table of rules with wildcards, ranges and priorities."""
    rows = [(1, "A", "F", None, None, "closed"), (2, "R", None, 45.0, None, "large return"), (3, "R", None, None, 5.0, "small return"), (4, None, "O", 1.0, 25.0, "open, small"),
            (5, "R", "F", None, None, "return"), (6, None, "O", None, None, "open"), (9, None, None, 50.0, 50.0, "rest")]
    rules = t.spark.createDataFrame(rows, "priority int, l_returnflag string, l_linestatus string, lo double, hi double, kind string")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", F.col("l_shipdate").alias("shipped"), "l_returnflag", "l_linestatus")
    return classify(lines, rules, ["l_returnflag", "l_linestatus"], "kind", "kind", ranged="l_quantity", default="other").drop("l_returnflag", "l_linestatus")


@query(
    "publish_missing_cycles",
    f"""WITH unit AS (SELECT zone, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM {FARM_LINES} WHERE l_shipdate < TIMESTAMP '2001-08-01 00:00:00' GROUP BY ALL),
    months AS (SELECT DISTINCT month FROM unit)
    SELECT u.zone, u.month, u.quantity, 'C' || strftime(m.month + INTERVAL 1 MONTH, '%m') AS cycle FROM unit u JOIN months m ON m.month >= u.month
    WHERE (u.month >= DATE '2000-06-01' AND m.month < DATE '2001-07-01') OR (u.month >= DATE '2000-08-01') GROUP BY ALL""",
)
def publish_missing_cycles(t: Tables):
    """Two runs, in June and in August: the second appends the cycles that its months lack and rewrites nothing."""
    lines = farm_lines(t).select("zone", F.trunc("l_shipdate", "month").alias("month"), F.col("l_quantity").cast("long").alias("quantity"))
    path = scratch_path(t.spark, "cycles")
    schema = "zone int, quantity long, month date, cycle string"
    t.spark.createDataFrame([], schema).write.partitionBy("month", "cycle").parquet(path)
    for as_of, closed_before in ((dt.date(2001, 6, 30), dt.date(2001, 7, 1)), (AS_OF, AS_OF)):
        recent = lines.where((F.col("month") >= F.add_months(F.trunc(F.lit(as_of), "month"), -12)) & (F.col("month") < F.lit(closed_before)))
        unit = recent.groupBy("zone", "month").agg(F.sum("quantity").alias("quantity"))
        published = t.spark.read.schema(schema).parquet(path).select("month", "cycle").distinct()  # from the partitions' names
        missing = _stored(t, incremental.missing_cycles(unit.select("month"), published, "month", "cycle", as_of), "missing")
        incremental.publish_missing(unit, missing, "month", "cycle").write.mode("append").partitionBy("month", "cycle").parquet(path)
    return t.spark.read.schema(schema).parquet(path).select("zone", "month", "quantity", "cycle")
