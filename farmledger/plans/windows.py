"""Queries over running and ranking operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from farmledger.functions import fixed
from farmledger.operators import agg as A
from farmledger.operators.ordered import (
    clock_slices,
    cumulate,
    cumulate_peers,
    dense_rank,
    previous,
    row_number,
    width_slice,
)
from farmledger.plans.registry import query
from farmledger.plans.standins import day, fx
from farmledger.sources.tables import Tables

_EVENTS = ["user_id", "ts", "event_id", "value", "event_type"]


def _round(df, *cols):
    return df.withColumns({c: F.round(c, 2) for c in cols})


@query(
    "win_row_number",
    """SELECT user_id, event_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position FROM events""",
)
def win_row_number(t: Tables):
    out = row_number(t.events.select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"], clock_slices("ts"), "position")
    return out.drop("ts")


@query(
    "win_dense_rank_over_agg",
    """WITH a AS (SELECT l_suppkey, l_partkey, SUM(l_quantity) AS qty FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey, l_partkey, ROUND(qty, 2) AS qty, CAST(DENSE_RANK() OVER (PARTITION BY l_suppkey ORDER BY qty) AS INTEGER) AS rank FROM a""",
)
def win_dense_rank_over_agg(t: Tables):
    totals = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.round(F.sum("l_quantity"), 2).alias("qty"))
    return dense_rank(totals, ["l_suppkey"], ["qty"], [width_slice("qty", 25)], "rank")


@query(
    "win_lag_delta",
    """SELECT user_id, event_id, COALESCE(ROUND(value - LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 2), 0) AS delta FROM events""",
)
def win_lag_delta(t: Tables):
    seq = previous(t.events.select(*_EVENTS), ["user_id"], ["ts", "event_id"], clock_slices("ts"), {"before": "value"})
    delta = F.coalesce(F.round(F.col("value") - F.col("before"), 2), F.lit(0.0))
    return seq.select("user_id", "event_id", delta.alias("delta"))


@query(
    "win_running_sum_rows",
    """SELECT user_id, event_id, ROUND(SUM(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 2) AS running FROM events""",
)
def win_running_sum_rows(t: Tables):
    run = cumulate(
        t.events.select("user_id", "ts", "event_id", "value"), ["user_id"], ["ts", "event_id"], clock_slices("ts"),
        {"running": ("sum", "value")},
    )
    return _round(run, "running").drop("ts", "value")


@query(
    "win_running_sum_range",
    """SELECT l_suppkey, l_orderkey, l_linenumber, ROUND(SUM(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate), 2) AS running FROM lineitem""",
)
def win_running_sum_range(t: Tables):
    lines = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", day("l_shipdate").alias("d"))
    run = cumulate_peers(lines, ["l_suppkey"], "d", {"running": ("sum", "l_quantity")})
    return _round(run, "running").drop("d", "l_quantity")


@query(
    "win_agg_then_running",
    """WITH a AS (SELECT l_suppkey, strftime(l_shipdate, '%Y%m') AS month_id, SUM(l_quantity) AS qty FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey, month_id, ROUND(qty, 2) AS qty, ROUND(SUM(qty) OVER (PARTITION BY l_suppkey ORDER BY month_id), 2) AS running FROM a""",
)
def win_agg_then_running(t: Tables):
    month = F.trunc(day("l_shipdate"), "month").alias("month")
    monthly = t.lineitem.groupBy("l_suppkey", month).agg(F.sum("l_quantity").alias("qty"))
    run = cumulate(monthly, ["l_suppkey"], ["month"], [], {"running": ("sum", "qty")})
    return _round(run, "qty", "running").select("l_suppkey", F.date_format("month", "yyyyMM").alias("month_id"), "qty", "running")


@query(
    "win_partition_total",
    f"""SELECT l_orderkey, l_linenumber, l_suppkey, ROUND(SUM(l_quantity) OVER (PARTITION BY l_suppkey), 2) AS supplier_total,
    {fx("l_quantity / SUM(l_quantity) OVER (PARTITION BY l_suppkey) * 100", 6)} AS pct FROM lineitem""",
)
def win_partition_total(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    out = A.with_total(lines, ["l_suppkey"], {"supplier_total": "l_quantity"})
    pct = fixed(F.col("l_quantity") / F.col("supplier_total") * 100, 6)
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", F.round("supplier_total", 2).alias("supplier_total"), pct.alias("pct"))


@query(
    "win_conditional_sum",
    """SELECT user_id, event_id, ROUND(COALESCE(SUM(CASE WHEN event_type = 'purchase' THEN value END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 0), 2) AS bought,
    COUNT(CASE WHEN event_type = 'error' THEN 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS errors FROM events""",
)
def win_conditional_sum(t: Tables):
    kind = F.col("event_type")
    run = cumulate(
        t.events.select(*_EVENTS), ["user_id"], ["ts", "event_id"], clock_slices("ts"),
        {"bought": ("sum", F.when(kind == "purchase", F.col("value"))), "errors": ("count", F.when(kind == "error", 1))},
    )
    return run.select("user_id", "event_id", F.round(F.coalesce("bought", F.lit(0.0)), 2).alias("bought"), "errors")


@query(
    "win_prev_max_gain",
    """SELECT user_id, event_id, COALESCE(ROUND(value - MAX(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 2), 0) AS gain FROM events""",
)
def win_prev_max_gain(t: Tables):
    run = cumulate(
        t.events.select(*_EVENTS), ["user_id"], ["ts", "event_id"], clock_slices("ts"),
        {"best": ("max", "value")}, exclude_current=True,
    )
    gain = F.coalesce(F.round(F.col("value") - F.col("best"), 2), F.lit(0.0))
    return run.select("user_id", "event_id", gain.alias("gain"))


@query(
    "win_phase_running",
    """WITH d AS (SELECT l_suppkey AS lot, l_linenumber AS pen, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS phase, CAST(l_shipdate AS DATE) AS d, SUM(l_quantity) AS qty FROM lineitem GROUP BY 1, 2, 3, 4),
    l AS (SELECT lot, phase, d, SUM(qty) AS qty FROM d GROUP BY 1, 2, 3),
    r AS (SELECT lot, phase, d, SUM(qty) OVER (PARTITION BY lot, phase ORDER BY d) AS running FROM l)
    SELECT d.lot, d.pen, d.phase, d.d AS day, ROUND(SUM(d.qty) OVER (PARTITION BY d.lot, d.pen, d.phase ORDER BY d.d), 2) AS pen_running, ROUND(r.running, 2) AS lot_running
    FROM d JOIN r ON d.lot = r.lot AND d.phase = r.phase AND d.d = r.d""",
)
def win_phase_running(t: Tables):
    phase = F.when(F.col("l_linestatus") == "O", 1).otherwise(2).alias("phase")
    daily = t.lineitem.groupBy(
        F.col("l_suppkey").alias("lot"), F.col("l_linenumber").alias("pen"), phase, day("l_shipdate").alias("day")
    ).agg(F.sum("l_quantity").alias("qty"))
    pens = cumulate(daily, ["lot", "pen", "phase"], ["day"], [], {"pen_running": ("sum", "qty")})
    lots = cumulate(
        daily.groupBy("lot", "phase", "day").agg(F.sum("qty").alias("qty")), ["lot", "phase"], ["day"],
        [], {"lot_running": ("sum", "qty")},
    ).drop("qty")
    return _round(pens.join(lots, ["lot", "phase", "day"]), "pen_running", "lot_running").drop("qty")


@query(
    "win_running_max",
    """SELECT user_id, event_id, MAX(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS best,
    MIN(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS worst FROM events""",
)
def win_running_max(t: Tables):
    run = cumulate(
        t.events.select(*_EVENTS), ["user_id"], ["ts", "event_id"], clock_slices("ts"),
        {"best": ("max", "value"), "worst": ("min", "value")},
    )
    return run.select("user_id", "event_id", "best", "worst")
