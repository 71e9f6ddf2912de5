"""Queries over pivots, unpivots, ranked causes and gap filling."""

from __future__ import annotations

from pyspark.sql import functions as F

from farmledger.functions import fixed, week_of_life
from farmledger.operators import gaps, reshape
from farmledger.plans.registry import query
from farmledger.plans.standins import DAILY_READINGS, daily_readings, day, fx
from farmledger.sources.tables import Tables

# The event types, order states and order priorities of the driver tables.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
STATES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "pivot_explicit",
    """SELECT user_id, """ + ", ".join(f"MAX(CASE WHEN event_type = '{e}' THEN value END) AS \"{e}\"" for e in EVENT_TYPES) + " FROM events GROUP BY 1",
)
def pivot_explicit(t: Tables):
    return reshape.pivot(t.events, ["user_id"], "event_type", EVENT_TYPES, F.max("value"))


@query(
    "pivot_conditional",
    """SELECT o_custkey, ROUND(COALESCE(SUM(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice END), 0), 2) AS fast,
    ROUND(COALESCE(SUM(CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice END), 0), 2) AS medium,
    ROUND(COALESCE(SUM(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END), 0), 2) AS slow FROM orders GROUP BY 1""",
)
def pivot_conditional(t: Tables):
    columns = {"1-URGENT": "fast", "2-HIGH": "fast", "3-MEDIUM": "medium", "5-LOW": "slow"}
    out = reshape.pivot_case(t.orders, ["o_custkey"], "o_orderpriority", columns, "o_totalprice")
    return out.select("o_custkey", *[F.round(c, 2).alias(c) for c in ("fast", "medium", "slow")])


@query(
    "pivot_multi_measure",
    """SELECT o_custkey, """ + ", ".join(
        f"ROUND(COALESCE(SUM(CASE WHEN o_orderstatus = '{s}' THEN o_totalprice END), 0), 2) AS {s}_amount, "
        f"COALESCE(MAX(CASE WHEN o_orderstatus = '{s}' THEN o_totalprice END), 0) AS {s}_top" for s in STATES
    ) + " FROM orders GROUP BY 1",
)
def pivot_multi_measure(t: Tables):
    measures = {"amount": F.round(F.sum("o_totalprice"), 2), "top": F.max("o_totalprice")}
    return reshape.pivot_multi(t.orders, ["o_custkey"], "o_orderstatus", STATES, measures)


def _unpivoted(name_col: str, value_col: str, cols) -> str:
    return " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{c}' AS {name_col}, CAST({c} AS DOUBLE) AS {value_col} FROM lineitem WHERE {c} <> 0" for c in cols
    )


@query("unpivot_stack", _unpivoted("cause", "amount", ["l_quantity", "l_discount", "l_tax"]))
def unpivot_stack(t: Tables):
    return reshape.unpivot(
        t.lineitem, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"], "cause", "amount", drop_zero=True
    )


@query(
    "unpivot_map",
    """SELECT c_custkey, 'c_nationkey' AS attribute, CAST(c_nationkey AS DOUBLE) AS reading FROM customer UNION ALL
    SELECT c_custkey, 'c_acctbal', c_acctbal FROM customer""",
)
def unpivot_map(t: Tables):
    return reshape.unpivot(t.customer, ["c_custkey"], ["c_nationkey", "c_acctbal"], "attribute", "reading")


@query(
    "unpivot_structs",
    """SELECT p_partkey, 'p_size' AS indicator, CAST(p_size AS DOUBLE) AS amount FROM part UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part
    UNION ALL SELECT p_partkey, 'ratio', """ + fx("p_retailprice / p_size") + " FROM part",
)
def unpivot_structs(t: Tables):
    parts = t.part.withColumn("ratio", fixed(F.col("p_retailprice") / F.col("p_size")))
    return reshape.unpivot(parts, ["p_partkey"], ["p_size", "p_retailprice", "ratio"], "indicator", "amount")


@query(
    "top_n_with_others",
    f"""WITH c AS (SELECT l_suppkey, p_brand, SUM(l_quantity) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
    r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY q DESC, p_brand) AS rn FROM c)
    SELECT l_suppkey, MAX(CASE WHEN rn = 1 THEN p_brand END) AS name_1, MAX(CASE WHEN rn = 2 THEN p_brand END) AS name_2, MAX(CASE WHEN rn = 3 THEN p_brand END) AS name_3,
    MAX(CASE WHEN rn = 1 THEN q END) AS qty_1, MAX(CASE WHEN rn = 2 THEN q END) AS qty_2, MAX(CASE WHEN rn = 3 THEN q END) AS qty_3,
    {fx("MAX(CASE WHEN rn = 1 THEN q END) / SUM(q) * 100")} AS pct_1, {fx("MAX(CASE WHEN rn = 2 THEN q END) / SUM(q) * 100")} AS pct_2,
    {fx("MAX(CASE WHEN rn = 3 THEN q END) / SUM(q) * 100")} AS pct_3, COALESCE(SUM(CASE WHEN rn > 3 THEN q END), 0) AS qty_others, SUM(q) AS qty_total FROM r GROUP BY 1""",
)
def top_n_with_others(t: Tables):
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return reshape.top_n_others(t.lineitem.join(part, "l_partkey"), ["l_suppkey"], "p_brand", "l_quantity", 3)


_WEEKS = {1: "w1", 2: "w2", 3: "w3", 4: "w4", 5: "w5"}


@query(
    "list_then_pivot",
    """WITH c AS (SELECT user_id, CAST(floor((date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 7) / 7) AS INTEGER) AS week, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2, 3),
    l AS (SELECT user_id, week, string_agg(event_type, ',' ORDER BY event_type) AS names, string_agg(CAST(n AS VARCHAR), ',' ORDER BY event_type) AS counts FROM c GROUP BY 1, 2)
    SELECT user_id, """ + ", ".join(
        f"MAX(CASE WHEN week = {w} THEN names END) AS products_{n}, MAX(CASE WHEN week = {w} THEN counts END) AS lines_{n}" for w, n in _WEEKS.items()
    ) + " FROM l GROUP BY 1",
)
def list_then_pivot(t: Tables):
    age = F.datediff(day("ts"), F.lit("2024-01-01").cast("date")) + 1
    events = t.events.withColumn("week", week_of_life(age))
    return reshape.list_pivot(events, ["user_id"], "week", "event_type", "ts", _WEEKS)


@query(
    "stack_pairs",
    """SELECT l_orderkey, l_linenumber, 'gross' AS kind, l_extendedprice AS amount, l_tax AS rate FROM lineitem UNION ALL
    SELECT l_orderkey, l_linenumber, 'net', ROUND(l_extendedprice * (1 - l_discount), 4), l_discount FROM lineitem""",
)
def stack_pairs(t: Tables):
    net = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)
    pairs = {"gross": {"amount": "l_extendedprice", "rate": "l_tax"}, "net": {"amount": net, "rate": "l_discount"}}
    return reshape.stack_pairs(t.lineitem, ["l_orderkey", "l_linenumber"], pairs, "kind")


@query(
    "densify_tail",
    """WITH d AS (SELECT user_id, event_type, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS day, ROUND(SUM(value), 2) AS reading, COUNT(*) AS n_events FROM events GROUP BY 1, 2, 3),
    last AS (SELECT user_id, event_type, MAX(day) AS last_day, arg_max(reading, day) AS reading FROM d GROUP BY 1, 2), g AS (SELECT user_id, MAX(day) AS end_day FROM d GROUP BY 1),
    days AS (SELECT DISTINCT day FROM d)
    SELECT user_id, event_type, day, reading, n_events, 1 AS flag FROM d UNION ALL
    SELECT l.user_id, l.event_type, days.day, l.reading, 0, 2 FROM last l JOIN g ON l.user_id = g.user_id JOIN days ON days.day > l.last_day AND days.day <= g.end_day""",
)
def densify_tail(t: Tables):
    age = (F.datediff(day("ts"), F.lit("2024-01-01").cast("date")) + 1).cast("int").alias("day")
    readings = t.events.groupBy("user_id", "event_type", age).agg(
        F.round(F.sum("value"), 2).alias("reading"), F.count(F.lit(1)).alias("n_events")
    )
    return gaps.densify_tail(readings, ["user_id", "event_type"], ["user_id"], "day", ["reading"], ["n_events"])


@query(
    "densify_tail_calendar",
    """WITH d AS (SELECT l_suppkey AS lot, l_linenumber AS pen, CAST(l_shipdate AS DATE) AS day, SUM(l_quantity) AS qty, MAX(l_extendedprice) AS top FROM lineitem GROUP BY 1, 2, 3),
    last AS (SELECT lot, pen, MAX(day) AS last_day, arg_max(top, day) AS top FROM d GROUP BY 1, 2), g AS (SELECT lot, MAX(day) AS end_day FROM d GROUP BY 1),
    a AS (SELECT l.lot, l.pen, l.top, UNNEST(generate_series(CAST(l.last_day + 1 AS TIMESTAMP), CAST(g.end_day AS TIMESTAMP), INTERVAL 1 DAY)) AS day FROM last l JOIN g ON l.lot = g.lot)
    SELECT lot, pen, day, top, qty, 1 AS flag FROM d UNION ALL SELECT lot, pen, CAST(day AS DATE), top, 0.0, 2 FROM a""",
)
def densify_tail_calendar(t: Tables):
    daily = t.lineitem.groupBy(F.col("l_suppkey").alias("lot"), F.col("l_linenumber").alias("pen"), day("l_shipdate").alias("day")).agg(
        F.sum("l_quantity").alias("qty"), F.max("l_extendedprice").alias("top")
    )
    return gaps.densify_tail(daily, ["lot", "pen"], ["lot"], "day", ["top"], ["qty"])


_CURVE = f"(SELECT p_brand AS breed, p_size AS age, {fx('AVG(p_retailprice)')} AS std, ROUND(MAX(p_retailprice), 4) AS top FROM part GROUP BY 1, 2)"


def _curve(t: Tables):
    return t.part.groupBy(F.col("p_brand").alias("breed"), F.col("p_size").alias("age")).agg(
        fixed(F.avg("p_retailprice")).alias("std"), F.round(F.max("p_retailprice"), 4).alias("top")
    )


@query(
    "cap_standard",
    f"""WITH c AS {_CURVE} SELECT c.breed, c.age, CASE WHEN c.age > 40 AND c.breed <> 'Brand#1' THEN COALESCE(k.std, c.std) ELSE c.std END AS std,
    CASE WHEN c.age > 40 AND c.breed <> 'Brand#1' THEN COALESCE(k.top, c.top) ELSE c.top END AS top FROM c LEFT JOIN c k ON k.breed = c.breed AND k.age = 40""",
)
def cap_standard(t: Tables):
    return gaps.cap_standard(_curve(t), ["breed"], "age", ["std", "top"], 40, F.col("breed") != "Brand#1")


_CUT = f"(SELECT breed, age, CASE WHEN age > 42 THEN 0 ELSE std END AS std FROM {_CURVE})"


@query(
    "carry_last_valid",
    f"""WITH c AS {_CUT}, last AS (SELECT breed, arg_max(std, age) AS v FROM c WHERE std <> 0 GROUP BY 1)
    SELECT breed, age, CASE WHEN age > 42 AND std = 0 THEN COALESCE(v, std) ELSE std END AS std FROM c LEFT JOIN last USING (breed)""",
)
def carry_last_valid(t: Tables):
    cut = _curve(t).select("breed", "age", F.when(F.col("age") > 42, F.lit(0.0)).otherwise(F.col("std")).alias("std"))
    return gaps.carry_last_valid(cut, ["breed"], "age", "std", 42)


_STOPPED = f"(SELECT user_id, day, CASE WHEN day > 20 THEN 0 ELSE reading END AS reading FROM {DAILY_READINGS})"


@query(
    "extrapolate_linear",
    f"""WITH c AS {_STOPPED}, z AS (SELECT user_id, MIN(day) AS z FROM c WHERE reading = 0 GROUP BY 1),
    e AS (SELECT z.user_id, a.reading AS a, b.reading AS b FROM z LEFT JOIN c a ON a.user_id = z.user_id AND a.day = z.z - 1 LEFT JOIN c b ON b.user_id = z.user_id AND b.day = z.z - 2),
    p AS (SELECT user_id, day, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY day) AS p FROM c WHERE reading = 0)
    SELECT c.user_id, c.day, c.reading, ROUND(CASE WHEN c.reading = 0 THEN COALESCE(e.a + (e.a - e.b) * p.p, c.reading) ELSE c.reading END, 4) AS extended
    FROM c LEFT JOIN e USING (user_id) LEFT JOIN p ON p.user_id = c.user_id AND p.day = c.day""",
)
def extrapolate_linear(t: Tables):
    stopped = daily_readings(t).select(
        "user_id", "day", F.when(F.col("day") > 20, F.lit(0.0)).otherwise(F.col("reading")).alias("reading")
    )
    out = gaps.extrapolate_linear(stopped, ["user_id"], "day", "reading", "extended")
    return out.withColumn("extended", F.round("extended", 4))


@query(
    "growth_rate",
    f"""WITH d AS (SELECT user_id, MIN(day) AS day, reading FROM {DAILY_READINGS} WHERE reading <> 0 GROUP BY user_id, reading),
    l AS (SELECT *, LAG(reading) OVER w AS pv, LAG(day) OVER w AS pd FROM d WINDOW w AS (PARTITION BY user_id ORDER BY day))
    SELECT user_id, day, reading, {fx("COALESCE(reading - pv, 0)")} AS difference, CAST(COALESCE(day - pd, 0) AS INTEGER) AS days_between,
    COALESCE({fx("(reading - pv) / (day - pd)")}, 0) AS daily_gain FROM l""",
)
def growth_rate(t: Tables):
    return gaps.growth_rate(daily_readings(t), ["user_id"], "day", "reading")


@query(
    "cum_standard",
    f"""SELECT breed, age, {fx("SUM(std) OVER (PARTITION BY breed ORDER BY age ROWS UNBOUNDED PRECEDING)")} AS cumulative FROM {_CURVE}""",
)
def cum_standard(t: Tables):
    out = gaps.cum_standard(_curve(t), ["breed"], "age", "std", "cumulative")
    return out.select("breed", "age", fixed("cumulative").alias("cumulative"))


@query(
    "weekly_reading_fill",
    f"""WITH c AS (SELECT user_id, day, CASE WHEN n_events = 2 THEN 0 ELSE reading END AS reading FROM {DAILY_READINGS}),
    m AS (SELECT *, MAX(reading) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN CURRENT ROW AND 2 FOLLOWING) AS best FROM c)
    SELECT user_id, day, reading, CASE WHEN day IN (7, 14, 21, 28) AND reading = 0 THEN best ELSE reading END AS filled FROM m""",
)
def weekly_reading_fill(t: Tables):
    thinned = daily_readings(t).select(
        "user_id", "day", F.when(F.col("n_events") == 2, F.lit(0.0)).otherwise(F.col("reading")).alias("reading")
    )
    return gaps.weekly_reading_fill(thinned, ["user_id"], "day", "reading", 2, F.col("day").isin(7, 14, 21, 28), "filled")


@query(
    "backfill_from_group",
    """WITH x AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS attribute FROM orders)
    SELECT o_orderkey, o_custkey, COALESCE(attribute, MIN(attribute) OVER (PARTITION BY o_custkey)) AS attribute FROM x""",
)
def backfill_from_group(t: Tables):
    attribute = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    rows = t.orders.select("o_orderkey", "o_custkey", attribute.alias("attribute"))
    return gaps.backfill_from_group(rows, ["o_custkey"], "attribute")
