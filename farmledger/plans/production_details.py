"""Further production jobs over the driver tables; see :mod:`farmledger.plans.production_queries` for the mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from farmledger.functions import fixed, week_of_life
from farmledger.operators import reshape
from farmledger.plans import production as P
from farmledger.plans.production_queries import CAUSES, FIELD_DAYS, FIELD_LINES, field_days, field_lines, heads_of
from farmledger.plans.registry import query
from farmledger.plans.standins import day, fx
from farmledger.sources.tables import Tables


@query(
    "plan_mortality_monthly",
    f"""WITH {FIELD_DAYS} SELECT CAST(scope AS INTEGER) AS scope, zone, strftime(day, '%Y%m') AS month_id, SUM(deaths) AS deaths, COUNT(DISTINCT (lot, house, pen)) AS pens
    FROM field_days JOIN (VALUES (2), (1)) s(scope) ON scope = 2 OR weight <= 0.08 GROUP BY 1, 2, 3""",
)
def plan_mortality_monthly(t: Tables):
    return P.mortality_monthly(field_days(t), F.col("weight") <= 0.08)


@query(
    "plan_mortality_lot_week",
    f"""WITH {FIELD_DAYS}, d AS (SELECT zone, lot, CAST(floor((age + 6) / 7) AS INTEGER) AS week, SUM(deaths) AS deaths FROM field_days GROUP BY ALL),
    r AS (SELECT *, SUM(deaths) OVER (PARTITION BY zone, lot ORDER BY week) AS s FROM d), last AS (SELECT zone, lot, MAX(week) AS w, arg_max(s, week) AS s FROM r GROUP BY ALL), g AS (SELECT zone, MAX(week) AS e FROM r GROUP BY ALL)
    SELECT zone, lot, week, deaths, s AS deaths_so_far, 1 AS flag FROM r UNION ALL
    SELECT zone, lot, CAST(UNNEST(generate_series(w + 1, e)) AS INTEGER), 0.0, s, 2 FROM last JOIN g USING (zone)""",
)
def plan_mortality_lot_week(t: Tables):
    return P.mortality_lot_week(field_days(t))


_RUN = ", ".join(f"SUM({c}) OVER (PARTITION BY zone, lot ORDER BY week) AS {c}" for c in CAUSES)
_LONG = " UNION ALL ".join(f"SELECT zone, lot, week, '{c}' AS cause, {c} AS q FROM r" for c in CAUSES)


@query(
    "plan_mortality_causes_running",
    f"""WITH {FIELD_DAYS}, w AS (SELECT zone, lot, CAST(floor((age + 6) / 7) AS INTEGER) AS week, {", ".join(f"SUM({c}) AS {c}" for c in CAUSES)} FROM field_days GROUP BY 1, 2, 3),
    r AS (SELECT zone, lot, week, {_RUN} FROM w), l AS (SELECT * FROM ({_LONG}) WHERE q <> 0), k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY zone, lot, week ORDER BY q DESC, cause) AS rn FROM l)
    SELECT zone, lot, week, """ + ", ".join(
        f"MAX(CASE WHEN rn = {i} THEN cause END) AS name_{i}, MAX(CASE WHEN rn = {i} THEN q END) AS qty_{i}, {fx(f'MAX(CASE WHEN rn = {i} THEN q END) / SUM(q) * 100')} AS pct_{i}" for i in (1, 2, 3)
    ) + ", COALESCE(SUM(CASE WHEN rn > 3 THEN q END), 0) AS qty_others, SUM(q) AS qty_total FROM k GROUP BY zone, lot, week",
)
def plan_mortality_causes_running(t: Tables):
    return P.mortality_causes_running(field_days(t), CAUSES, ["zone", "lot"])


@query(
    "plan_sales_detail",
    """WITH s AS (SELECT o_custkey, o_orderkey AS lot, o_orderdate AS lo, o_orderdate + INTERVAL 45 DAY AS hi FROM orders),
    e AS (SELECT o_custkey, l_orderkey, l_linenumber, l_shipdate + to_seconds(CASE l_linenumber % 3 WHEN 0 THEN 43199 WHEN 1 THEN 0 ELSE 55800 END) AS stamp, CASE WHEN l_linestatus = 'F' THEN l_partkey END AS product
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    j AS (SELECT e.*, s.lot, s.lo FROM e JOIN s ON e.o_custkey = s.o_custkey AND e.stamp BETWEEN s.lo AND s.hi)
    SELECT l_orderkey, l_linenumber, lot, CAST(date_diff('day', CAST(lo AS DATE), CAST(stamp AS DATE)) + CASE WHEN l_linenumber % 3 = 2 THEN 1 ELSE 0 END AS INTEGER) AS age, COALESCE(product, MIN(product) OVER (PARTITION BY lot)) AS product FROM j""",
)
def plan_sales_detail(t: Tables):
    owner = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    # a third of the loads carry the marker for "no time recorded", a third midnight, a third a time of day
    seconds = F.when(F.col("l_linenumber") % 3 == 0, 43199).when(F.col("l_linenumber") % 3 == 1, 0).otherwise(55800)
    stamp = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    loads = t.lineitem.join(owner, "l_orderkey").select(
        "o_custkey", "l_orderkey", "l_linenumber", stamp.alias("loaded_at"),
        F.when(F.col("l_linestatus") == "F", F.col("l_partkey")).alias("product"),
    )
    spans = t.orders.select(
        "o_custkey", F.col("o_orderkey").alias("lot"), F.col("o_orderdate").alias("lo"),
        (F.col("o_orderdate") + F.expr("interval 45 days")).alias("hi"),
    )
    out = P.sales_detail(loads, spans, ["o_custkey"], ((11, 59, 59), (11, 59, 0), (11, 29, 0)))
    return out.select("l_orderkey", "l_linenumber", "lot", "age", "product")


_WEEK_CURVE = f"(SELECT p_brand AS breed, p_size AS week, {fx('AVG(p_retailprice)')} AS std FROM part GROUP BY 1, 2)"


def _week_curve(t: Tables):
    return t.part.groupBy(F.col("p_brand").alias("breed"), F.col("p_size").alias("week")).agg(fixed(F.avg("p_retailprice")).alias("std"))


def _bred_days(t: Tables):
    """Field lines as breeder days; the line's brand is the breed."""
    return field_lines(t).select(*P.PEN, "day", "age", F.col("heads").alias("deaths"), (F.col("heads") * 2).alias("feed"), F.col("formula").alias("breed"))


@query(
    "plan_breeder_weekly",
    f"""WITH {FIELD_LINES}, c AS {_WEEK_CURVE}, k AS (SELECT c.breed, c.week, CASE WHEN c.week > 40 AND c.breed <> 'Brand#1' THEN COALESCE(x.std, c.std) ELSE c.std END AS std FROM c LEFT JOIN c x ON x.breed = c.breed AND x.week = 40),
    w AS (SELECT zone, lot, house, formula AS breed, CAST(floor((age + 6) / 7) AS INTEGER) AS week, SUM(heads) AS deaths, SUM(heads * 2) AS feed FROM field_lines GROUP BY ALL)
    SELECT w.*, COALESCE(w.feed - p.feed, 0) AS feed_change, k.std FROM w LEFT JOIN w p ON w.zone = p.zone AND w.lot = p.lot AND w.house = p.house AND w.breed = p.breed AND p.week = w.week - 1 LEFT JOIN k ON k.breed = w.breed AND k.week = w.week""",
)
def plan_breeder_weekly(t: Tables):
    return P.breeder_weekly(_bred_days(t), _week_curve(t), 40, F.col("breed") != "Brand#1")


@query(
    "plan_breeder_liquidation",
    f"""WITH {FIELD_DAYS}, p AS (SELECT zone, lot, house, pen, SUM(deaths) AS deaths, MAX(age) AS age, MAX(day) AS closed_on FROM field_days GROUP BY ALL)
    SELECT zone, lot, MAX(closed_on) AS closed_on, SUM(deaths) AS deaths, {fx("SUM(age * deaths) / SUM(deaths)")} AS closing_age FROM p GROUP BY 1, 2""",
)
def plan_breeder_liquidation(t: Tables):
    return P.breeder_liquidation(field_days(t))


@query(
    "plan_consolidated_daily",
    f"""WITH {FIELD_DAYS}, d AS (SELECT zone, lot, house, pen, age, SUM(deaths) AS deaths FROM field_days GROUP BY ALL), c AS (SELECT *, CAST(100000 AS DOUBLE) - SUM(deaths) OVER (PARTITION BY zone, lot, house, pen ORDER BY age) AS closing FROM d)
    SELECT c.zone, c.lot, c.house, c.pen, c.age, c.deaths, CAST(100000 AS DOUBLE) AS heads, p.closing AS opening, COALESCE({fx("c.deaths / NULLIF(p.closing, 0) * 100")}, 0) AS mort_pct
    FROM c LEFT JOIN c p ON p.zone = c.zone AND p.lot = c.lot AND p.house = c.house AND p.pen = c.pen AND p.age = c.age - 1""",
)
def plan_consolidated_daily(t: Tables):
    return P.consolidated_daily(field_days(t), heads_of(t))


@query(
    "plan_consolidated_monthly",
    f"""WITH {FIELD_LINES}, l AS (SELECT zone, lot, MAX(day) AS d, SUM(heads) AS sold, SUM(kilos) AS kilos, SUM(age * heads) AS x FROM field_lines WHERE status = 'F' GROUP BY ALL)
    SELECT zone, strftime(d, '%Y%m') AS month_id, COUNT(*) AS lots, SUM(sold) AS sold, {fx("SUM(kilos) / SUM(sold)")} AS weight, {fx("SUM(x) / SUM(sold)")} AS sale_age FROM l GROUP BY 1, 2""",
)
def plan_consolidated_monthly(t: Tables):
    return P.consolidated_monthly(field_lines(t).where(F.col("status") == "F"))


@query(
    "plan_idle_days",
    """WITH r AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS placed, CAST(o_orderdate AS DATE) + 5 AS closed, DENSE_RANK() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE)) AS campaign FROM orders),
    c AS (SELECT o_custkey, campaign, MIN(placed) AS s, MAX(closed) AS e FROM r GROUP BY 1, 2)
    SELECT r.o_custkey, r.o_orderkey, CAST(r.campaign AS INTEGER) AS campaign, CAST(date_diff('day', p.e, c.s) AS INTEGER) AS idle_days FROM r JOIN c USING (o_custkey, campaign) LEFT JOIN c p ON p.o_custkey = r.o_custkey AND p.campaign = r.campaign - 1""",
)
def plan_idle_days(t: Tables):
    lots = t.orders.select("o_custkey", "o_orderkey", day("o_orderdate").alias("placed"), F.date_add(day("o_orderdate"), 5).alias("closed"))
    return P.idle_days(lots, ["o_custkey"], "placed", "closed").select("o_custkey", "o_orderkey", "campaign", "idle_days")


_STD_WEEKS = {10: "w10", 20: "w20", 30: "w30", 40: "w40"}


def _std_level(name: str, keys: str) -> str:
    return f"{name} AS (SELECT {keys}, week, COALESCE({fx('SUM(std * heads) / NULLIF(SUM(CASE WHEN std <> 0 THEN heads END), 0)')}, 0) AS v FROM x GROUP BY ALL)"


@query(
    "plan_weighted_standards",
    f"""WITH {FIELD_LINES}, c AS {_WEEK_CURVE}, p AS (SELECT DISTINCT zone, lot, house, pen, formula AS breed, CAST(floor((age + 6) / 7) AS INTEGER) AS week FROM field_lines),
    x AS (SELECT p.*, CAST(100000 AS DOUBLE) AS heads, COALESCE(c.std, 0) AS std FROM p LEFT JOIN c ON c.breed = p.breed AND c.week = p.week WHERE p.week IN (10, 20, 30, 40)),
    {_std_level("a", "zone, lot, house, pen")}, {_std_level("b", "zone, lot, house")}, {_std_level("d", "zone, lot")}
    SELECT a.zone, a.lot, a.house, a.pen, """ + ", ".join(
        f"COALESCE(MAX(CASE WHEN a.week = {w} THEN {alias}.v END), 0) AS std_{level}_{label}" for w, label in _STD_WEEKS.items() for alias, level in (("a", "pen"), ("b", "house"), ("d", "lot"))
    ) + " FROM a JOIN b ON a.zone = b.zone AND a.lot = b.lot AND a.house = b.house AND a.week = b.week JOIN d ON a.zone = d.zone AND a.lot = d.lot AND a.week = d.week GROUP BY 1, 2, 3, 4",
)
def plan_weighted_standards(t: Tables):
    return P.weighted_standards(_bred_days(t), heads_of(t), _week_curve(t), _STD_WEEKS)


@query(
    "plan_weighted_standards_weeks",
    f"""WITH {FIELD_LINES}, c AS {_WEEK_CURVE}, p AS (SELECT DISTINCT zone, lot, house, pen, formula AS breed, CAST(floor((age + 6) / 7) AS INTEGER) AS week FROM field_lines),
    x AS (SELECT p.*, CAST(100000 AS DOUBLE) AS heads, COALESCE(c.std, 0) AS std FROM p LEFT JOIN c ON c.breed = p.breed AND c.week = p.week),
    {_std_level("a", "zone, lot, house, pen")}, {_std_level("b", "zone, lot, house")}, {_std_level("d", "zone, lot")}
    SELECT a.zone, a.lot, a.house, a.pen, a.week, a.v AS std_pen, b.v AS std_house, d.v AS std_lot
    FROM a JOIN b ON a.zone = b.zone AND a.lot = b.lot AND a.house = b.house AND a.week = b.week JOIN d ON a.zone = d.zone AND a.lot = d.lot AND a.week = d.week""",
)
def plan_weighted_standards_weeks(t: Tables):
    """All weeks of life, one row each; ``plan_weighted_standards`` has four of them, as its SQL twin asks."""
    return P.weighted_standards_weeks(_bred_days(t), heads_of(t), _week_curve(t))


_MED_WEEKS = {100: "w1", 101: "w2", 102: "w3"}


@query(
    "plan_medication",
    f"""WITH {FIELD_LINES}, c AS (SELECT zone, lot, CAST(floor((age + 6) / 7) AS INTEGER) AS week, formula, COUNT(*) AS n FROM field_lines GROUP BY ALL),
    l AS (SELECT zone, lot, week, string_agg(formula, ',' ORDER BY formula) AS names, string_agg(CAST(n AS VARCHAR), ',' ORDER BY formula) AS counts FROM c GROUP BY ALL)
    SELECT zone, lot, """ + ", ".join(f"MAX(CASE WHEN week = {w} THEN names END) AS products_{n}, MAX(CASE WHEN week = {w} THEN counts END) AS lines_{n}" for w, n in _MED_WEEKS.items()) + " FROM l GROUP BY 1, 2",
)
def plan_medication(t: Tables):
    lines = field_lines(t).withColumn("week", week_of_life("age"))
    return reshape.list_pivot(lines, ["zone", "lot"], "week", "formula", "day", _MED_WEEKS)


@query(
    "plan_medication_weeks",
    f"""WITH {FIELD_LINES}, c AS (SELECT zone, lot, CAST(floor((age + 6) / 7) AS INTEGER) AS week, formula, COUNT(*) AS n FROM field_lines GROUP BY ALL)
    SELECT zone, lot, week, string_agg(formula, ',' ORDER BY formula) AS products, string_agg(CAST(n AS VARCHAR), ',' ORDER BY formula) AS lines FROM c GROUP BY ALL""",
)
def plan_medication_weeks(t: Tables):
    """All weeks of life, one row each; ``plan_medication`` has columns for three of them, as its SQL twin asks."""
    return reshape.list_weeks(field_lines(t).withColumn("week", week_of_life("age")), ["zone", "lot"], "week", "formula", "day")


@query(
    "plan_water_use",
    f"""WITH u AS (SELECT l_orderkey, SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS q, SUM(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS k FROM lineitem GROUP BY 1)
    SELECT o_orderkey AS entity, COALESCE({fx("COALESCE(q, 0) * 1000 / NULLIF(CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE COALESCE(k, 0) END, 0)")}, 0) AS water FROM orders LEFT JOIN u ON o_orderkey = l_orderkey""",
)
def plan_water_use(t: Tables):
    placements = t.orders.select(F.col("o_orderkey").alias("entity"), F.col("o_totalprice").alias("heads"), "o_orderstatus")
    use = t.lineitem.where(F.col("l_returnflag") == "N").select(F.col("l_orderkey").alias("entity"), F.col("l_quantity").alias("quantity"))
    shipped = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("entity"), F.col("l_extendedprice").alias("kilos"))
    return P.water_use(placements, use, shipped, F.col("o_orderstatus") == "P")


@query(
    "plan_consumption_levels",
    f"""SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'F' WHEN 'N' THEN 'H' ELSE 'P' END AS level, COALESCE({fx("l_quantity * 1000 / NULLIF(CASE l_returnflag WHEN 'A' THEN o_totalprice WHEN 'N' THEN s_acctbal ELSE p_retailprice END, 0)")}, 0) AS per_thousand
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
)
def plan_consumption_levels(t: Tables):
    flag = F.col("l_returnflag")
    level = F.when(flag == "A", "F").when(flag == "N", "H").otherwise("P").alias("level")
    use = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", level, F.col("l_quantity").alias("quantity"))
    level_dims = {
        "F": (t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("base")), "l_orderkey"),
        "H": (t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_acctbal").alias("base")), "l_suppkey"),
        "P": (t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").alias("base")), "l_partkey"),
    }
    return P.consumption_levels(use, level_dims).select("l_orderkey", "l_linenumber", "level", "per_thousand")
