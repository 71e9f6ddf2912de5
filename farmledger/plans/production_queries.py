"""The production jobs over the driver tables.

Suppliers are lots, their nation the zone, the return flag the house and the line number the pen; a line is a reading
of its ship date, its quantity the heads, its price the kilos and its part's type the cause or feed type.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farmledger.functions import fixed
from farmledger.operators.setops import union_all
from farmledger.plans import production as P
from farmledger.plans.registry import query
from farmledger.plans.standins import AS_OF, day, fx
from farmledger.sources.tables import Tables

START = dt.date(1995, 1, 1)
HEADS = 100000.0
# Part types in their role as causes of death and feed types.
KINDS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
CAUSES = [f"c_{k.lower()}" for k in KINDS]


def field_lines(t: Tables) -> DataFrame:
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("kind"), F.col("p_brand").alias("formula"))
    lots = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("zone"))
    lines = t.lineitem.join(part, "l_partkey").join(lots, "l_suppkey")
    return lines.select(
        "zone", F.col("l_suppkey").alias("lot"), F.col("l_returnflag").alias("house"), F.col("l_linenumber").alias("pen"),
        day("l_shipdate").alias("day"), (F.datediff(day("l_shipdate"), F.lit(START)) + 1).alias("age"),
        F.col("l_quantity").alias("heads"), F.col("l_extendedprice").alias("kilos"), "kind", "formula",
        F.col("l_linestatus").alias("status"), "l_discount",
    )


FIELD_LINES = """field_lines AS (SELECT s_nationkey AS zone, l_suppkey AS lot, l_returnflag AS house, l_linenumber AS pen, CAST(l_shipdate AS DATE) AS day,
    CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) + 1 AS INTEGER) AS age, l_quantity AS heads, l_extendedprice AS kilos, p_type AS kind, p_brand AS formula, l_linestatus AS status, l_discount
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""


def field_days(t: Tables) -> DataFrame:
    causes = [F.sum(F.when(F.col("kind") == k, F.col("heads")).otherwise(0.0)).alias(c) for k, c in zip(KINDS, CAUSES)]
    return field_lines(t).groupBy(*P.PEN, "day", "age").agg(
        F.sum("heads").alias("deaths"), F.round(F.sum("kilos"), 2).alias("kilos"), F.sum(F.col("heads") * 2).alias("feed"),
        F.max("l_discount").alias("weight"), *causes,
    )


FIELD_DAYS = FIELD_LINES + """, field_days AS (SELECT zone, lot, house, pen, day, age, SUM(heads) AS deaths, ROUND(SUM(kilos), 2) AS kilos, SUM(heads * 2) AS feed, MAX(l_discount) AS weight, """ + ", ".join(
    f"SUM(CASE WHEN kind = '{k}' THEN heads ELSE 0 END) AS {c}" for k, c in zip(KINDS, CAUSES)
) + " FROM field_lines GROUP BY ALL)"


def heads_of(t: Tables) -> DataFrame:
    return field_lines(t).select(*P.PEN).distinct().withColumn("heads", F.lit(HEADS))


@query(
    "plan_field_detail",
    """SELECT l_orderkey AS entity, l_linenumber, o_custkey AS farm, CAST(l_shipdate AS DATE) AS event_day, c_mktsegment AS farm_type,
      CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS age,
      CASE WHEN o_orderpriority = '1-URGENT' AND l_shipdate <= o_orderdate THEN o_custkey ELSE l_orderkey END AS destination,
      CASE WHEN o_orderpriority = '1-URGENT' AND l_shipdate <= o_orderdate THEN 1 ELSE 0 END AS moved
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE l_shipdate >= DATE '2000-11-01'""",
)
def plan_field_detail(t: Tables):
    readings = t.lineitem.select(F.col("l_orderkey").alias("entity"), "l_linenumber", F.col("l_shipdate").alias("event_date"))
    entities = t.orders.select(F.col("o_orderkey").alias("entity"), F.col("o_custkey").alias("farm"), F.col("o_orderdate").alias("placed"))
    farms = t.customer.select(F.col("c_custkey").alias("farm"), F.col("c_mktsegment").alias("farm_type"))
    moves = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("entity"), F.col("o_custkey").alias("destination"), F.col("o_orderdate").alias("moved_on")
    )
    out = P.daily_field_detail(readings, entities, farms, moves, AS_OF)
    return out.select("entity", "l_linenumber", "farm", day("event_date").alias("event_day"), "farm_type", "age", "destination", "moved")


@query(
    "plan_mortality_daily",
    f"""WITH {FIELD_DAYS}, d AS (SELECT zone, lot, house, pen, age, SUM(deaths) AS deaths, CAST(floor((age + 6) / 7) AS INTEGER) AS week FROM field_days GROUP BY ALL),
    r AS (SELECT *, SUM(deaths) OVER (PARTITION BY zone, lot, house, pen ORDER BY age) AS deaths_so_far, SUM(deaths) OVER (PARTITION BY zone, lot, house, pen, week) AS deaths_week,
      SUM(deaths) OVER (PARTITION BY zone, lot, house, pen ORDER BY week) AS deaths_to_week FROM d),
    last AS (SELECT zone, lot, house, pen, MAX(age) AS a, arg_max(deaths_to_week, age) AS w FROM r GROUP BY ALL),
    g AS (SELECT zone, lot, MAX(age) AS e FROM r GROUP BY ALL),
    x AS (SELECT zone, lot, house, pen, UNNEST(generate_series(a + 1, e)) AS age, w FROM last JOIN g USING (zone, lot)),
    u AS (SELECT zone, lot, house, pen, age, deaths, deaths_week, deaths_so_far, deaths_to_week, 1 AS flag FROM r
      UNION ALL SELECT zone, lot, house, pen, CAST(age AS INTEGER), 0.0, 0.0, 0.0, w, 2 FROM x)
    SELECT *, CAST(floor((age + 6) / 7) AS INTEGER) AS week FROM u""",
)
def plan_mortality_daily(t: Tables):
    return P.mortality_daily(field_days(t))


_LONG = " UNION ALL ".join(f"SELECT zone, lot, week, '{c}' AS cause, SUM({c}) AS q FROM w GROUP BY ALL" for c in CAUSES)


@query(
    "plan_mortality_causes",
    f"""WITH {FIELD_DAYS}, w AS (SELECT *, CAST(floor((age + 6) / 7) AS INTEGER) AS week FROM field_days), l AS (SELECT * FROM ({_LONG}) WHERE q <> 0),
    r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY zone, lot, week ORDER BY q DESC, cause) AS rn FROM l)
    SELECT zone, lot, week, """ + ", ".join(
        f"MAX(CASE WHEN rn = {i} THEN cause END) AS name_{i}, MAX(CASE WHEN rn = {i} THEN q END) AS qty_{i}, {fx(f'MAX(CASE WHEN rn = {i} THEN q END) / SUM(q) * 100')} AS pct_{i}" for i in (1, 2, 3)
    ) + ", COALESCE(SUM(CASE WHEN rn > 3 THEN q END), 0) AS qty_others, SUM(q) AS qty_total FROM r GROUP BY zone, lot, week",
)
def plan_mortality_causes(t: Tables):
    return P.mortality_causes(field_days(t), CAUSES, ["zone", "lot"])


@query(
    "plan_mortality_levels",
    f"""WITH {FIELD_DAYS}, p AS (SELECT scope, zone, lot, house, pen, SUM(deaths) AS deaths, 100000.0 AS heads FROM field_days JOIN (VALUES (2), (1)) s(scope) ON scope = 2 OR weight <= 0.08 GROUP BY ALL)
    SELECT CASE grouping_id(house, pen) WHEN 0 THEN 'pen' WHEN 1 THEN 'house' ELSE 'lot' END AS level, CAST(scope AS INTEGER) AS scope, zone, lot, house, pen, SUM(deaths) AS deaths, CAST(SUM(heads) AS DOUBLE) AS heads,
    COALESCE({fx("CAST(SUM(deaths) AS DOUBLE) / CAST(SUM(heads) AS DOUBLE) * 100")}, 0) AS mort_pct FROM p GROUP BY GROUPING SETS ((scope, zone, lot, house, pen), (scope, zone, lot, house), (scope, zone, lot))""",
)
def plan_mortality_levels(t: Tables):
    return P.mortality_levels(field_days(t), heads_of(t), F.col("weight") <= 0.08)


# Every seventh day is a weigh day; the weeks of life share eight columns by turns.
_WEIGH_WEEKS = {k: f"week_{k + 1}" for k in range(8)}


@query(
    "plan_weight_weekly",
    f"""WITH {FIELD_DAYS}, d AS (SELECT zone, lot, house, pen, age, MAX(weight) AS w FROM field_days GROUP BY ALL),
    m AS (SELECT *, MAX(w) OVER (PARTITION BY zone, lot, house, pen ORDER BY age RANGE BETWEEN CURRENT ROW AND 2 FOLLOWING) AS best FROM d),
    f AS (SELECT *, CASE WHEN w = 0 THEN best ELSE w END AS filled, floor((age + 6) / 7) AS week FROM m WHERE age % 7 = 0)
    SELECT zone, lot, house, pen, """ + ", ".join(f"{fx(f'COALESCE(SUM(CASE WHEN week % 8 = {k} THEN filled END), 0)')} AS week_{k + 1}" for k in range(8)) + " FROM f GROUP BY 1, 2, 3, 4",
)
def plan_weight_weekly(t: Tables):
    wide = P.weight_weekly(field_days(t), _WEIGH_WEEKS, F.col("age") % 7 == 0, F.col("week") % 8)
    return wide.select("zone", "lot", "house", "pen", *[fixed(f"week_{k}").alias(f"week_{k}") for k in range(1, 9)])


@query(
    "plan_weight_gain",
    f"""WITH {FIELD_DAYS}, s AS (SELECT zone, lot, house, pen, age, SUM(weight) AS reading FROM field_days GROUP BY ALL), d AS (SELECT zone, lot, house, pen, reading, MIN(age) AS age FROM s WHERE reading <> 0 GROUP BY ALL),
    l AS (SELECT *, LAG(reading) OVER w AS pv, LAG(age) OVER w AS pd FROM d WINDOW w AS (PARTITION BY zone, lot, house, pen ORDER BY age))
    SELECT zone, lot, house, pen, age, reading, {fx("COALESCE(reading - pv, 0)")} AS difference, CAST(COALESCE(age - pd, 0) AS INTEGER) AS days_between, COALESCE({fx("(reading - pv) / (age - pd)")}, 0) AS daily_gain FROM l""",
)
def plan_weight_gain(t: Tables):
    return P.weight_gain(field_days(t))


_FEEDS = {"ECONOMY": "preinicio", "SMALL": "inicio", "MEDIUM": "acabado", "LARGE": "acabado", "PROMO": "finalizador"}


@query(
    "plan_feed_by_type",
    f"""WITH {FIELD_LINES}, d AS (SELECT zone, lot, house, pen, age, SUM(CASE WHEN kind = 'ECONOMY' THEN heads ELSE 0 END) AS preinicio, SUM(CASE WHEN kind = 'SMALL' THEN heads ELSE 0 END) AS inicio,
      SUM(CASE WHEN kind IN ('MEDIUM', 'LARGE') THEN heads ELSE 0 END) AS acabado, SUM(CASE WHEN kind = 'PROMO' THEN heads ELSE 0 END) AS finalizador, SUM(heads) AS kilos FROM field_lines GROUP BY ALL)
    SELECT *, """ + ", ".join(f"SUM({c}) OVER (PARTITION BY zone, lot, house, pen ORDER BY age) AS {c}_so_far" for c in ("preinicio", "inicio", "acabado", "finalizador", "kilos")) + " FROM d",
)
def plan_feed_by_type(t: Tables):
    use = field_lines(t).select(*P.PEN, "age", F.col("kind").alias("feed_type"), F.col("heads").alias("kilos"))
    return P.feed_by_type(use, P.PEN, _FEEDS)


@query(
    "plan_feed_lists",
    f"""WITH {FIELD_LINES}, d AS (SELECT DISTINCT zone, lot, house, pen, formula FROM field_lines) SELECT zone, lot, house, pen, string_agg(formula, ',' ORDER BY formula) AS formulas FROM d GROUP BY ALL""",
)
def plan_feed_lists(t: Tables):
    return P.feed_lists(field_lines(t), P.PEN)


@query(
    "plan_sales_running",
    f"""WITH {FIELD_LINES}, m AS (SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'X' ELSE 'Y' END AS new_house FROM supplier WHERE s_acctbal < 1000),
    d AS (SELECT zone, lot, COALESCE(m.new_house, house) AS house, pen, day, SUM(heads) AS heads, SUM(kilos) AS kilos FROM field_lines LEFT JOIN m ON lot = s_suppkey WHERE status = 'F' GROUP BY ALL)
    SELECT zone, lot, house, pen, day, heads, ROUND(kilos, 2) AS kilos, SUM(heads) OVER w AS heads_so_far, ROUND(SUM(kilos) OVER w, 2) AS kilos_so_far FROM d WINDOW w AS (PARTITION BY zone, lot, house, pen ORDER BY day)""",
)
def plan_sales_running(t: Tables):
    moved = t.supplier.where(F.col("s_acctbal") < 1000).select(
        F.col("s_suppkey").alias("lot"), F.when(F.col("s_acctbal") < 0, "X").otherwise("Y").alias("new_house")
    )
    out = P.sales_running(field_lines(t).where(F.col("status") == "F"), moved)
    return out.withColumns({c: F.round(c, 2) for c in ("kilos", "kilos_so_far")})


@query(
    "plan_sales_age",
    f"""WITH {FIELD_LINES}, p AS (SELECT zone, lot, house, pen, SUM(age * heads) AS x, SUM(heads) AS w FROM field_lines WHERE status = 'F' GROUP BY ALL)
    SELECT zone, lot, house, pen, {fx("x / w")} AS age_pen, {fx("SUM(x) OVER (PARTITION BY zone, lot, house) / SUM(w) OVER (PARTITION BY zone, lot, house)")} AS age_house,
    {fx("SUM(x) OVER (PARTITION BY zone, lot) / SUM(w) OVER (PARTITION BY zone, lot)")} AS age_lot FROM p""",
)
def plan_sales_age(t: Tables):
    return P.sales_age(field_lines(t).where(F.col("status") == "F"))


@query(
    "plan_breeder_running",
    f"""WITH {FIELD_DAYS}, d AS (SELECT *, CASE WHEN age <= 1200 THEN 1 ELSE 2 END AS phase FROM field_days),
    h AS (SELECT CASE grouping_id(house, pen) WHEN 0 THEN 'pen' WHEN 1 THEN 'house' ELSE 'lot' END AS level, zone, lot, house, pen, phase, day, SUM(deaths) AS deaths, SUM(feed) AS feed FROM d
      GROUP BY GROUPING SETS ((zone, lot, house, pen, phase, day), (zone, lot, house, phase, day), (zone, lot, phase, day)))
    SELECT *, SUM(deaths) OVER w AS deaths_so_far, SUM(feed) OVER w AS feed_so_far FROM h WINDOW w AS (PARTITION BY level, zone, lot, house, pen, phase ORDER BY day)""",
)
def plan_breeder_running(t: Tables):
    days = field_days(t).withColumn("phase", F.when(F.col("age") <= 1200, 1).otherwise(2))
    levels = P.breeder_running(days, ["deaths", "feed"])
    return union_all(*[df.withColumn("level", F.lit(name)) for name, df in levels.items()], fill_missing=True)


@query(
    "plan_breeder_indicators",
    f"""WITH {FIELD_DAYS}, d AS (SELECT *, CASE WHEN age <= 1200 THEN 1 ELSE 2 END AS phase FROM field_days),
    h AS (SELECT zone, lot, house, phase, day, SUM(deaths) AS deaths, SUM(feed) AS feed FROM d GROUP BY ALL),
    r AS (SELECT *, SUM(deaths) OVER w AS s FROM h WINDOW w AS (PARTITION BY zone, lot, house, phase ORDER BY day)),
    k AS (SELECT *, CASE WHEN phase = 1 THEN 100000.0::DOUBLE ELSE 80000.0::DOUBLE END AS base, COALESCE({fx("feed * 1000 / NULLIF(100000 - s, 0)", 2)}, 0) AS grams FROM r)
    SELECT zone, lot, house, phase, day, COALESCE({fx("s / base * 100", 2)}, 0) AS mort_pct, COALESCE({fx("(100000 - s) / base * 100", 2)}, 0) AS viability_pct, grams,
    {fx("COALESCE(grams - LAG(grams) OVER (PARTITION BY zone, lot, house, phase ORDER BY day), 0)", 2)} AS grams_change FROM k""",
)
def plan_breeder_indicators(t: Tables):
    days = field_days(t).withColumn("phase", F.when(F.col("age") <= 1200, 1).otherwise(2))
    house = P.breeder_running(days, ["deaths", "feed"])["house"]
    house = house.withColumns({"intake": F.lit(100000.0), "capitalised": F.lit(80000.0)})
    out = P.breeder_indicators(house)
    return out.select("zone", "lot", "house", "phase", "day", "mort_pct", "viability_pct", "grams", "grams_change")


@query(
    "plan_placement",
    f"""WITH {FIELD_LINES}, t AS (SELECT zone, lot, house, SUM(heads) AS heads, DATE '1900-01-01' + CAST(floor(SUM(date_diff('day', DATE '1900-01-01', day) * heads) / SUM(heads)) AS INTEGER) AS placed_on,
      {fx("SUM(age * heads) / SUM(heads)")} AS parent_age FROM field_lines GROUP BY ALL),
    c AS (SELECT zone, lot, house, kind, SUM(heads) AS q FROM field_lines GROUP BY ALL), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY zone, lot, house ORDER BY q DESC, kind) AS rn, SUM(q) OVER (PARTITION BY zone, lot, house) AS s FROM c),
    o AS (SELECT zone, lot, house, string_agg(kind, ',' ORDER BY kind) AS origins FROM c GROUP BY ALL)
    SELECT zone, lot, house, heads, placed_on, parent_age, kind, {fx("q / s")} AS origin_share, origins FROM t JOIN (SELECT * FROM r WHERE rn = 1) USING (zone, lot, house) JOIN o USING (zone, lot, house)""",
)
def plan_placement(t: Tables):
    return P.placement(field_lines(t), "kind", "age")


@query(
    "plan_intake_consolidated",
    """WITH f AS (SELECT l_suppkey, l_linenumber, MIN(l_shipdate) AS d, SUM(l_quantity) AS heads FROM lineitem WHERE l_shipdate >= DATE '2000-11-01' GROUP BY 1, 2),
    p AS (SELECT l_suppkey, l_linenumber, MAX(l_shipdate) AS d, SUM(l_quantity) AS heads FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey, l_linenumber, CAST(d AS DATE) AS event_day, heads FROM p WHERE d < DATE '2001-04-01' UNION ALL SELECT l_suppkey, l_linenumber, CAST(d AS DATE), heads FROM f WHERE d >= DATE '2001-04-01'""",
)
def plan_intake_consolidated(t: Tables):
    keys = ["l_suppkey", "l_linenumber"]
    intake = t.lineitem.select(*keys, F.col("l_shipdate").alias("event_date"), F.col("l_quantity").alias("heads"))
    published = intake.groupBy(*keys).agg(F.max("event_date").alias("event_date"), F.sum("heads").alias("heads"))
    out = P.intake_consolidated(intake, published, keys, AS_OF)
    return out.select(*keys, day("event_date").alias("event_day"), "heads")


@query(
    "plan_consolidated",
    f"""WITH {FIELD_LINES}, p AS (SELECT zone, lot, house, pen, CAST(100000 AS DOUBLE) AS heads, SUM(heads) AS deaths, SUM(heads * 2) AS feed, COALESCE(SUM(CASE WHEN status = 'F' THEN heads END), 0) AS sold,
      COALESCE(SUM(CASE WHEN status = 'F' THEN kilos END), 0) AS kilos, COALESCE(SUM(CASE WHEN status = 'F' THEN age * heads END), 0) AS age_heads FROM field_lines GROUP BY zone, lot, house, pen),
    s AS (SELECT CASE grouping_id(house, pen) WHEN 0 THEN 'pen' WHEN 1 THEN 'house' ELSE 'lot' END AS level, zone, lot, house, pen, SUM(heads) AS heads, SUM(deaths) AS deaths, SUM(feed) AS feed, SUM(sold) AS sold, SUM(kilos) AS kilos, SUM(age_heads) AS age_heads
      FROM p GROUP BY GROUPING SETS ((zone, lot, house, pen), (zone, lot, house), (zone, lot))),
    r AS (SELECT *, COALESCE({fx("deaths / NULLIF(heads, 0) * 100")}, 0) AS mort_pct, COALESCE({fx("kilos / NULLIF(sold, 0)")}, 0) AS weight, COALESCE({fx("feed / NULLIF(kilos, 0)")}, 0) AS conversion, COALESCE({fx("age_heads / NULLIF(sold, 0)")}, 0) AS sale_age FROM s)
    SELECT level, zone, lot, house, pen, deaths, sold, mort_pct, weight, conversion, sale_age, {fx("(CASE WHEN zone = 4 THEN 8.5 ELSE 2.5 END - weight) / CASE WHEN zone = 4 THEN 12.22 WHEN house = 'A' THEN 3.0 ELSE 5.2 END + conversion")} AS adjusted_conversion,
    COALESCE({fx("((100 - mort_pct) * weight) / NULLIF(sale_age * conversion, 0) * 100")}, 0) AS efficiency_index FROM r""",
)
def plan_consolidated(t: Tables):
    lines = field_lines(t)
    rules = [(F.col("zone") == 4, 8.5, 12.22), (F.coalesce(F.col("house") == "A", F.lit(False)), 2.5, 3.0)]
    out = P.consolidated(field_days(t), heads_of(t), lines.where(F.col("status") == "F"), rules, (2.5, 5.2))
    return out.select(
        "level", "zone", "lot", "house", "pen", "deaths", "sold", "mort_pct", "weight", "conversion", "sale_age",
        "adjusted_conversion", "efficiency_index",
    )


@query(
    "plan_consumption_daily",
    f"""WITH {FIELD_LINES}, d AS (SELECT zone, lot, house, pen, age, SUM(heads) AS kilos FROM field_lines GROUP BY ALL), r AS (SELECT *, SUM(kilos) OVER (PARTITION BY zone, lot, house, pen ORDER BY age) AS s FROM d)
    SELECT zone, lot, house, pen, age, kilos, s AS kilos_so_far, CAST(100000 AS DOUBLE) AS heads, {fx("s * 1000 / 100000")} AS per_thousand FROM r""",
)
def plan_consumption_daily(t: Tables):
    use = field_lines(t).select(*P.PEN, "age", F.col("heads").alias("kilos"))
    return _consumption(t, use)[0]


def _consumption(t: Tables, use: DataFrame):
    bands = {"first_year": (None, 52), "second_year": (53, 104), "rest": (105, None)}
    return P.consumption_daily(use, heads_of(t), bands)


@query(
    "plan_consumption_weekly",
    f"""WITH {FIELD_LINES}, d AS (SELECT *, floor((age + 6) / 7) AS week FROM field_lines)
    SELECT zone, lot, house, pen, COALESCE(SUM(CASE WHEN week <= 52 THEN heads END), 0) AS first_year, COALESCE(SUM(CASE WHEN week BETWEEN 53 AND 104 THEN heads END), 0) AS second_year, COALESCE(SUM(CASE WHEN week >= 105 THEN heads END), 0) AS rest FROM d GROUP BY ALL""",
)
def plan_consumption_weekly(t: Tables):
    use = field_lines(t).select(*P.PEN, "age", F.col("heads").alias("kilos"))
    return _consumption(t, use)[1]


@query(
    "plan_hatchery",
    f"""WITH {FIELD_LINES}, d AS (SELECT lot, kind AS breed, day, SUM(heads) AS set_eggs, SUM(CASE WHEN status = 'F' THEN heads ELSE 0 END) AS hatched, MAX(l_discount * 100 + 0.5) AS flock_age FROM field_lines GROUP BY ALL),
    k AS (SELECT *, COALESCE({fx("hatched / NULLIF(set_eggs, 0) * 100")}, 0) AS hatch_pct, CAST(ceil(flock_age) AS INTEGER) AS std_age FROM d),
    std AS (SELECT p_type AS breed, p_size AS std_age, {fx("AVG(p_retailprice) / 20")} AS std FROM part GROUP BY 1, 2)
    SELECT lot, k.breed, day, set_eggs, hatched, flock_age, hatch_pct, k.std_age, COALESCE(std, 0) AS standard, {fx("hatch_pct - COALESCE(std, 0)")} AS difference FROM k LEFT JOIN std ON k.breed = std.breed AND k.std_age = std.std_age""",
)
def plan_hatchery(t: Tables):
    from farmledger.functions import fixed

    std = t.part.groupBy(F.col("p_type").alias("breed"), F.col("p_size").alias("std_age")).agg(
        fixed(F.avg("p_retailprice") / 20).alias("std_hatch_pct")
    )
    hatches = field_lines(t).select(
        "lot", F.col("kind").alias("breed"), "day", F.col("heads").alias("set_eggs"),
        F.when(F.col("status") == "F", F.col("heads")).otherwise(0.0).alias("hatched"),
        (F.col("l_discount") * 100 + 0.5).alias("flock_age"),
    )
    return P.hatchery(hatches, std)


@query(
    "plan_standards",
    """WITH c AS (SELECT p_brand AS curve, p_size AS age, MAX(CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 0 ELSE p_retailprice END) AS mort, MAX(CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 0 ELSE p_size * 1.5 END) AS feed FROM part GROUP BY 1, 2)
    SELECT curve, age, CASE WHEN mort + feed = 0 THEN MAX(mort) OVER (PARTITION BY curve) ELSE mort END AS mort, CASE WHEN mort + feed = 0 THEN MAX(feed) OVER (PARTITION BY curve) ELSE CAST(feed AS DOUBLE) END AS feed FROM c""",
)
def plan_standards(t: Tables):
    blank = F.col("p_type").isin("PROMO", "SMALL")
    curves = t.part.groupBy(F.col("p_brand").alias("curve"), F.col("p_size").alias("age")).agg(
        F.max(F.when(blank, 0.0).otherwise(F.col("p_retailprice"))).alias("mort"),
        F.max(F.when(blank, 0.0).otherwise(F.col("p_size") * 1.5)).alias("feed"),
    )
    return P.standards(curves, ["mort", "feed"])


@query(
    "plan_utilities",
    f"""WITH u AS (SELECT l_orderkey, SUM(CASE p_type WHEN 'PROMO' THEN l_quantity * 21.6 WHEN 'ECONOMY' THEN l_quantity ELSE 0 END) AS gas FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
    SELECT 'LT' || o_orderkey AS entity, COALESCE({fx("COALESCE(gas, 0) * 1000 / NULLIF(o_totalprice, 0)")}, 0) AS gas FROM orders LEFT JOIN u ON o_orderkey = l_orderkey""",
)
def plan_utilities(t: Tables):
    placements = t.orders.select(F.concat(F.lit(" lt"), "o_orderkey").alias("entity"), F.col("o_totalprice").alias("heads"))
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product"))
    use = t.lineitem.join(part, "l_partkey").select(
        F.concat(F.lit("Lt"), "l_orderkey", F.lit("  ")).alias("entity"), "product", F.col("l_quantity").alias("quantity")
    )
    return P.utilities(placements, use, {"gas": {"PROMO": 21.6, "ECONOMY": 1.0}})
