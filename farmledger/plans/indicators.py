"""Queries over production indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from farmledger.functions import day_number, fixed, safe_pct
from farmledger.operators import kpi
from farmledger.plans.registry import query
from farmledger.plans.standins import DAILY_READINGS, daily_readings, day, fx
from farmledger.sources.tables import Tables


@query(
    "safe_pct",
    f"""SELECT o_orderkey, COALESCE({fx("SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / NULLIF(SUM(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END), 0) * 100", 2)}, 0) AS pct
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
)
def safe_pct_query(t: Tables):
    x = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)).alias("x")
    y = F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(0.0)).alias("y")
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(x, y)
    return t.orders.select("o_orderkey").join(lines, "o_orderkey", "left").select("o_orderkey", safe_pct("x", "y", 2).alias("pct"))


_LOT = """(SELECT l_suppkey, l_orderkey, SUM(l_quantity) AS qty, SUM(l_extendedprice) AS amount, SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS lost,
    MAX(l_linenumber) AS age, MIN(l_linestatus) AS status FROM lineitem GROUP BY 1, 2)"""


def _lots(t: Tables):
    return t.lineitem.groupBy("l_suppkey", "l_orderkey").agg(
        F.sum("l_quantity").alias("qty"),
        F.sum("l_extendedprice").alias("amount"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)).alias("lost"),
        F.max("l_linenumber").alias("age"),
        F.min("l_linestatus").alias("status"),
    )


_RATIOS = f"""(SELECT *, {fx("lost / qty * 100", 2)} AS mort_pct, {fx("amount / qty / 1000", 3)} AS weight, {fx("qty / age / 10", 3)} AS conversion FROM {_LOT})"""


def _lot_ratios(t: Tables):
    return _lots(t).withColumns(
        {
            "mort_pct": fixed(F.col("lost") / F.col("qty") * 100, 2),
            "weight": fixed(F.col("amount") / F.col("qty") / 1000, 3),
            "conversion": fixed(F.col("qty") / F.col("age") / 10, 3),
        }
    )


@query(
    "kpi_efficiency_index",
    f"""SELECT l_suppkey, l_orderkey, COALESCE({fx("((100 - mort_pct) * weight) / NULLIF(age * conversion, 0) * 100", 3)}, 0) AS efficiency_index FROM {_RATIOS}""",
)
def kpi_efficiency_index(t: Tables):
    from farmledger.functions import efficiency_index

    index = efficiency_index(F.col("mort_pct"), F.col("weight"), F.col("age"), F.col("conversion"), 3)
    return _lot_ratios(t).select("l_suppkey", "l_orderkey", index.alias("efficiency_index"))


@query(
    "kpi_adjusted_conversion",
    f"""SELECT l_suppkey, l_orderkey, {fx("(CASE WHEN age >= 6 THEN 8.5 ELSE 2.5 END - weight) / CASE WHEN age >= 6 THEN 12.22 WHEN status = 'F' THEN 3.0 ELSE 5.2 END + conversion")} AS adjusted_conversion FROM {_RATIOS}""",
)
def kpi_adjusted_conversion(t: Tables):
    rules = [(F.col("age") >= 6, 8.5, 12.22), (F.col("status") == "F", 2.5, 3.0)]
    out = kpi.kpi_adjusted_conversion(
        _lot_ratios(t), {"weight": "weight", "conversion": "conversion"}, rules, (2.5, 5.2)
    )
    return out.select("l_suppkey", "l_orderkey", "adjusted_conversion")


# Unit conversions of gas (gallons) and litter (bags), the share of a product in its utility.
_FACTORS = {"gas": {"PROMO": 21.6, "ECONOMY": 1.0}, "litter": {"SMALL": 8.45, "MEDIUM": 1.0, "LARGE": 8.45}, "water": {"STANDARD": 1.0}}


@query(
    "kpi_use_per_thousand",
    f"""WITH u AS (SELECT l_orderkey AS lot, SUM(CASE p_type WHEN 'PROMO' THEN l_quantity * 21.6 WHEN 'ECONOMY' THEN l_quantity ELSE 0 END) AS gas,
      SUM(CASE p_type WHEN 'SMALL' THEN l_quantity * 8.45 WHEN 'LARGE' THEN l_quantity * 8.45 WHEN 'MEDIUM' THEN l_quantity ELSE 0 END) AS litter,
      SUM(CASE p_type WHEN 'STANDARD' THEN l_quantity ELSE 0 END) AS water FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
    SELECT o_orderkey AS lot, COALESCE({fx("COALESCE(gas, 0) * 1000 / NULLIF(o_totalprice, 0)")}, 0) AS gas,
      COALESCE({fx("COALESCE(litter, 0) * 1000 / NULLIF(o_totalprice, 0)")}, 0) AS litter, COALESCE({fx("COALESCE(water, 0) * 1000 / NULLIF(o_totalprice, 0)")}, 0) AS water
    FROM orders LEFT JOIN u ON o_orderkey = lot""",
)
def kpi_use_per_thousand(t: Tables):
    heads = t.orders.select(F.col("o_orderkey").alias("lot"), F.col("o_totalprice").alias("heads"))
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product"))
    use = t.lineitem.join(part, "l_partkey").select(F.col("l_orderkey").alias("lot"), "product", F.col("l_quantity").alias("quantity"))
    cols = {"heads": "heads", "product": "product", "quantity": "quantity"}
    return kpi.kpi_use_per_thousand(heads, use, "lot", cols, _FACTORS)


@query(
    "kpi_per_thousand_by_state",
    f"""SELECT l_suppkey, l_orderkey, COALESCE({fx("lost * 1000 / NULLIF(CASE WHEN status = 'O' THEN qty WHEN age = 1 THEN 0 ELSE amount END, 0)")}, 0) AS per_thousand
    FROM {_LOT}""",
)
def kpi_per_thousand_by_state(t: Tables):
    lots = _lots(t).withColumn("none", F.lit(0.0))
    out = kpi.kpi_per_thousand_by_state(
        lots, {"quantity": "lost"}, [(F.col("status") == "O", "qty"), (F.col("age") == 1, "none")], "amount"
    )
    return out.select("l_suppkey", "l_orderkey", "per_thousand")


# Feed phases by age in days, product group and standard season. A day no rule covers has no phase.
FEED_PHASES = [
    ({}, None, 9, "PREINICIO"),
    ({"season": "plain"}, 10, 19, "INICIO"),
    ({"season": "plain", "grp": "VIVO"}, 20, 33, "ACABADO"),
    ({"season": "plain", "grp": "BENEFICIO"}, 20, 29, "ACABADO"),
    ({"season": "plain", "grp": "VIVO"}, 34, None, "FINALIZADOR"),
    ({"season": "plain", "grp": "BENEFICIO"}, 30, None, "FINALIZADOR"),
    ({"season": "summer"}, 10, 18, "INICIO"),
    ({"season": "winter"}, 10, 18, "INICIO"),
    ({"season": "summer", "grp": "VIVO"}, 20, 35, "ACABADO"),
    ({"season": "winter", "grp": "VIVO"}, 20, 33, "ACABADO"),
    ({"season": "summer", "grp": "BENEFICIO"}, 20, 31, "ACABADO"),
    ({"season": "winter", "grp": "BENEFICIO"}, 20, 30, "ACABADO"),
    ({"season": "summer", "grp": "VIVO"}, 36, 43, "FINALIZADOR"),
    ({"season": "winter", "grp": "VIVO"}, 34, 41, "FINALIZADOR"),
    ({"season": "summer", "grp": "BENEFICIO"}, 32, 39, "FINALIZADOR"),
    ({"season": "winter", "grp": "BENEFICIO"}, 31, 38, "FINALIZADOR"),
]


@query(
    "phase_from_rules",
    """WITH x AS (SELECT p_partkey, p_size AS age, CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'Vivo' ELSE 'Beneficio' END AS grp,
      CASE WHEN p_brand LIKE '%1' THEN 'summer' WHEN p_brand LIKE '%2' THEN 'winter' ELSE 'plain' END AS season FROM part),
    r(season, grp, lo, hi, label) AS (VALUES ('plain', 'Vivo', 10, 19, 'INICIO'), ('plain', 'Beneficio', 10, 19, 'INICIO'), ('plain', 'Vivo', 20, 33, 'ACABADO'),
      ('plain', 'Beneficio', 20, 29, 'ACABADO'), ('plain', 'Vivo', 34, 9999, 'FINALIZADOR'), ('plain', 'Beneficio', 30, 9999, 'FINALIZADOR'),
      ('summer', 'Vivo', 10, 18, 'INICIO'), ('summer', 'Beneficio', 10, 18, 'INICIO'), ('winter', 'Vivo', 10, 18, 'INICIO'), ('winter', 'Beneficio', 10, 18, 'INICIO'),
      ('summer', 'Vivo', 20, 35, 'ACABADO'), ('winter', 'Vivo', 20, 33, 'ACABADO'), ('summer', 'Beneficio', 20, 31, 'ACABADO'), ('winter', 'Beneficio', 20, 30, 'ACABADO'),
      ('summer', 'Vivo', 36, 43, 'FINALIZADOR'), ('winter', 'Vivo', 34, 41, 'FINALIZADOR'), ('summer', 'Beneficio', 32, 39, 'FINALIZADOR'), ('winter', 'Beneficio', 31, 38, 'FINALIZADOR'))
    SELECT p_partkey, age, x.grp, x.season, CASE WHEN age <= 9 THEN 'PREINICIO' ELSE r.label END AS phase
    FROM x LEFT JOIN r ON r.season = x.season AND r.grp = x.grp AND x.age BETWEEN r.lo AND r.hi""",
)
def phase_from_rules(t: Tables):
    brand = F.col("p_brand")
    parts = t.part.select(
        "p_partkey",
        F.col("p_size").alias("age"),
        F.when(F.col("p_type").isin("SMALL", "MEDIUM", "LARGE"), "Vivo").otherwise("Beneficio").alias("grp"),
        F.when(brand.like("%1"), "summer").when(brand.like("%2"), "winter").otherwise("plain").alias("season"),
    )
    return kpi.phase_from_rules(parts, {"age": "age"}, FEED_PHASES)


@query(
    "kpi_stage_denominator",
    f"""SELECT l_suppkey, l_orderkey, COALESCE({fx("lost / NULLIF(CASE WHEN status = 'F' THEN qty ELSE amount END, 0) * 100", 2)}, 0) AS mortality_pct,
    COALESCE({fx("(qty - lost) / NULLIF(CASE WHEN status = 'F' THEN qty ELSE amount END, 0) * 100", 2)}, 0) AS viability_pct FROM {_LOT}""",
)
def kpi_stage_denominator(t: Tables):
    lots = _lots(t).withColumn("alive", F.col("qty") - F.col("lost"))
    cols = {"stage": "status", "intake": "qty", "capitalised": "amount"}
    out = kpi.kpi_stage_denominator(lots, cols, "F", {"mortality_pct": "lost", "viability_pct": "alive"}, 2)
    return out.select("l_suppkey", "l_orderkey", "mortality_pct", "viability_pct")


@query(
    "kpi_vs_standard",
    f"""WITH std AS (SELECT p_size AS std_age, {fx("AVG(p_retailprice)")} AS standard FROM part GROUP BY 1),
    a AS (SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS m, {fx("SUM(l_quantity * l_discount) / NULLIF(SUM(l_discount), 0)")} AS age, ROUND(SUM(l_quantity), 2) AS actual FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey, m AS month, age, actual, CAST(ceil(age) AS INTEGER) AS std_age, COALESCE(standard, 0) AS standard, {fx("actual - COALESCE(standard, 0)")} AS difference
    FROM a LEFT JOIN std ON std_age = ceil(age)""",
)
def kpi_vs_standard(t: Tables):
    std = (
        t.part.groupBy(F.col("p_size").alias("std_age"))
        .agg(fixed(F.avg("p_retailprice")).alias("std_value"))
    )
    discount = F.col("l_discount")
    actual = (
        t.lineitem.groupBy("l_suppkey", F.trunc(day("l_shipdate"), "month").alias("month"))
        .agg(
            fixed(F.try_divide(F.sum(F.col("l_quantity") * discount), F.sum(discount))).alias("age"),
            F.round(F.sum("l_quantity"), 2).alias("actual"),
        )
    )
    cols = {"age": "age", "std_age": "std_age", "actual": "actual", "standard": "std_value"}
    return kpi.kpi_vs_standard(actual, std, [], cols)


@query(
    "row_extremes",
    f"""SELECT l_orderkey, l_linenumber, GREATEST(l_quantity, l_discount, l_tax) AS row_max, LEAST(l_quantity, l_discount, l_tax) AS row_min,
    {fx("(l_quantity + l_discount + l_tax) / 3")} AS row_mean FROM lineitem""",
)
def row_extremes(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return kpi.row_extremes(rows, ["l_quantity", "l_discount", "l_tax"]).drop("l_quantity", "l_discount", "l_tax")


@query(
    "day_number_rule",
    """WITH e AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN date_trunc('day', ts) WHEN 1 THEN date_trunc('day', ts) + INTERVAL 43199 SECOND WHEN 2 THEN date_trunc('day', ts) + INTERVAL 43140 SECOND
      WHEN 3 THEN date_trunc('day', ts) + INTERVAL 41340 SECOND ELSE ts END AS ts FROM events)
    SELECT event_id, CAST(date_diff('day', DATE '1900-01-01', CAST(ts AS DATE)) + CASE WHEN hour(ts) = 11 AND minute(ts) = 59 AND floor(second(ts)) IN (0, 59) THEN 0
    WHEN hour(ts) = 11 AND minute(ts) = 29 AND floor(second(ts)) = 0 THEN 0 WHEN hour(ts) > 0 OR minute(ts) > 0 OR floor(second(ts)) > 0 THEN 1 ELSE 0 END AS INTEGER) AS day_number FROM e""",
)
def day_number_rule(t: Tables):
    # Times of day that stand for "no time recorded".
    markers = ((11, 59, 59), (11, 59, 0), (11, 29, 0))
    # every marker occurs: midnight, the three stand-ins and the recorded time take turns
    turn, midnight = F.col("event_id") % 5, day("ts").cast("timestamp_ntz")
    stamp = F.when(turn == 4, F.col("ts").cast("timestamp_ntz")).otherwise(midnight)
    for k, seconds in ((1, 43199), (2, 43140), (3, 41340)):
        stamp = F.when(turn == k, midnight + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))).otherwise(stamp)
    return t.events.select("event_id", stamp.alias("ts")).select("event_id", day_number("ts", markers).alias("day_number"))


@query(
    "opening_balance",
    """WITH d AS (SELECT l_suppkey AS lot, CAST(l_shipdate AS DATE) AS day, SUM(l_quantity) AS exits FROM lineitem GROUP BY 1, 2),
    c AS (SELECT *, 100000.0 - SUM(exits) OVER (PARTITION BY lot ORDER BY day) AS closing FROM d)
    SELECT lot, day, ROUND(exits, 2) AS exits, ROUND(CASE WHEN LAG(day) OVER w = day - 1 THEN LAG(closing) OVER w END, 2) AS opening FROM c WINDOW w AS (PARTITION BY lot ORDER BY day)""",
)
def opening_balance(t: Tables):
    number = F.datediff(day("l_shipdate"), F.lit("1970-01-01").cast("date")).alias("n")
    daily = t.lineitem.groupBy(F.col("l_suppkey").alias("lot"), number).agg(F.sum("l_quantity").alias("exits"))
    daily = daily.withColumn("population", F.lit(100000.0))
    out = kpi.opening_balance(daily, ["lot"], "n", "exits", "population")
    return out.select("lot", F.date_from_unix_date("n").alias("day"), F.round("exits", 2).alias("exits"), F.round("opening", 2).alias("opening"))
