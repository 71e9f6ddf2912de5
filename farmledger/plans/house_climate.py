"""Cleaning and temperature of houses between two lots, consumption over the base of its level, and their queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farmledger.functions import per_thousand
from farmledger.operators.kpi import row_extremes
from farmledger.operators.merge import replace_rolling, update_from
from farmledger.plans.registry import query
from farmledger.plans.standins import AS_OF, day, fx
from farmledger.sources.tables import Tables

# The four readings in the litter heap and the two of ammonia; the litter of a house that reuses none.
HEAPS = ["heap1", "heap2", "heap3", "heap4"]
AMMONIA = ["ammonia1", "ammonia2"]
NEW_LITTER = "Cama Nueva"


def evaluated(readings: DataFrame, keys: Sequence[str], date: str, cols: Sequence[str]) -> DataFrame:
    """Readings with a value; of an entity that has none, those of its first day, so that no entity is lost."""
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in cols[1:]), F.coalesce(F.col(cols[0]), F.lit(0.0)))
    each = readings.withColumn("__total", total)
    seen = each.groupBy(*keys).agg(F.max(F.abs("__total")).alias("__most"), F.min(date).alias("__first"))
    kept = each.join(seen, list(keys)).where((F.col("__total") != 0) | ((F.col("__most") == 0) & (F.col(date) == F.col("__first"))))
    return kept.select(*readings.columns)


def temperature(
    readings: DataFrame, houses: DataFrame, published: DataFrame | None, keys: Sequence[str], as_of: dt.date, months: int = 4
) -> DataFrame:
    """The temperature fact: one row a reading, with extremes and mean of the heaps, days since the hatch and the house's figures.

    ``readings`` has ``disinfected_on``, ``hatched_on``, ``litter``, the heaps and ammonia; ``houses`` has ``heads``,
    ``started_on`` and ``cleaning_days`` per key, of which the highest count. The last months are replaced; afterwards all
    rows, published ones too, take the figures of their house, as these change until a lot is closed.
    """
    fresh = row_extremes(evaluated(readings, keys, "disinfected_on", [*AMMONIA, *HEAPS]), HEAPS)
    fresh = fresh.withColumns({
        "ammonia1": F.coalesce("ammonia1", F.lit(0.0)), "litter": F.coalesce("litter", F.lit(NEW_LITTER)),
        "days_empty": F.datediff("disinfected_on", "hatched_on") - 1,
        "heads": F.lit(None).cast("double"), "started_on": F.lit(None).cast("date"), "cleaning_days": F.lit(None).cast("int"),
    }).distinct()
    table = fresh if published is None else replace_rolling(published, fresh, "disinfected_on", as_of, months)
    figures = houses.groupBy(*keys, "started_on").agg(F.max("heads").alias("heads"), (F.max("cleaning_days") - 1).alias("cleaning_days"))
    return update_from(table, figures, keys, {"heads": "heads", "started_on": "started_on", "cleaning_days": "cleaning_days"})


def use_by_state(
    use: DataFrame, bases: DataFrame, running: DataFrame, rules: Sequence[tuple[Column, str]], default: str, scale: int = 4
) -> DataFrame:
    """Use per 1000 of the base that the line's state and kind ask for.

    ``bases`` has one row per level and entity (lot, house or pen) with its state and bases, so a line meets the level it
    was booked on by one equality join; ``running`` has the heads placed up to a day. The first rule that holds names the
    base, ``default`` the one where none does.
    """
    met = use.join(bases, ["level", "entity"], "left").join(running, ["entity", "day"], "left")
    base = F.col(default)
    for cond, name in reversed(list(rules)):
        base = F.when(cond, F.col(name)).otherwise(base)
    return met.withColumn("per_thousand", per_thousand("quantity", base, scale))


def level_bases(pens: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Heads, kilos and latest state of every level's entities; one scan, a pen counts once in each of its levels."""
    entity = [F.struct(F.lit(name).alias("level"), F.concat_ws("-", *keys).alias("entity")) for name, keys in levels.items()]
    lines = pens.select("heads", "kilos", "state", F.inline(F.array(*entity)))
    return lines.groupBy("level", "entity").agg(F.sum("heads").alias("heads_placed"), F.sum("kilos").alias("kilos_sold"), F.max("state").alias("state"))


def _readings(t: Tables) -> DataFrame:
    """Lines as cleaning records of a house: supplier = lot, line number = house; every third house has no values."""
    silent = F.col("l_suppkey") % 3 == 0
    heap = lambda c: F.when(silent, 0.0).otherwise(F.round(c, 2))
    return t.lineitem.select(
        F.col("l_suppkey").alias("lot"), F.col("l_linenumber").alias("house"), day("l_shipdate").alias("disinfected_on"),
        F.date_sub(day("l_shipdate"), F.col("l_linenumber") * 7).alias("hatched_on"), F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("litter"),
        F.when(~silent & (F.col("l_linestatus") == "F"), F.round(F.col("l_discount") * 100, 0)).alias("ammonia1"), heap(F.col("l_tax") * 100).alias("ammonia2"),
        heap(F.col("l_quantity") + 20).alias("heap1"), heap(F.col("l_discount") * 100 + 30).alias("heap2"),
        heap(F.col("l_tax") * 100 + 35).alias("heap3"), heap(F.col("l_linenumber") + 40.0).alias("heap4"),
    )


_R = """r AS (SELECT l_suppkey AS lot, l_linenumber AS house, CAST(l_shipdate AS DATE) AS disinfected_on, CAST(l_shipdate AS DATE) - l_linenumber * 7 AS hatched_on, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS litter,
    CASE WHEN l_suppkey % 3 <> 0 AND l_linestatus = 'F' THEN ROUND(l_discount * 100, 0) END AS ammonia1, CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE ROUND(l_tax * 100, 2) END AS ammonia2,
    CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE ROUND(l_quantity + 20, 2) END AS heap1, CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE ROUND(l_discount * 100 + 30, 2) END AS heap2,
    CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE ROUND(l_tax * 100 + 35, 2) END AS heap3, CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE l_linenumber + 40.0 END AS heap4 FROM lineitem)"""


@query(
    "plan_house_temperature",
    f"""WITH {_R}, v AS (SELECT *, COALESCE(ammonia1, 0) + ammonia2 + heap1 + heap2 + heap3 + heap4 AS total FROM r), s AS (SELECT lot, house, MAX(total) AS most, MIN(disinfected_on) AS first FROM v GROUP BY 1, 2),
    k AS (SELECT DISTINCT lot, house, disinfected_on, hatched_on, COALESCE(litter, 'Cama Nueva') AS litter, COALESCE(ammonia1, 0) AS ammonia1, ammonia2, heap1, heap2, heap3, heap4, GREATEST(heap1, heap2, heap3, heap4) AS row_max,
      LEAST(heap1, heap2, heap3, heap4) AS row_min, {fx("(heap1 + heap2 + heap3 + heap4) / 4")} AS row_mean, CAST(date_diff('day', hatched_on, disinfected_on) - 1 AS INTEGER) AS days_empty
      FROM v JOIN s USING (lot, house) WHERE total <> 0 OR (most = 0 AND disinfected_on = first)),
    h AS (SELECT l_suppkey AS lot, l_linenumber AS house, CAST(o_orderdate AS DATE) AS started_on, MAX(l_quantity) AS heads, CAST(MAX(l_tax * 100 + 5) AS INTEGER) - 1 AS cleaning_days FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3),
    f AS (SELECT lot, house, arg_max(ROW(heads, started_on, cleaning_days), ROW(heads, started_on, cleaning_days)) AS x FROM h GROUP BY 1, 2)
    SELECT q.*, x[1] AS heads, x[2] AS started_on, x[3] AS cleaning_days FROM (SELECT * FROM k WHERE disinfected_on >= DATE '2001-04-01'
      UNION ALL SELECT DISTINCT lot, house, disinfected_on, hatched_on, 'old', 0, 0, 0, 0, 0, 0, 0, 0, 0, 0 FROM r WHERE disinfected_on < DATE '2001-04-01') q LEFT JOIN f USING (lot, house)""",
)
def plan_house_temperature(t: Tables):
    """The last four months of readings anew, older rows as published, all with the figures of their house."""
    readings = _readings(t)
    started = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), day("o_orderdate").alias("started_on"))
    houses = t.lineitem.join(started, "l_orderkey").select(
        F.col("l_suppkey").alias("lot"), F.col("l_linenumber").alias("house"), "started_on", F.col("l_quantity").alias("heads"),
        F.round(F.col("l_tax") * 100 + 5).cast("int").alias("cleaning_days"),
    )
    out = ["lot", "house", "disinfected_on", "hatched_on", "litter", *AMMONIA, *HEAPS, "row_max", "row_min", "row_mean", "days_empty", "heads", "started_on", "cleaning_days"]
    blank = {c: F.lit(0.0) for c in [*AMMONIA, *HEAPS, "row_max", "row_min", "row_mean", "heads"]}
    published = readings.withColumns({**blank, "litter": F.lit("old"), "days_empty": F.lit(0), "started_on": F.lit(None).cast("date"), "cleaning_days": F.lit(0)}).select(*out).distinct()
    return temperature(readings, houses, published, ["lot", "house"], AS_OF).select(*out)


LEVELS = {"F": ["lot"], "H": ["lot", "house"], "P": ["lot", "house", "pen"]}
_BASES = " UNION ALL ".join(f"SELECT '{n}' AS level, {' || chr(45) || '.join(k)} AS entity, heads, kilos, state FROM pens" for n, k in LEVELS.items())


@query(
    "plan_use_by_state",
    f"""WITH pens AS (SELECT l_suppkey AS lot, l_returnflag AS house, l_linenumber AS pen, SUM(l_quantity) AS heads, SUM(l_quantity * 2) AS kilos, CAST(MAX(l_tax * 100) AS INTEGER) % 5 AS state FROM lineitem GROUP BY 1, 2, 3),
    b AS (SELECT level, entity, SUM(heads) AS heads_placed, SUM(kilos) AS kilos_sold, MAX(state) AS state FROM ({_BASES}) GROUP BY 1, 2),
    u AS (SELECT l_orderkey, CASE WHEN l_linenumber < 3 THEN 'F' WHEN l_linenumber < 5 THEN 'H' ELSE 'P' END AS level, CAST(l_shipdate AS DATE) AS day, l_quantity AS quantity, l_partkey % 6 AS subgroup, l_partkey % 143 AS age,
      CASE WHEN l_linenumber < 3 THEN l_suppkey || '' WHEN l_linenumber < 5 THEN l_suppkey || '-' || l_returnflag ELSE l_suppkey || '-' || l_returnflag || '-' || l_linenumber END AS entity FROM lineitem),
    d AS (SELECT entity, day, SUM(quantity) AS q FROM u GROUP BY 1, 2), a AS (SELECT entity, day, SUM(q) OVER (PARTITION BY entity ORDER BY day) AS heads_so_far FROM d)
    SELECT l_orderkey, u.level, u.entity, u.day, quantity, subgroup, age, state, COALESCE({fx("quantity * 1000 / NULLIF(CASE WHEN subgroup = 4 AND state IN (3, 4) THEN kilos_sold WHEN age = 142 THEN heads_placed ELSE heads_so_far END, 0)")}, 0) AS per_thousand
    FROM u LEFT JOIN b ON u.level = b.level AND u.entity = b.entity LEFT JOIN a ON u.entity = a.entity AND u.day = a.day""",
)
def plan_use_by_state(t: Tables):
    """Use per 1000: kilos sold for gas of lots in a closing state, heads placed on day 142, else the heads placed so far."""
    from farmledger.operators.ordered import cumulate

    lines = t.lineitem
    pens = lines.groupBy(F.col("l_suppkey").alias("lot"), F.col("l_returnflag").alias("house"), F.col("l_linenumber").alias("pen")).agg(
        F.sum("l_quantity").alias("heads"), F.sum(F.col("l_quantity") * 2).alias("kilos"), (F.round(F.max("l_tax") * 100).cast("int") % 5).alias("state")
    )
    n = F.col("l_linenumber")
    level = F.when(n < 3, "F").when(n < 5, "H").otherwise("P")
    entity = F.when(n < 3, F.concat_ws("-", "l_suppkey")).when(n < 5, F.concat_ws("-", "l_suppkey", "l_returnflag")).otherwise(F.concat_ws("-", "l_suppkey", "l_returnflag", "l_linenumber"))
    use = lines.select(
        "l_orderkey", level.alias("level"), entity.alias("entity"), day("l_shipdate").alias("day"), F.col("l_quantity").alias("quantity"),
        (F.col("l_partkey") % 6).alias("subgroup"), (F.col("l_partkey") % 143).alias("age"),
    )
    daily = use.groupBy("entity", "day").agg(F.sum("quantity").alias("q"))
    running = cumulate(daily, ["entity"], ["day"], [], {"heads_so_far": ("sum", "q")}).select("entity", "day", "heads_so_far")
    rules = [((F.col("subgroup") == 4) & F.col("state").isin(3, 4), "kilos_sold"), (F.col("age") == 142, "heads_placed")]
    out = use_by_state(use, level_bases(pens, LEVELS), running, rules, "heads_so_far")
    return out.select("l_orderkey", "level", "entity", "day", "quantity", "subgroup", "age", "state", "per_thousand")
