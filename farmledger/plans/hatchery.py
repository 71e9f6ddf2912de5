"""Hatchery tables: candled trays, the daily and weekly hatch with break-out results, and their queries.

Every measure is a sum of whole eggs; percentages are derived from the sums of their level.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farmledger.functions import fixed, safe_pct
from farmledger.operators.merge import replace_rolling
from farmledger.plans.registry import query
from farmledger.plans.standins import AS_OF, day, fx
from farmledger.sources.tables import Tables

# What a broken-out egg can be; embryo losses come first.
EMBRYO = ["week1", "week2", "week3", "pips_live", "pips_dead", "broken"]
SPOILT = ["fungus", "bomb", "exploded"]
SAMPLED = [*EMBRYO, *SPOILT, "infertile", "other"]
EGGS = ["set_eggs", "first_chicks", "culled"]
STANDARDS = ["std_first", "std_hatch", "std_fertile", "std_embryo"]
# Age groups of the parent flock in weeks.
AGE_GROUPS = [(24, 35, "Joven"), (36, 50, "Adulto"), (51, None, "Viejo")]


def candling(trays: DataFrame, ages: DataFrame, published: DataFrame | None, as_of: dt.date, months: int = 4) -> DataFrame:
    """Trays with the parent flock's age when the eggs were laid and when they were set, replacing the last months.

    ``ages`` has ``lot``, ``house``, ``day`` and ``age``. A tray without a machine gets the machine 1, one without a day the
    day 1899-11-30, which lies before every window.
    """
    known = ages.groupBy("lot", "house", "day").agg(F.min("age").alias("age"))
    laid = known.select("lot", "house", F.col("day").alias("laid_on"), F.col("age").alias("age_laid"))
    put = known.select("lot", "house", F.col("day").alias("set_on"), F.col("age").alias("age_set"))
    fresh = trays.withColumns({
        "machine": F.coalesce("machine", F.lit(1)), "day": F.coalesce("day", F.lit(dt.date(1899, 11, 30))),
    })
    fresh = fresh.join(laid, ["lot", "house", "laid_on"], "left").join(put, ["lot", "house", "set_on"], "left")
    for c in SAMPLED:
        fresh = fresh.withColumn(f"pct_{c}", safe_pct(c, "samples", 2))
    return fresh if published is None else replace_rolling(published, fresh, "day", as_of, months)


def hatch_daily(trays: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Eggs set, chicks and break-out results per key and day, with the youngest age of the parents."""
    sums = [F.sum(c).alias(c) for c in [*EGGS, *SAMPLED]]
    return trays.groupBy(*keys, "day").agg(F.min("age").alias("age"), *sums)


def _group(age: Column) -> Column:
    out = F.lit(None).cast("string")
    for low, high, name in reversed(AGE_GROUPS):
        out = F.when((age >= low) & (F.lit(True) if high is None else age <= high), name).otherwise(out)
    return out


def hatch_weekly(daily: DataFrame, std: DataFrame, keys: Sequence[str], breeds: Mapping[str, str]) -> DataFrame:
    """The week's hatch per key against the standard of breed and age, with break-out results carried to all unhatched eggs.

    ``std`` has ``breed``, ``age`` and the percentages ``STANDARDS``; a missing one leaves its comparisons NULL. A share of
    the broken-out eggs is scaled by the share of eggs that did not hatch. ``breeds`` maps a breed to the suffix of its
    own columns of eggs and chicks.
    """
    at = {"year": F.year("day"), "month": F.month("day"), "week": F.weekofyear("day")}
    sums = [F.sum(c).alias(c) for c in [*EGGS, *SAMPLED]]
    weekly = daily.withColumns(at).groupBy(*keys, *at).agg(F.max("day").alias("last_day"), F.min("age").alias("age"), *sums)
    eggs, hatched = F.col("set_eggs"), F.col("first_chicks") + F.col("culled")
    sampled = sum((F.col(c) for c in SAMPLED[1:]), F.col(SAMPLED[0]))
    lost = F.try_divide(eggs - hatched, eggs)
    embryo = sum((F.col(c) for c in EMBRYO[1:]), F.col(EMBRYO[0]))

    def share(c: Column) -> Column:
        return F.coalesce(fixed(F.try_divide(c * lost, sampled) * 100, 2), F.lit(0.0))

    met = weekly.withColumns({"hatched": hatched, "pct_first": safe_pct("first_chicks", "set_eggs", 2), "pct_culled": safe_pct("culled", "set_eggs", 2),
                              "pct_hatch": safe_pct(hatched, eggs, 2), "pct_embryo": share(embryo), "pct_fertile": fixed(100 - share(F.col("infertile")), 2),
                              **{f"pct_{c}": share(F.col(c)) for c in [*EMBRYO, "fungus", "other"]},
                              "pct_bomb": safe_pct(F.col("bomb") + F.col("exploded"), eggs, 2)})
    met = met.withColumns({
        "pct_usable": safe_pct("pct_first", "pct_hatch", 2), "fertile": fixed(F.col("pct_fertile") * eggs / 100, 0),
        "pct_hatchability": safe_pct("pct_hatch", "pct_fertile", 2),
        "pct_spoilt": fixed(F.col("pct_fungus") + F.col("pct_bomb") + F.col("pct_other"), 2),
        "accounted": fixed(F.col("pct_hatch") + (100 - F.col("pct_fertile")) + F.col("pct_embryo"), 2),
        "age_group": _group(F.col("age")),
        **{f"{c}_{suffix}": F.when(F.col("breed") == breed, F.col(c)).otherwise(F.lit(0.0)) for breed, suffix in breeds.items() for c in ("set_eggs", "first_chicks")},
    })
    met = met.join(std, ["breed", "age"], "left")
    return met.withColumns({
        **{f"due{s[3:]}": fixed(F.col(s) * eggs / 100, 0) for s in STANDARDS},
        **{f"gap{s[3:]}": fixed(F.col(f"pct{s[3:]}") - F.col(s), 2) for s in STANDARDS},
    })


BREEDS = {"PROMO": "cobb", "LARGE": "ross"}


def _trays(t: Tables) -> DataFrame:
    """Lines as trays: supplier = lot, return flag = house, line number = machine, quantity = eggs."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("breed"), F.col("p_size").alias("age"))
    a, b, n = F.round(F.col("l_discount") * 100).cast("int"), F.round(F.col("l_tax") * 100).cast("int"), F.col("l_linenumber")
    counts = {"week1": a % 3, "week2": b % 3, "week3": b % 2, "pips_live": n % 3, "pips_dead": n % 2, "broken": a % 2, "fungus": n % 4,
              "bomb": F.when(a == 10, 1).otherwise(0), "exploded": F.when(b == 8, 1).otherwise(0), "infertile": a % 4, "other": n % 5}
    eggs = F.col("l_quantity")
    return t.lineitem.join(part, "l_partkey").select(
        F.col("l_suppkey").alias("lot"), F.col("l_returnflag").alias("house"), "breed", "age", day("l_shipdate").alias("day"),
        F.col("l_orderkey").alias("tracking"), F.when(n < 7, n).alias("machine"), eggs.alias("set_eggs"),
        F.when(n <= 3, eggs).otherwise(0.0).alias("first_chicks"), F.when(n == 4, eggs).otherwise(0.0).alias("culled"),
        *[c.cast("double").alias(name) for name, c in counts.items()],
    )


_COUNTS = {"week1": "a % 3", "week2": "b % 3", "week3": "b % 2", "pips_live": "n % 3", "pips_dead": "n % 2", "broken": "a % 2", "fungus": "n % 4",
           "bomb": "CASE WHEN a = 10 THEN 1 ELSE 0 END", "exploded": "CASE WHEN b = 8 THEN 1 ELSE 0 END", "infertile": "a % 4", "other": "n % 5"}
_TRAYS = """raw AS (SELECT *, CAST(ROUND(l_discount * 100) AS INTEGER) AS a, CAST(ROUND(l_tax * 100) AS INTEGER) AS b, l_linenumber AS n FROM lineitem JOIN part ON l_partkey = p_partkey),
    trays AS (SELECT l_suppkey AS lot, l_returnflag AS house, p_type AS breed, p_size AS age, CAST(l_shipdate AS DATE) AS day, l_orderkey AS tracking, CASE WHEN n < 7 THEN n END AS machine, l_quantity AS set_eggs,
    CASE WHEN n <= 3 THEN l_quantity ELSE 0 END AS first_chicks, CASE WHEN n = 4 THEN l_quantity ELSE 0 END AS culled, """ + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in _COUNTS.items()) + " FROM raw)"
_SAMPLES = " + ".join(SAMPLED)


def _pct(x: str, y: str) -> str:
    return f"COALESCE({fx(f'{x} / NULLIF({y}, 0) * 100', 2)}, 0)"


@query(
    "plan_hatch_candling",
    f"""WITH {_TRAYS}, ages AS (SELECT lot, house, day, MIN(age) AS age FROM trays GROUP BY ALL),
    c AS (SELECT tracking, lot, house, COALESCE(machine, 1) AS machine, day, set_eggs, {", ".join(SAMPLED)}, {_SAMPLES} AS samples FROM trays WHERE day >= DATE '2001-04-01'),
    old AS (SELECT tracking, lot, house, machine, day FROM trays WHERE day < DATE '2001-04-01')
    SELECT tracking, c.lot, c.house, machine, c.day, set_eggs, p.age AS age_laid, s.age AS age_set, {", ".join(f"{_pct(k, 'samples')} AS pct_{k}" for k in SAMPLED)}
    FROM c LEFT JOIN ages p ON c.lot = p.lot AND c.house = p.house AND p.day = c.day - 10 LEFT JOIN ages s ON c.lot = s.lot AND c.house = s.house AND s.day = c.day - 3
    UNION ALL SELECT tracking, lot, house, machine, day, NULL, NULL, NULL, {", ".join("NULL" for _ in SAMPLED)} FROM old""",
)
def plan_hatch_candling(t: Tables):
    """Trays of the last four months candled anew; older ones stay as they were published."""
    lines = _trays(t)
    samples = sum((F.col(c) for c in SAMPLED[1:]), F.col(SAMPLED[0]))
    trays = lines.withColumns({"laid_on": F.date_sub("day", 10), "set_on": F.date_sub("day", 3), "samples": samples})
    out = ["tracking", "lot", "house", "machine", "day", "set_eggs", "age_laid", "age_set", *[f"pct_{c}" for c in SAMPLED]]
    empty = {"set_eggs": F.lit(None).cast("double"), "age_laid": F.lit(None).cast("int"), "age_set": F.lit(None).cast("int")}
    published = lines.withColumns({**empty, **{f"pct_{c}": F.lit(None).cast("double") for c in SAMPLED}}).select(*out)
    return candling(trays, lines.select("lot", "house", "day", "age"), published, AS_OF)


_STD = """std AS (SELECT p_type AS breed, p_size AS age, """ + ", ".join(f"{fx(f'AVG(p_retailprice) / {d}', 2)} AS {s}" for s, d in zip(STANDARDS, (20, 18, 16, 100))) + " FROM part GROUP BY 1, 2)"


def _share(c: str) -> str:
    return f"COALESCE({fx(f'({c}) * ((set_eggs - hatched) / NULLIF(set_eggs, 0)) / NULLIF({_SAMPLES}, 0) * 100', 2)}, 0)"


@query(
    "plan_hatch_weekly",
    f"""WITH {_TRAYS}, {_STD}, w AS (SELECT lot, breed, house, YEAR(day) AS year, MONTH(day) AS month, WEEK(day) AS week, MAX(day) AS last_day, MIN(age) AS age, {", ".join(f"SUM({c}) AS {c}" for c in [*EGGS, *SAMPLED])}
      FROM trays GROUP BY 1, 2, 3, 4, 5, 6), h AS (SELECT *, first_chicks + culled AS hatched FROM w),
    p AS (SELECT *, {_pct("first_chicks", "set_eggs")} AS pct_first, {_pct("culled", "set_eggs")} AS pct_culled, {_pct("hatched", "set_eggs")} AS pct_hatch, {_share(" + ".join(EMBRYO))} AS pct_embryo,
      {fx(f"100 - {_share('infertile')}", 2)} AS pct_fertile, {", ".join(f"{_share(c)} AS pct_{c}" for c in [*EMBRYO, "fungus", "other"])}, {_pct("(bomb + exploded)", "set_eggs")} AS pct_bomb FROM h)
    SELECT p.*, {_pct("pct_first", "pct_hatch")} AS pct_usable, {fx("pct_fertile * set_eggs / 100", 0)} AS fertile, {_pct("pct_hatch", "pct_fertile")} AS pct_hatchability,
      {fx("pct_fungus + pct_bomb + pct_other", 2)} AS pct_spoilt, {fx("pct_hatch + (100 - pct_fertile) + pct_embryo", 2)} AS accounted,
      CASE WHEN p.age BETWEEN 24 AND 35 THEN 'Joven' WHEN p.age BETWEEN 36 AND 50 THEN 'Adulto' WHEN p.age >= 51 THEN 'Viejo' END AS age_group,
      {", ".join(f"CASE WHEN p.breed = '{b}' THEN {c} ELSE 0 END AS {c}_{s}" for b, s in BREEDS.items() for c in ("set_eggs", "first_chicks"))}, {", ".join(STANDARDS)},
      {", ".join(f"{fx(f'{s} * set_eggs / 100', 0)} AS due{s[3:]}" for s in STANDARDS)}, {", ".join(f"{fx(f'pct{s[3:]} - {s}', 2)} AS gap{s[3:]}" for s in STANDARDS)}
    FROM p LEFT JOIN std ON p.breed = std.breed AND p.age = std.age""",
)
def plan_hatch_weekly(t: Tables):
    """Weekly hatch per lot, breed and house against the breed's standard."""
    std = t.part.groupBy(F.col("p_type").alias("breed"), F.col("p_size").alias("age")).agg(
        *[fixed(F.avg("p_retailprice") / d, 2).alias(s) for s, d in zip(STANDARDS, (20, 18, 16, 100))]
    )
    keys = ["lot", "breed", "house"]
    return hatch_weekly(hatch_daily(_trays(t), keys), std, keys, BREEDS)
