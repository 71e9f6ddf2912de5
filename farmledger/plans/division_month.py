"""Wide weeks of a lot, the month by company and division, breeder feed and expenses by channel and province.

Weeks beyond the last wide column are held by that column, and rows before the first week by the first one, so that the
columns of a kind always add up to the lot's total.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farmledger.functions import fixed, safe_pct, safe_ratio
from farmledger.operators.merge import replace_rolling
from farmledger.plans.registry import query
from farmledger.plans.standins import AS_OF, FARM_LINES, day, farm_lines, fx
from farmledger.sources.tables import Tables

WEEKS = 20


def truncated(x: Column, digits: int = 6) -> Column:
    """Cut off, not rounded, after ``digits`` places; decimal, so a sum's noise below eight places cannot decide."""
    return (F.floor(x.cast("decimal(30,8)") * 10**digits) / 10**digits).cast("double")


def lot_weeks(daily: DataFrame, keys: Sequence[str], weeks: int = WEEKS) -> DataFrame:
    """One row per lot: deaths per week and up to it, and each week's weight times heads, for averages at higher levels.

    ``daily`` has ``age`` in days, ``heads``, ``deaths``, ``weight``, ``feed``, ``kilos``, ``sold_on``. A NULL age stays out
    of the weeks and in the totals. All columns come from one aggregate; running deaths are sums of its columns.
    """
    week = F.greatest(F.lit(1), F.least(F.lit(weeks), F.floor((F.col("age") + 6) / 7))).cast("int")
    at = daily.withColumn("__week", F.when(F.col("age").isNotNull(), week))
    numbers = range(1, weeks + 1)
    out = at.groupBy(*keys).agg(
        F.sum("heads").alias("heads"), F.sum("deaths").alias("deaths"), F.sum("feed").alias("feed"), F.sum("kilos").alias("kilos"),
        F.max("age").alias("age"), F.min("sold_on").alias("first_sale"), F.max("sold_on").alias("last_sale"),
        *[F.coalesce(F.sum(F.when(F.col("__week") == k, F.col("deaths"))), F.lit(0)).alias(f"dead_{k}") for k in numbers],
        *[F.coalesce(F.sum(F.when(F.col("__week") == k, F.col("weight") * F.col("heads"))), F.lit(0.0)).alias(f"weight_x_heads_{k}") for k in numbers],
    )
    so_far: list[Column] = []
    for k in numbers:
        so_far.append((so_far[-1] if so_far else F.lit(0)) + F.col(f"dead_{k}"))
    return out.select("*", *[c.alias(f"dead_to_{k}") for k, c in zip(numbers, so_far, strict=True)])


def division_month(lots: DataFrame, counted: Column, base: Column, weeks: int = WEEKS) -> DataFrame:
    """The month by company and division from lots of the states ``counted``.

    Weekly weights are spread over the heads of another set of lots, ``base``, of the whole division: both sets are summed
    in one aggregate, and the division's heads are the sum of its companies' rows. A month without base heads divides by one.
    """

    def total(c: str | Column, cond: Column = counted) -> Column:
        return F.sum(F.when(cond, F.col(c) if isinstance(c, str) else c))

    numbers = range(1, weeks + 1)
    sums = ["heads", "deaths", "feed", "kilos", *[f"dead_{k}" for k in numbers], *[f"dead_to_{k}" for k in numbers]]
    by = lots.where(counted | base).groupBy("month_id", "company", "division").agg(
        F.count_if(counted).alias("lots"), total(F.col("age") * F.col("heads")).alias("__age"), total("heads", base).alias("__base"),
        F.min(F.when(counted, F.col("placed_on"))).alias("first_placed"), F.min(F.when(counted, F.col("first_sale"))).alias("first_sale"),
        F.max(F.when(counted, F.col("last_sale"))).alias("last_sale"), *[total(c).alias(c) for c in sums],
        *[total(f"weight_x_heads_{k}").alias(f"__weight_{k}") for k in numbers],
    )
    whole = F.sum("__base").over(Window.partitionBy("month_id", "division"))
    spread = by.withColumn("base_heads", F.coalesce(whole, F.lit(1.0))).where("lots > 0")
    zero = F.lit(0.0)
    return spread.select(
        "month_id", "company", "division", "lots", "first_placed", "first_sale", "last_sale", "base_heads", *sums,
        F.coalesce(fixed(F.try_divide("__age", "heads"), 0), zero).cast("int").alias("mean_age"), safe_pct("deaths", "heads").alias("dead_pct"),
        F.coalesce(truncated(F.try_divide("kilos", "heads")), zero).alias("mean_weight"), F.coalesce(truncated(F.try_divide("feed", "kilos")), zero).alias("conversion"),
        *[fixed(F.try_divide(f"__weight_{k}", "base_heads")).alias(f"weight_{k}") for k in numbers],
    )


def breeder_feed(
    field: DataFrame, keys: Sequence[str], sexes: Mapping[str, tuple[str, str]], early: Column, as_of: dt.date, months: int = 12
) -> DataFrame:
    """Feed per key, sex, formula and day of life, both sexes from one row.

    ``sexes`` maps a sex to its columns of feed and formula. Feed given up to the day of placement, in the last ``months``, is
    booked on day of life 2 where the age is 0 or -1 or ``early`` holds. Keys without feed are left out.
    """
    recent = F.col("day") >= F.add_months(F.trunc(F.lit(as_of), "month"), -months)
    moved = recent & (F.col("age").isin(0, -1) | ((F.col("age") <= 0) & early))
    each = F.array(*[F.struct(F.lit(s).alias("sex"), F.col(feed).alias("feed"), F.col(formula).alias("formula")) for s, (feed, formula) in sexes.items()])
    rows = field.select(*keys, "day", "age", "price", F.when(moved, 2).otherwise(F.col("age")).alias("life_day"), F.inline(each))
    fed = rows.groupBy(*keys, "sex", "formula", "life_day").agg(
        F.max("day").alias("day"), F.max("age").alias("age"), fixed(F.sum("feed"), 2).alias("feed"), fixed(F.sum(F.col("feed") * F.col("price")), 2).alias("value")
    )
    return fed.where("feed <> 0")


def expense_by_province(lines: DataFrame, kinds: Sequence[str], channels: Mapping[str, str]) -> DataFrame:
    """Expenses, kilos and expense a kilo by month, channel and province, with subtotals by channel, by province and by month.

    ``channels`` maps a sales organisation to its channel; other organisations and lines without a province stay out. All
    levels come from one set of groupings; ``level`` names it, and what a level does not hold is NULL. Give expenses as
    decimals where cents must not depend on the order of a sum.
    """
    names = F.create_map(*[F.lit(x) for pair in channels.items() for x in pair])
    known = lines.where(F.col("org").isin(*channels) & F.col("province").isNotNull()).withColumn("channel", F.try_element_at(names, F.col("org")))
    m, c, p = F.col("month_id"), F.col("channel"), F.col("province")
    level = F.when((F.grouping("channel") == 0) & (F.grouping("province") == 0), "province of channel").when(F.grouping("channel") == 0, "channel").when(F.grouping("province") == 0, "province").otherwise("month")
    out = known.groupingSets([[m, c, p], [m, c], [m, p], [m]], m, c, p).agg(
        level.alias("level"), *[fixed(F.sum(k), 2).alias(k) for k in kinds], F.sum("kilos").alias("kilos"), F.sum(sum((F.col(k) for k in kinds[1:]), F.col(kinds[0]))).alias("__spent")
    )
    return out.withColumns({"spent": fixed("__spent", 2), "per_kilo": safe_ratio("__spent", "kilos", 3)}).drop("__spent")


# Lots are orders, their company the segment of the farm, their division its zone; a line is a pen's sale.
_SUMS = ["heads", "deaths", "feed", "kilos"]


def _daily(t: Tables) -> DataFrame:
    company = t.customer.select(F.col("c_custkey").alias("farm"), F.col("c_mktsegment").alias("company"))
    placed, sold = day("o_orderdate"), day("l_shipdate")
    return farm_lines(t).join(company, "farm").select(
        F.date_format("o_orderdate", "yyyyMM").alias("month_id"), "company", F.col("zone").alias("division"), F.col("l_orderkey").alias("lot"),
        F.col("o_orderstatus").alias("state"), placed.alias("placed_on"), sold.alias("sold_on"), F.datediff(sold, placed).alias("age"), F.col("l_quantity").alias("heads"),
        F.round(F.col("l_tax") * 100).cast("long").alias("deaths"), F.col("l_discount").alias("weight"), (F.col("l_quantity") * 3).alias("feed"), F.col("l_extendedprice").alias("kilos"),
    )


_KEYS = ["month_id", "company", "division", "lot", "state", "placed_on"]
_N = range(1, WEEKS + 1)
_LOTS = f"""company AS (SELECT c_custkey, c_mktsegment AS company FROM customer),
    daily AS (SELECT strftime(o_orderdate, '%Y%m') AS month_id, company, zone AS division, l_orderkey AS lot, o_orderstatus AS state, CAST(o_orderdate AS DATE) AS placed_on, CAST(l_shipdate AS DATE) AS sold_on,
      CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS age, l_quantity AS heads, CAST(ROUND(l_tax * 100) AS BIGINT) AS deaths, l_discount AS weight, l_quantity * 3 AS feed, l_extendedprice AS kilos
      FROM {FARM_LINES} f JOIN company ON f.farm = c_custkey),
    w AS (SELECT *, greatest(1, least({WEEKS}, floor((age + 6) / 7))) AS week FROM daily),
    lots AS (SELECT {", ".join(_KEYS)}, {", ".join(f"SUM({c}) AS {c}" for c in _SUMS)}, MAX(age) AS age, MIN(sold_on) AS first_sale, MAX(sold_on) AS last_sale,
      {", ".join(f"CAST(SUM(CASE WHEN week = {k} THEN deaths ELSE 0 END) AS BIGINT) AS dead_{k}" for k in _N)}, {", ".join(f"CAST(SUM(CASE WHEN week <= {k} THEN deaths ELSE 0 END) AS BIGINT) AS dead_to_{k}" for k in _N)},
      {", ".join(f"SUM(CASE WHEN week = {k} THEN weight * heads ELSE 0 END) AS weight_x_heads_{k}" for k in _N)} FROM w GROUP BY ALL)"""


@query(
    "plan_lot_weeks",
    f"""WITH {_LOTS} SELECT {", ".join(_KEYS)}, heads, CAST(deaths AS BIGINT) AS deaths, feed, age, first_sale, last_sale, {fx("kilos", 2)} AS kilos, {", ".join(f"dead_{k}, dead_to_{k}" for k in _N)},
    {", ".join(f"{fx(f'weight_x_heads_{k}')} AS weight_x_heads_{k}" for k in _N)} FROM lots""",
)
def plan_lot_weeks(t: Tables):
    """Deaths and weights of every lot in wide weeks."""
    wide = lot_weeks(_daily(t), _KEYS)
    return wide.withColumns({"kilos": fixed("kilos", 2), **{f"weight_x_heads_{k}": fixed(f"weight_x_heads_{k}") for k in _N}})


_WIDE = [*[f"dead_{k}" for k in _N], *[f"dead_to_{k}" for k in _N]]


def _cut(x: str) -> str:
    return f"COALESCE(CAST(floor(CAST({x} AS DECIMAL(30, 8)) * 1000000) / 1000000 AS DOUBLE), 0)"


@query(
    "plan_division_month",
    f"""WITH {_LOTS}, base AS (SELECT month_id, division, SUM(heads) AS base_heads FROM lots WHERE state IN ('F', 'P') AND heads <= 150 GROUP BY 1, 2),
    m AS (SELECT l.month_id, company, l.division, COUNT(*) AS lots, MIN(placed_on) AS first_placed, MIN(first_sale) AS first_sale, MAX(last_sale) AS last_sale, COALESCE(MAX(base_heads), 1) AS base_heads,
      {", ".join(f"SUM({c}) AS {c}" for c in ["heads", "feed", "kilos"])}, {", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in ["deaths", *_WIDE])}, SUM(age * heads) AS aged,
      {", ".join(f"SUM(weight_x_heads_{k}) AS wh_{k}" for k in _N)}
      FROM lots l LEFT JOIN base b ON l.month_id = b.month_id AND l.division = b.division WHERE state IN ('F', 'O') AND heads <= 150 GROUP BY 1, 2, 3)
    SELECT month_id, company, division, lots, first_placed, first_sale, last_sale, base_heads, heads, deaths, feed, {fx("kilos", 2)} AS kilos, {", ".join(_WIDE)}, CAST({fx("aged / NULLIF(heads, 0)", 0)} AS INTEGER) AS mean_age,
      {fx("deaths / NULLIF(heads, 0) * 100")} AS dead_pct, {_cut("kilos / NULLIF(heads, 0)")} AS mean_weight, {_cut("feed / NULLIF(kilos, 0)")} AS conversion,
      {", ".join(f"{fx(f'wh_{k} / base_heads')} AS weight_{k}" for k in _N)} FROM m""",
)
def plan_division_month(t: Tables):
    """Typical lots, closed or open, by month, company and division; weights over the heads of closed and pending lots."""
    lots = lot_weeks(_daily(t), _KEYS)
    typical = F.col("heads") <= 150
    out = division_month(lots, F.col("state").isin("F", "O") & typical, F.col("state").isin("F", "P") & typical)
    return out.withColumn("kilos", fixed("kilos", 2))


_SEXES = {"F": ("feed_f", "formula_f"), "M": ("feed_m", "formula_m")}
_FED = "zone, farm, lot, sex, formula, life_day"


@query(
    "plan_breeder_feed",
    f"""WITH field AS (SELECT zone, farm, l_orderkey AS lot, CAST(l_shipdate AS DATE) AS day, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) - 60 AS age,
      l_quantity * l_discount AS feed_f, l_quantity * l_tax AS feed_m, p_type AS formula_f, p_brand AS formula_m, p_retailprice AS price FROM {FARM_LINES} f JOIN part ON l_partkey = p_partkey),
    long AS (SELECT *, 'F' AS sex, feed_f AS feed, formula_f AS formula FROM field UNION ALL SELECT *, 'M', feed_m, formula_m FROM field),
    moved AS (SELECT *, CASE WHEN day >= DATE '2000-08-01' AND (age IN (0, -1) OR (age <= 0 AND zone % 2 = 0)) THEN 2 ELSE age END AS life_day FROM long),
    fed AS (SELECT {_FED}, MAX(day) AS day, MAX(age) AS age, {fx("SUM(feed)", 2)} AS feed, {fx("SUM(feed * price)", 2)} AS value FROM moved GROUP BY ALL)
    SELECT {_FED}, day, age, feed, CASE WHEN day >= DATE '2000-10-01' THEN value END AS value FROM fed WHERE feed <> 0""",
)
def plan_breeder_feed(t: Tables):
    """Feed of breeders by sex and formula: the last ten months computed anew, older ones as they were published, without value."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("formula_f"), F.col("p_brand").alias("formula_m"), F.col("p_retailprice").alias("price"))
    field = farm_lines(t).join(part, "l_partkey").select(
        "zone", "farm", F.col("l_orderkey").alias("lot"), day("l_shipdate").alias("day"), (F.datediff(day("l_shipdate"), day("o_orderdate")) - 60).alias("age"),
        (F.col("l_quantity") * F.col("l_discount")).alias("feed_f"), (F.col("l_quantity") * F.col("l_tax")).alias("feed_m"), "formula_f", "formula_m", "price",
    )
    fed = breeder_feed(field, ["zone", "farm", "lot"], _SEXES, F.col("zone") % 2 == 0, AS_OF)
    return replace_rolling(fed.withColumn("value", F.lit(None).cast("double")), fed, "day", AS_OF, 10)


_KINDS = {"commercial": "l_discount", "freight": "l_tax"}
_CHANNELS = {"A": "live", "N": "processed"}
_LEVEL = "CASE WHEN GROUPING(channel) + GROUPING(province) = 0 THEN 'province of channel' WHEN GROUPING(channel) = 0 THEN 'channel' WHEN GROUPING(province) = 0 THEN 'province' ELSE 'month' END"


@query(
    "plan_expense_provinces",
    f"""WITH e AS (SELECT strftime(l_shipdate, '%Y%m') AS month_id, CASE l_returnflag WHEN 'A' THEN 'live' WHEN 'N' THEN 'processed' END AS channel, n_name AS province,
      CAST(l_discount * l_extendedprice AS DECIMAL(18, 4)) AS commercial, CAST(l_tax * l_extendedprice AS DECIMAL(18, 4)) AS freight, l_quantity AS kilos FROM {FARM_LINES} f JOIN nation ON zone = n_nationkey WHERE l_returnflag IN ('A', 'N'))
    SELECT {_LEVEL} AS level, month_id, channel, province, {fx("SUM(commercial)", 2)} AS commercial, {fx("SUM(freight)", 2)} AS freight, SUM(kilos) AS kilos, {fx("SUM(commercial + freight)", 2)} AS spent,
      COALESCE({fx("SUM(commercial + freight) / NULLIF(SUM(kilos), 0)", 3)}, 0) AS per_kilo FROM e GROUP BY GROUPING SETS ((month_id, channel, province), (month_id, channel), (month_id, province), (month_id))""",
)
def plan_expense_provinces(t: Tables):
    """Expenses of both channels by month and province with all subtotals."""
    province = t.nation.select(F.col("n_nationkey").alias("zone"), F.col("n_name").alias("province"))
    lines = farm_lines(t).join(province, "zone").select(
        F.date_format("l_shipdate", "yyyyMM").alias("month_id"), F.col("l_returnflag").alias("org"), "province", F.col("l_quantity").alias("kilos"),
        *[(F.col(rate) * F.col("l_extendedprice")).cast("decimal(18,4)").alias(k) for k, rate in _KINDS.items()],
    )
    return expense_by_province(lines, list(_KINDS), _CHANNELS)
