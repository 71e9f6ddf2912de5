"""Production figures by level and period over the field readings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from farmledger.plans import production as P
from farmledger.plans.production_queries import CAUSES, FIELD_DAYS, field_days
from farmledger.plans.registry import query
from farmledger.plans.standins import fx
from farmledger.sources.tables import Tables

SUMS = ["deaths", "feed"]
_PERIODS = {"age": "age", "week": "CAST(floor((age + 6) / 7) AS INTEGER)", "month_id": "strftime(day, '%Y%m')"}


def _register(name: str, level: str, period: str) -> None:
    keys = dict(P.LEVELS)[level]
    by = ", ".join(keys)
    totals = ", ".join(f"SUM({c}) AS {c}" for c in SUMS)
    so_far = ", ".join(f"SUM({c}) OVER w AS {c}_so_far" for c in SUMS)

    @query(
        name,
        f"""WITH {FIELD_DAYS}, p AS (SELECT {by}, {_PERIODS[period]} AS period, {totals} FROM field_days GROUP BY ALL)
        SELECT {by}, period AS {period}, {", ".join(SUMS)}, {so_far} FROM p WINDOW w AS (PARTITION BY {by} ORDER BY period)""",
    )
    def build(t: Tables) -> DataFrame:
        return P.period_totals(field_days(t), keys, period, SUMS)


for _name, _level, _period in (
    ("plan_breeder_lot_day", "lot", "age"),
    ("plan_breeder_lot_week", "lot", "week"),
    ("plan_breeder_lot_month", "lot", "month_id"),
    ("plan_breeder_house_week", "house", "week"),
    ("plan_breeder_house_month", "house", "month_id"),
):
    _register(_name, _level, _period)


@query(
    "plan_breeder_liquidation_house",
    f"""WITH {FIELD_DAYS}, p AS (SELECT zone, lot, house, pen, SUM(deaths) AS deaths, MAX(age) AS age, MAX(day) AS closed_on FROM field_days GROUP BY ALL)
    SELECT zone, lot, house, MAX(closed_on) AS closed_on, SUM(deaths) AS deaths, {fx("SUM(age * deaths) / SUM(deaths)")} AS closing_age FROM p GROUP BY 1, 2, 3""",
)
def plan_breeder_liquidation_house(t: Tables):
    return P.breeder_liquidation(field_days(t), ["zone", "lot", "house"])


_LONG = " UNION ALL ".join(f"SELECT zone, lot, house, pen, week, '{c}' AS cause, {c} AS n FROM w" for c in CAUSES)


@query(
    "plan_mortality_causes_levels",
    f"""WITH {FIELD_DAYS}, w AS (SELECT *, CAST(floor((age + 6) / 7) AS INTEGER) AS week FROM field_days),
    l AS (SELECT CASE grouping_id(house, pen) WHEN 0 THEN 'pen' WHEN 1 THEN 'house' ELSE 'lot' END AS level, zone, lot, house, pen, week, cause, SUM(n) AS q FROM ({_LONG})
      GROUP BY GROUPING SETS ((zone, lot, house, pen, week, cause), (zone, lot, house, week, cause), (zone, lot, week, cause)) HAVING SUM(n) <> 0),
    r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY level, zone, lot, house, pen, week ORDER BY q DESC, cause) AS rn FROM l)
    SELECT level, zone, lot, house, pen, week, """ + ", ".join(
        f"MAX(CASE WHEN rn = {i} THEN cause END) AS name_{i}, MAX(CASE WHEN rn = {i} THEN q END) AS qty_{i}, {fx(f'MAX(CASE WHEN rn = {i} THEN q END) / SUM(q) * 100')} AS pct_{i}" for i in (1, 2, 3)
    ) + ", COALESCE(SUM(CASE WHEN rn > 3 THEN q END), 0) AS qty_others, SUM(q) AS qty_total FROM r GROUP BY level, zone, lot, house, pen, week",
)
def plan_mortality_causes_levels(t: Tables):
    return P.mortality_causes_levels(field_days(t), CAUSES)
