"""Journal sections and task extracts, each from one pass over the journal, and their queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farmledger.functions import fixed, in_month, previous_month, rolling_months, safe_ratio
from farmledger.operators.merge import replace_rolling
from farmledger.plans.costs import JOURNAL, journal
from farmledger.plans.registry import query
from farmledger.plans.standins import AS_OF, day, fx
from farmledger.sources.tables import Tables


@dataclass(frozen=True)
class Extract:
    """A named part of the journal: the lines that count, and the columns it publishes (others are NULL, or blank text)."""

    name: str
    where: Column
    columns: Sequence[str]
    blank: Sequence[str] = ()


def extracts(journal: DataFrame, parts: Sequence[Extract], cols: Sequence[str], tag: str = "extract") -> DataFrame:
    """The lines of every extract with the extract's name; a line that several extracts want comes once for each.

    One scan serves all: a line carries the positions of the extracts that want it and is repeated for those alone.
    Columns that an extract does not publish are NULL, those that it names as ``blank`` are empty texts.
    """
    wanted = F.filter(F.array(*[F.when(p.where, F.lit(k)) for k, p in enumerate(parts)]), lambda x: x.isNotNull())
    any_of = parts[0].where
    for p in parts[1:]:
        any_of = any_of | p.where
    lines = journal.where(any_of).select(*cols, F.explode(wanted).alias("__part"))

    def value(c: str) -> Column:
        blank = [k for k, p in enumerate(parts) if c in p.blank]
        shown = [k for k, p in enumerate(parts) if c in p.columns]
        if not blank and len(shown) == len(parts):
            return F.col(c)
        out = F.when(F.col("__part").isin(blank), F.lit("")) if blank else None
        held = F.col("__part").isin(shown)
        return (F.when(held, F.col(c)) if out is None else out.when(held, F.col(c))).alias(c)

    names = F.array(*[F.lit(p.name) for p in parts])
    return lines.select(F.element_at(names, F.col("__part") + 1).alias(tag), *[value(c) for c in cols])


def journal_sections(journal: DataFrame, parts: Sequence[Extract], cols: Sequence[str], amount: str, date: str, as_of: dt.date) -> DataFrame:
    """Last month's cost of the sections with the sign turned, and its year and month."""
    last = journal.where(in_month(date, previous_month(as_of)))
    out = extracts(last, parts, cols, "section")
    return out.withColumns({amount: -F.col(amount), "year": F.year(date), "month": F.month(date)})


def publish_tasks(journal: DataFrame, tasks: Sequence[Extract], cols: Sequence[str], published: DataFrame | None, date: str, as_of: dt.date) -> DataFrame:
    """Last month's lines of every task in place of that month's published ones; months before and after it stay."""
    month = previous_month(as_of)
    fresh = extracts(journal.where(in_month(date, month)), tasks, cols, "task")
    if published is None:
        return fresh
    kept = published.where(F.col(date).isNull() | ~in_month(date, month))
    return fresh.unionByName(kept.select(*fresh.columns))


def industry_costs(
    journal: DataFrame, businesses: Mapping[str, Column], kilos: Column, entity: Sequence[str], date: str, amount: str,
    published: DataFrame | None, as_of: dt.date, months: int = 1,
) -> DataFrame:
    """Cost and unit cost of every business line per entity and month, replacing the last months of the published table.

    A line belongs to the first business whose rule holds; lines of none are left out.
    """
    label = F.lit(None).cast("string")
    for name, rule in reversed(list(businesses.items())):
        label = F.when(rule, name).otherwise(label)
    totals = (
        journal.where(rolling_months(date, as_of, months))
        .withColumns({"business": label, "month": F.trunc(date, "month")})
        .where(F.col("business").isNotNull())
        .groupBy("business", *entity, "month")
        .agg(F.sum(amount).alias("cost"), F.sum(kilos).alias("kilos"))
        .withColumn("unit_cost", safe_ratio("cost", "kilos"))
        .withColumn("cost", fixed("cost", 2))
    )
    return totals if published is None else replace_rolling(published, totals, "month", as_of, months)


_COLS = ["l_orderkey", "l_linenumber", "farm", "lot", "element", "p_brand", "amount", "posted_on"]
_J = f"(SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS VARCHAR) AS farm, CAST(l_partkey AS VARCHAR) AS lot, element, p_brand, amount, CAST(l_shipdate AS DATE) AS posted_on, l_returnflag, l_linestatus, l_tax, l_quantity FROM {JOURNAL})"


def _journal(t: Tables) -> DataFrame:
    lines = journal(t)
    return lines.select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("farm"), F.col("l_partkey").cast("string").alias("lot"),
        "element", "p_brand", "amount", F.col("l_shipdate").alias("posted_on"), "l_returnflag", "l_linestatus", "l_tax", "l_quantity",
    )


_LAST = "posted_on >= DATE '2001-07-01' AND posted_on < DATE '2001-08-01'"


@query(
    "plan_journal_sections",
    f"""WITH j AS (SELECT * FROM {_J} WHERE {_LAST}), u AS (
    SELECT 'broiler' AS section, * FROM j WHERE l_returnflag = 'N' AND element <> 'PROMO'
    UNION ALL SELECT 'breeder', * FROM j WHERE l_returnflag IN ('A', 'R') AND element <> 'SMALL'
    UNION ALL SELECT 'hatchery', l_orderkey, l_linenumber, '', '', element, p_brand, amount, posted_on, l_returnflag, l_linestatus, l_tax, l_quantity FROM j WHERE l_linestatus = 'O' AND element IN ('PROMO', 'LARGE'))
    SELECT section, l_orderkey, l_linenumber, farm, lot, element, p_brand, -amount AS amount, posted_on, YEAR(posted_on) AS year, MONTH(posted_on) AS month FROM u""",
)
def plan_journal_sections(t: Tables):
    """Broiler, breeder and hatchery cost of last month; the hatchery has no farm and no lot."""
    element, flag = F.col("element"), F.col("l_returnflag")
    parts = [
        Extract("broiler", (flag == "N") & (element != "PROMO"), _COLS),
        Extract("breeder", flag.isin("A", "R") & (element != "SMALL"), _COLS),
        Extract("hatchery", (F.col("l_linestatus") == "O") & element.isin("PROMO", "LARGE"), _COLS, blank=("farm", "lot")),
    ]
    return journal_sections(_journal(t), parts, _COLS, "amount", "posted_on", AS_OF).withColumn("posted_on", day("posted_on"))


# Part types in their role as source codes; a task takes one or more of them.
TASKS = {"13800": ("ECONOMY",), "13900": ("LARGE",), "13910": ("MEDIUM",), "14000": ("PROMO",), "14100": ("SMALL", "STANDARD"),
         "14110": ("SMALL",), "14120": ("STANDARD",), "14200": ("LARGE", "MEDIUM"), "14300": ("ECONOMY", "PROMO"), "14400": ("STANDARD", "PROMO")}
NO_BRAND = ("13910", "14110")


@query(
    "plan_task_extracts",
    " UNION ALL ".join(
        f"SELECT '{task}' AS task, l_orderkey, l_linenumber, farm, lot, element, {'NULL' if task in NO_BRAND else 'p_brand'} AS p_brand, amount, posted_on FROM {_J} WHERE element IN ({', '.join(repr(c) for c in codes)}) AND {_LAST}"
        for task, codes in TASKS.items()
    )
    + f" UNION ALL SELECT '13800', l_orderkey, l_linenumber, farm, lot, element, p_brand, 0, posted_on FROM {_J} WHERE element = 'ECONOMY' AND NOT ({_LAST})",
)
def plan_task_extracts(t: Tables):
    """Ten tasks of last month from one pass; the published lines of other months stay."""
    lines = _journal(t)
    tasks = [Extract(name, F.col("element").isin(*codes), [c for c in _COLS if c != "p_brand" or name not in NO_BRAND]) for name, codes in TASKS.items()]
    published = lines.where(F.col("element") == "ECONOMY").select(F.lit("13800").alias("task"), *[c if c != "amount" else F.lit(0.0).alias(c) for c in _COLS])
    return publish_tasks(lines, tasks, _COLS, published, "posted_on", AS_OF).withColumn("posted_on", day("posted_on"))


_BUSINESS = "CASE WHEN element = 'SMALL' THEN 'pig' WHEN element IN ('MEDIUM', 'LARGE') AND l_returnflag = 'N' THEN 'egg' WHEN l_returnflag = 'R' THEN 'breeder' WHEN l_tax >= 0.05 THEN 'industrial' END"


@query(
    "plan_industry_costs",
    f"""WITH j AS (SELECT *, {_BUSINESS} AS business, CAST(date_trunc('month', posted_on) AS DATE) AS month FROM {_J})
    SELECT business, farm, month, {fx("SUM(-amount)", 2)} AS cost, SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS kilos,
    COALESCE({fx("SUM(-amount) / NULLIF(SUM(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END), 0)")}, 0) AS unit_cost FROM j WHERE month >= DATE '2001-07-01' AND business IS NOT NULL GROUP BY 1, 2, 3
    UNION ALL SELECT DISTINCT 'published', farm, month, 0, 0, 0 FROM j WHERE month < DATE '2001-07-01'""",
)
def plan_industry_costs(t: Tables):
    """Pig, egg, breeder and industrial cost per farm and month."""
    lines = _journal(t).withColumn("spent", -F.col("amount"))
    element, flag = F.col("element"), F.col("l_returnflag")
    businesses = {"pig": element == "SMALL", "egg": element.isin("MEDIUM", "LARGE") & (flag == "N"), "breeder": flag == "R", "industrial": F.col("l_tax") >= 0.05}
    kilos = F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0.0)
    zero = {c: F.lit(0.0) for c in ("cost", "kilos", "unit_cost")}
    published = lines.select(F.lit("published").alias("business"), "farm", F.trunc("posted_on", "month").alias("month")).distinct().withColumns(zero)
    return industry_costs(lines, businesses, kilos, ["farm"], "posted_on", "spent", published, AS_OF)
