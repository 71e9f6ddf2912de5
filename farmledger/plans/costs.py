"""Queries over costing and planning operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from farmledger.operators import cost
from farmledger.plans.registry import query
from farmledger.plans.standins import AS_OF, day, fx
from farmledger.sources.tables import Tables

# Part types in their role as cost elements.
ELEMENTS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def journal(t: Tables):
    """Lines as journal entries: supplier = cost centre, part type = cost element, negative amounts."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("element"), "p_brand")
    return t.lineitem.join(part, "l_partkey").withColumn("amount", -F.col("l_extendedprice"))


JOURNAL = "(SELECT l.*, p_type AS element, p_brand, -l_extendedprice AS amount FROM lineitem l JOIN part ON l_partkey = p_partkey)"


@query(
    "journal_decode",
    """SELECT l_orderkey, l_linenumber, a.p_name AS material, b.p_name AS centre, c.p_name AS stage FROM lineitem
    LEFT JOIN part a ON l_partkey = a.p_partkey LEFT JOIN part b ON l_suppkey = b.p_partkey LEFT JOIN part c ON l_linenumber = c.p_partkey""",
)
def journal_decode(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    roles = {"material": "l_partkey", "centre": "l_suppkey", "stage": "l_linenumber"}
    return cost.journal_decode(lines, t.part, roles, "p_partkey", "p_name").drop("l_partkey", "l_suppkey")


@query(
    "cost_pivot",
    f"""SELECT l_suppkey, """ + ", ".join(
        f"ROUND(COALESCE(SUM(CASE WHEN element = '{e}' THEN -amount END), 0), 2) AS cost_{e.lower()}" for e in ELEMENTS
    ) + f" FROM {JOURNAL} GROUP BY 1",
)
def cost_pivot(t: Tables):
    names = {e: f"cost_{e.lower()}" for e in ELEMENTS}
    out = cost.cost_pivot(journal(t), ["l_suppkey"], {"element": "element", "amount": "amount"}, names)
    return out.select("l_suppkey", *[F.round(n, 2).alias(n) for n in names.values()])


@query(
    "cost_classify",
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN element = 'PROMO' AND l_returnflag = 'R' THEN 'ALIMENTO' WHEN element IN ('SMALL', 'MEDIUM') THEN 'SANIDAD' WHEN p_brand LIKE '%2_' THEN 'GIM' ELSE 'OTROS' END AS cost_type,
    CASE WHEN l_linestatus = 'F' THEN 'ENGORDE' WHEN l_discount = 0 THEN 'LEVANTE' ELSE 'OTROS' END AS section FROM {JOURNAL}""",
)
def cost_classify(t: Tables):
    element = F.col("element")
    rules = {
        "cost_type": [
            ((element == "PROMO") & (F.col("l_returnflag") == "R"), "ALIMENTO"),
            (element.isin("SMALL", "MEDIUM"), "SANIDAD"),
            (F.col("p_brand").like("%2_"), "GIM"),
        ],
        "section": [(F.col("l_linestatus") == "F", "ENGORDE"), (F.col("l_discount") == 0, "LEVANTE")],
    }
    return cost.cost_classify(journal(t), rules, "OTROS").select("l_orderkey", "l_linenumber", "cost_type", "section")


@query(
    "cost_allocation_base",
    f"""WITH v AS (SELECT l_suppkey, strftime(l_shipdate, '%Y%m') AS month_id, SUM(l_quantity) AS k FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2),
    m AS (SELECT month_id, SUM(k) AS k FROM v GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_suppkey, strftime(l_shipdate, '%Y%m') AS month_id, COALESCE(v.k, 0) AS kilos_entity, COALESCE(m.k, 0) AS kilos_month
    FROM {JOURNAL} j LEFT JOIN v ON j.l_suppkey = v.l_suppkey AND strftime(l_shipdate, '%Y%m') = v.month_id LEFT JOIN m ON strftime(l_shipdate, '%Y%m') = m.month_id""".replace("l_orderkey, l_linenumber, l_suppkey,", "l_orderkey, l_linenumber, j.l_suppkey,"),
)
def cost_allocation_base(t: Tables):
    month = F.date_format("l_shipdate", "yyyyMM").alias("month_id")
    lines = journal(t).select("l_orderkey", "l_linenumber", "l_suppkey", month)
    volumes = t.lineitem.where(F.col("l_returnflag") == "A").select("l_suppkey", month, F.col("l_quantity").alias("kilos"))
    return cost.cost_allocation_base(lines, volumes, ["l_suppkey"], "month_id", "kilos")


@query(
    "cost_eliminations",
    f"""WITH g AS (SELECT l_suppkey, element, SUM(l_extendedprice) AS a FROM {JOURNAL} WHERE l_returnflag = 'R' AND l_shipdate >= DATE '2001-07-01' AND l_shipdate < DATE '2001-08-01' GROUP BY 1, 2),
    o AS (SELECT l_suppkey, SUM(a) AS a FROM g GROUP BY 1)
    SELECT j.l_orderkey, j.l_linenumber, j.l_suppkey, j.element, ROUND(CASE WHEN j.l_shipdate >= DATE '2001-07-01' AND j.l_shipdate < DATE '2001-08-01'
      THEN COALESCE(CASE WHEN j.l_suppkey IN (1, 2, 3) THEN g.a ELSE o.a END, 0) END, 2) AS eliminated
    FROM {JOURNAL} j LEFT JOIN g ON j.l_suppkey = g.l_suppkey AND j.element = g.element LEFT JOIN o ON j.l_suppkey = o.l_suppkey""",
)
def cost_eliminations(t: Tables):
    lines = journal(t)
    cols = {"object": "l_suppkey", "element": "element", "amount": "l_extendedprice", "date": "l_shipdate"}
    out = cost.cost_eliminations(lines, lines.where(F.col("l_returnflag") == "R"), cols, dt.date(2001, 7, 1), [1, 2, 3])
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "element", F.round("eliminated", 2).alias("eliminated"))


@query(
    "cycle_label",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS month_id, 'C' || strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%m') AS cycle FROM orders""",
)
def cycle_label_query(t: Tables):
    months = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("month_id"), F.trunc(day("o_orderdate"), "month").alias("m"))
    return cost.with_cycle(months, "m").drop("m")


_MONTHLY = """monthly AS (SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, ROUND(SUM(l_extendedprice), 2) AS cost,
    'C' || strftime(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH, '%m') AS cycle FROM lineitem GROUP BY l_suppkey, date_trunc('month', l_shipdate))"""


def _monthly(t: Tables):
    monthly = t.lineitem.groupBy("l_suppkey", F.trunc(day("l_shipdate"), "month").alias("month")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("cost")
    )
    return cost.with_cycle(monthly, "month")


@query(
    "cycle_fanout",
    f"""WITH {_MONTHLY}, closed AS (SELECT DISTINCT month AS m FROM monthly WHERE month >= DATE '2000-08-01'),
    again AS (SELECT l_suppkey, month, cost, 'C' || strftime(m + INTERVAL 1 MONTH, '%m') AS cycle FROM monthly JOIN closed ON m >= month WHERE month >= DATE '2000-08-01' AND monthly.cycle = 'C' || strftime(month + INTERVAL 1 MONTH, '%m'))
    SELECT * FROM monthly UNION ALL (SELECT * FROM again EXCEPT SELECT * FROM monthly WHERE month >= DATE '2000-08-01')""",
)
def cycle_fanout(t: Tables):
    return cost.cycle_fanout(_monthly(t), "month", "cycle", AS_OF, 12)


@query("current_extract", f"WITH {_MONTHLY} SELECT * FROM monthly WHERE month >= DATE '2001-07-01'")
def current_extract(t: Tables):
    return cost.current_extract(_monthly(t), "month", AS_OF, 1)


@query(
    "ledger_extract_union",
    """SELECT 'returns' AS task, l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_returnflag = 'R' AND l_discount = 0 UNION ALL
    SELECT 'large', l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_quantity >= 45 UNION ALL
    SELECT 'open', l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_linestatus = 'O' AND l_tax > 0.06""",
)
def ledger_extract_union(t: Tables):
    criteria = [
        ("returns", (F.col("l_returnflag") == "R") & (F.col("l_discount") == 0)),
        ("large", F.col("l_quantity") >= 45),
        ("open", (F.col("l_linestatus") == "O") & (F.col("l_tax") > 0.06)),
    ]
    return cost.ledger_extract_union(t.lineitem, criteria, "task", ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query(
    "sales_standardise",
    """SELECT l_orderkey AS document, l_linenumber AS position, l_partkey AS article, l_extendedprice AS gross, ROUND(l_extendedprice * l_discount, 4) AS discounts, l_quantity AS billed,
    CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month FROM lineitem""",
)
def sales_standardise(t: Tables):
    mapping = {
        "document": "l_orderkey", "position": "l_linenumber", "article": "l_partkey", "gross": "l_extendedprice",
        "discounts": F.round(F.col("l_extendedprice") * F.col("l_discount"), 4), "billed": "l_quantity",
    }
    return cost.sales_standardise(t.lineitem, mapping, "l_shipdate")


@query(
    "expense_per_unit",
    f"""WITH d AS (SELECT c_mktsegment AS channel, n_name AS province, SUM(l_extendedprice * l_discount) AS amount, SUM(l_quantity) AS units
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
    b AS (SELECT * FROM d UNION ALL SELECT channel, 'TOTAL', SUM(amount), SUM(units) FROM d GROUP BY 1)
    SELECT channel, province, {fx("amount", 2)} AS amount, {fx("units", 2)} AS units, COALESCE({fx("amount / NULLIF(units, 0)")}, 0) AS per_unit FROM b""",
)
def expense_per_unit(t: Tables):
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("province"))
    client = t.customer.join(nation, "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("channel"), "province")
    owner = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = t.lineitem.withColumn("expense", F.col("l_extendedprice") * F.col("l_discount"))
    rows = lines.join(owner, "l_orderkey").join(client, "o_custkey")
    return cost.expense_per_unit(rows, ["channel", "province"], ["channel"], "expense", "l_quantity")


@query(
    "weighted_period_price",
    f"""SELECT l_partkey, strftime(l_shipdate, '%Y%m') AS month_id, {fx("SUM(l_extendedprice * l_quantity) / NULLIF(SUM(l_quantity), 0)")} AS price, SUM(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2""",
)
def weighted_period_price(t: Tables):
    return cost.weighted_period_price(t.lineitem, "l_partkey", "l_shipdate", "l_extendedprice", "l_quantity")


@query(
    "revalue_split",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_shipdate >= DATE '1998-07-01' THEN CASE WHEN l_returnflag = 'R' THEN 0 WHEN l_discount = 0 THEN l_extendedprice * 1.5 ELSE l_extendedprice END
      ELSE CASE WHEN l_linestatus = 'O' THEN l_extendedprice * 2 ELSE l_extendedprice END END AS l_extendedprice FROM lineitem""",
)
def revalue_split(t: Tables):
    price = F.col("l_extendedprice")
    before = {"l_extendedprice": [(F.col("l_linestatus") == "O", price * 2)]}
    after = {"l_extendedprice": [(F.col("l_returnflag") == "R", F.lit(0.0)), (F.col("l_discount") == 0, price * 1.5)]}
    out = cost.revalue_split(t.lineitem, "l_shipdate", dt.date(1998, 7, 1), before, after)
    return out.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "latest_closed_month",
    """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS shipped FROM lineitem WHERE strftime(l_shipdate, '%Y%m') = (SELECT strftime(MAX(l_shipdate), '%Y%m') FROM lineitem)""",
)
def latest_closed_month(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", day("l_shipdate").alias("shipped"))
    return cost.latest_closed_month(lines, "shipped", "shipped")


@query(
    "measure_rows",
    """SELECT 'sales' AS obs, l_suppkey AS entity, ROUND(SUM(l_extendedprice), 2) AS amount, CAST(NULL AS BIGINT) AS heads, CAST(NULL AS DOUBLE) AS balance FROM lineitem GROUP BY 2 UNION ALL
    SELECT 'heads', o_custkey, NULL, COUNT(*), NULL FROM orders GROUP BY 2 UNION ALL SELECT 'balance', s_suppkey, NULL, NULL, s_acctbal FROM supplier""",
)
def measure_rows(t: Tables):
    frames = {
        "sales": t.lineitem.groupBy(F.col("l_suppkey").alias("entity")).agg(F.round(F.sum("l_extendedprice"), 2).alias("amount")),
        "heads": t.orders.groupBy(F.col("o_custkey").alias("entity")).agg(F.count(F.lit(1)).alias("heads")),
        "balance": t.supplier.select(F.col("s_suppkey").alias("entity"), F.col("s_acctbal").alias("balance")),
    }
    return cost.measure_rows(frames, "obs")
