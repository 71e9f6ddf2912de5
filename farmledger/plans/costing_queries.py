"""The costing, planning and dimension jobs over the driver tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from farmledger.functions import fixed
from farmledger.operators import cost, dims
from farmledger.plans import costing
from farmledger.plans.costs import ELEMENTS, JOURNAL, journal
from farmledger.plans.registry import query
from farmledger.plans.standins import AS_OF, day, fx
from farmledger.session import scratch_path
from farmledger.sources import detached, replace_months
from farmledger.sources.tables import Tables


@query(
    "plan_live_bird_cost",
    f"""WITH s AS (SELECT l_suppkey, element, SUM(l_extendedprice) AS a FROM {JOURNAL} WHERE l_returnflag = 'R' AND l_shipdate >= DATE '2001-07-01' AND l_shipdate < DATE '2001-08-01' GROUP BY 1, 2),
    o AS (SELECT l_suppkey, SUM(a) AS a FROM s GROUP BY 1),
    n AS (SELECT j.*, p.p_name AS account_name, CASE WHEN j.element = 'PROMO' THEN 'ALIMENTO' WHEN j.element IN ('SMALL', 'MEDIUM') THEN 'SANIDAD' ELSE 'OTROS' END AS cost_type,
      CASE WHEN j.l_shipdate >= DATE '2001-07-01' AND j.l_shipdate < DATE '2001-08-01' THEN COALESCE(CASE WHEN j.l_suppkey = 7 THEN s.a ELSE o.a END, 0) END AS eliminated
      FROM {JOURNAL} j LEFT JOIN part p ON j.l_partkey = p.p_partkey LEFT JOIN s ON j.l_suppkey = s.l_suppkey AND j.element = s.element LEFT JOIN o ON j.l_suppkey = o.l_suppkey)
    SELECT l_orderkey, l_linenumber, account_name, cost_type, ROUND(eliminated, 2) AS eliminated FROM n WHERE l_shipdate >= DATE '2001-07-01'
    UNION ALL SELECT l_orderkey, l_linenumber, 'published', 'OLD', NULL FROM lineitem WHERE l_shipdate < DATE '2001-07-01'""",
)
def plan_live_bird_cost(t: Tables):
    lines = journal(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "element", "l_extendedprice", "l_shipdate", "l_returnflag")
    accounts = t.part.select(F.col("p_partkey").alias("account"), F.col("p_name").alias("account_name"))
    element = F.col("element")
    rules = {"cost_type": [(element == "PROMO", "ALIMENTO"), (element.isin("SMALL", "MEDIUM"), "SANIDAD")]}
    cols = {"object": "l_suppkey", "element": "element", "amount": "l_extendedprice", "date": "l_shipdate"}
    published = lines.withColumns(
        {"account_name": F.lit("published"), "cost_type": F.lit("OLD"), "eliminated": F.lit(None).cast("double")}
    )
    out = costing.live_bird_cost(
        lines, accounts, lines.where(F.col("l_returnflag") == "R"), published, {"account_name": "l_partkey"}, rules, cols, [7], AS_OF
    )
    return out.select("l_orderkey", "l_linenumber", "account_name", "cost_type", F.round("eliminated", 2).alias("eliminated"))


_INDICATORS = " UNION ALL ".join(
    f"SELECT l_suppkey, month_id, 'cost_{e.lower()}' AS indicator, SUM(CASE WHEN element = '{e}' THEN -amount ELSE 0 END) AS amount FROM j GROUP BY 1, 2" for e in ELEMENTS
)


@query(
    "plan_cost_indicators",
    f"""WITH j AS (SELECT *, strftime(l_shipdate, '%Y%m') AS month_id FROM {JOURNAL}), k AS (SELECT l_suppkey, month_id, SUM(l_quantity) AS kilos FROM j WHERE l_linestatus = 'F' GROUP BY 1, 2), i AS ({_INDICATORS})
    SELECT i.l_suppkey, i.month_id, indicator, {fx("amount", 2)} AS amount, COALESCE({fx("amount / NULLIF(kilos, 0)")}, 0) AS per_kilo FROM i LEFT JOIN k ON i.l_suppkey = k.l_suppkey AND i.month_id = k.month_id""",
)
def plan_cost_indicators(t: Tables):
    lines = journal(t).withColumn("month_id", F.date_format("l_shipdate", "yyyyMM"))
    volumes = lines.where(F.col("l_linestatus") == "F").select("l_suppkey", "month_id", F.col("l_quantity").alias("kilos"))
    names = {e: f"cost_{e.lower()}" for e in ELEMENTS}
    return costing.cost_indicators(lines, volumes, ["l_suppkey"], "month_id", {"element": "element", "amount": "amount"}, names)


def _structure(t: Tables):
    lines = t.lineitem.withColumn("month", F.trunc(day("l_shipdate"), "month"))
    kilos = F.when(F.col("l_linestatus") == "F", F.col("l_quantity"))
    return costing.cost_structure(lines, ["l_suppkey"], "month", "l_extendedprice", kilos, AS_OF)


_STRUCTURE = f"""l AS (SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS month FROM lineitem), c AS (SELECT l_suppkey, month, SUM(l_extendedprice) AS amount FROM l GROUP BY 1, 2),
    k AS (SELECT l_suppkey, month, SUM(l_quantity) AS k FROM l WHERE l_linestatus = 'F' GROUP BY 1, 2), m AS (SELECT month, SUM(k) AS k FROM k GROUP BY 1),
    u AS (SELECT c.l_suppkey, c.month, {fx("amount", 2)} AS amount, {fx("COALESCE(k.k, 0)", 2)} AS kilos_entity, COALESCE({fx("amount / NULLIF(COALESCE(k.k, 0), 0)")}, 0) AS unit_cost,
      COALESCE({fx("COALESCE(k.k, 0) / NULLIF(COALESCE(m.k, 0), 0)", 6)}, 0) AS share, 'C' || strftime(c.month + INTERVAL 1 MONTH, '%m') AS cycle FROM c LEFT JOIN k ON c.l_suppkey = k.l_suppkey AND c.month = k.month LEFT JOIN m ON c.month = m.month),
    z AS (SELECT DISTINCT month AS closed FROM u WHERE month >= DATE '2000-08-01'),
    again AS (SELECT l_suppkey, month, amount, kilos_entity, unit_cost, share, 'C' || strftime(closed + INTERVAL 1 MONTH, '%m') AS cycle FROM u JOIN z ON closed >= month WHERE month >= DATE '2000-08-01'),
    structure AS (SELECT * FROM u UNION ALL (SELECT * FROM again EXCEPT SELECT * FROM u WHERE month >= DATE '2000-08-01'))"""


@query("plan_cost_structure", f"WITH {_STRUCTURE} SELECT * FROM structure")
def plan_cost_structure(t: Tables):
    return _structure(t)


@query("plan_cost_structure_current", f"WITH {_STRUCTURE} SELECT * FROM structure WHERE month >= DATE '2001-07-01'")
def plan_cost_structure_current(t: Tables):
    return costing.current_structure(_structure(t), "month", AS_OF)


@query(
    "plan_layer_journal",
    """SELECT l_orderkey AS lot, l_linenumber, l_extendedprice, CAST(c AS DATE) AS capitalised_on FROM lineitem LEFT JOIN (SELECT o_orderkey, MAX(o_orderdate) AS c FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) ON l_orderkey = o_orderkey WHERE l_returnflag <> 'N'""",
)
def plan_layer_journal(t: Tables):
    lines = t.lineitem.select(F.col("l_orderkey").alias("lot"), "l_linenumber", "l_extendedprice", "l_returnflag")
    capitalised = t.orders.where(F.col("o_orderstatus") != "P").select(
        F.col("o_orderkey").alias("lot"), day("o_orderdate").alias("capitalised_on")
    )
    return costing.layer_journal(lines, capitalised, F.col("l_returnflag") != "N").drop("l_returnflag")


@query(
    "plan_commercial",
    f"""WITH p AS (SELECT l_partkey, strftime(l_shipdate, '%Y%m') AS m, {fx("SUM(l_extendedprice * l_quantity) / NULLIF(SUM(l_quantity), 0)")} AS price FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2),
    s AS (SELECT l_orderkey AS document, l_linenumber AS position, lineitem.l_partkey AS article, l_shipdate, strftime(l_shipdate, '%Y%m') AS month_id, l_returnflag, COALESCE(p.price, 0.0) AS price FROM lineitem LEFT JOIN p ON lineitem.l_partkey = p.l_partkey AND strftime(l_shipdate, '%Y%m') = p.m)
    SELECT document, position, article, month_id, CASE WHEN l_shipdate >= DATE '1998-07-01' THEN CASE WHEN l_returnflag = 'R' THEN 0 ELSE price END WHEN l_returnflag = 'A' THEN price * 2 ELSE price END AS price FROM s""",
)
def plan_commercial(t: Tables):
    month = F.date_format("l_shipdate", "yyyyMM")
    sales = t.lineitem.select(
        F.col("l_orderkey").alias("document"), F.col("l_linenumber").alias("position"), F.col("l_partkey").alias("article"),
        F.col("l_shipdate").alias("posted_on"), month.alias("month_id"), "l_returnflag", F.lit(0.0).alias("price"),
    )
    closed = t.lineitem.where(F.col("l_linestatus") == "F").withColumnRenamed("l_partkey", "article")
    prices = cost.weighted_period_price(closed, "article", "l_shipdate", "l_extendedprice", "l_quantity")
    flag, price = F.col("l_returnflag"), F.col("price")
    out = costing.commercial_plan(
        sales, dt.date(1998, 7, 1), {"price": [(flag == "A", price * 2)]}, {"price": [(flag == "R", F.lit(0.0))]}, prices
    )
    return out.select("document", "position", "article", "month_id", "price")


@query(
    "plan_production_detail",
    f"""WITH lists AS (SELECT l_returnflag AS house, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS categories FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
    c AS (SELECT p_type AS breed, p_size AS age, CASE WHEN p_size > 42 THEN 0 ELSE {fx("AVG(p_retailprice)")} END AS std FROM part GROUP BY 1, 2), last AS (SELECT breed, arg_max(std, age) AS v FROM c WHERE std <> 0 GROUP BY 1),
    k AS (SELECT breed, age, SUM(CASE WHEN age > 42 AND std = 0 THEN v ELSE std END) OVER (PARTITION BY breed ORDER BY age) AS s FROM c JOIN last USING (breed))
    SELECT l_orderkey AS lot, l_linenumber, COALESCE(s_suppkey, -1) AS supplier_sk, CASE WHEN o_orderkey IS NOT NULL THEN o_orderpriority ELSE l_returnflag END AS house, categories, p_type AS breed, p_size AS age, {fx("s")} AS std_so_far
    FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) ON l_suppkey = s_suppkey JOIN lists ON l_returnflag = lists.house
    LEFT JOIN k ON k.breed = p_type AND k.age = p_size LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT') ON l_orderkey = o_orderkey""",
)
def plan_production_detail(t: Tables):
    from farmledger.plans.dimensions import supplier_dimension

    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("breed"), F.col("p_size").alias("age"))
    readings = t.lineitem.join(part, "l_partkey").select(
        F.col("l_orderkey").alias("lot"), "l_linenumber", "l_suppkey", F.col("l_returnflag").alias("house"), "breed", "age"
    )
    lookups = [(supplier_dimension(t), {"l_suppkey": "s_suppkey"}, "supplier_sk", F.col("s_suppkey") == -999)]
    categories = readings.select("house", F.col("breed").alias("category"))
    std = F.when(F.col("p_size") > 42, F.lit(0.0)).otherwise(fixed(F.avg("p_retailprice")))
    curve = t.part.groupBy(F.col("p_type").alias("breed"), "p_size").agg(std.alias("std")).withColumnRenamed("p_size", "age")
    moved = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("lot"), F.col("o_orderpriority").alias("new_house")
    )
    out = costing.production_detail(readings, lookups, categories, curve, moved, 42)
    return out.select("lot", "l_linenumber", "supplier_sk", "house", "categories", "breed", "age", fixed("std_so_far").alias("std_so_far"))


@query(
    "plan_conformed_dimension",
    """WITH old AS (SELECT c_name, ROW_NUMBER() OVER (ORDER BY c_name) AS sk, lower(c_mktsegment) AS segment FROM customer WHERE c_acctbal >= 1000), src AS (SELECT c_name, c_mktsegment AS segment FROM customer WHERE c_acctbal < 5000),
    fresh AS (SELECT c_name, (SELECT MAX(sk) FROM old) + ROW_NUMBER() OVER (ORDER BY c_name) AS sk FROM src WHERE c_name NOT IN (SELECT c_name FROM old))
    SELECT c_name, sk, segment FROM src JOIN (SELECT c_name, sk FROM old UNION ALL SELECT * FROM fresh) USING (c_name) UNION ALL SELECT c_name, sk, segment FROM old WHERE c_name NOT IN (SELECT c_name FROM src)""",
)
def plan_conformed_dimension(t: Tables):
    old = t.customer.where(F.col("c_acctbal") >= 1000).select("c_name", F.lower("c_mktsegment").alias("segment"))
    published = dims.assign_sk(old, ["c_name"], "sk").select("c_name", "sk", "segment")
    source = t.customer.where(F.col("c_acctbal") < 5000).select("c_name", F.col("c_mktsegment").alias("segment"))
    return costing.conformed_dimension(published, source, ["c_name"], "sk")


@query(
    "replace_months_roundtrip",
    """SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y%m') AS month FROM orders WHERE NOT (o_orderdate >= DATE '2001-04-01' AND o_orderdate < DATE '2001-07-01')
    UNION ALL SELECT o_orderkey, o_totalprice * 2, strftime(o_orderdate, '%Y%m') FROM orders WHERE o_orderdate >= DATE '2001-04-01' AND o_orderdate < DATE '2001-07-01' AND o_orderstatus = 'F'""",
)
def replace_months_roundtrip(t: Tables):
    name, root = f"farmledger_{uuid.uuid4().hex}", scratch_path(t.spark, "months")
    month = F.date_format("o_orderdate", "yyyyMM").alias("month")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus", month)
    rows.repartition("month").write.partitionBy("month").option("path", f"{root}/first").saveAsTable(name)
    source = t.orders.where(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    replace_months(t.spark, name, source, "o_orderdate", dt.date(2001, 4, 1), dt.date(2001, 6, 1), root)
    return detached(t.spark, name).select("o_orderkey", "o_totalprice", month)


@query(
    "plan_commercial_measures",
    f"""WITH m AS (SELECT * FROM lineitem WHERE date_trunc('month', l_shipdate) = (SELECT date_trunc('month', MAX(l_shipdate)) FROM lineitem WHERE l_linestatus = 'F') AND l_linestatus = 'F'),
    e AS (SELECT * FROM lineitem WHERE date_trunc('month', l_shipdate) = (SELECT date_trunc('month', MAX(l_shipdate)) FROM lineitem WHERE l_returnflag = 'R') AND l_returnflag = 'R')
    SELECT 'sales' AS obs, l_suppkey, {fx("SUM(l_extendedprice)", 2)} AS amount, SUM(l_quantity) AS quantity, CAST(NULL AS DOUBLE) AS per_unit, CAST(NULL AS DOUBLE) AS heads FROM m GROUP BY 2
    UNION ALL SELECT 'expense', l_suppkey, NULL, NULL, COALESCE({fx("SUM(l_extendedprice) / NULLIF(SUM(l_quantity), 0)")}, 0), NULL FROM e GROUP BY 2
    UNION ALL SELECT 'stock', l_suppkey, NULL, NULL, NULL, SUM(l_quantity) FROM lineitem GROUP BY 2""",
)
def plan_commercial_measures(t: Tables):
    lines = t.lineitem.select(
        "l_suppkey", day("l_shipdate").alias("closed_on"), F.col("l_extendedprice").alias("amount"), F.col("l_quantity").alias("quantity"),
        F.col("l_quantity").alias("heads"), "l_linestatus", "l_returnflag",
    )
    return costing.commercial_measures(lines, F.col("l_linestatus") == "F", F.col("l_returnflag") == "R", "closed_on", ["l_suppkey"])
