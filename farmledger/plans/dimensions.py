"""Queries over dimensions, surrogate keys and key derivation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from farmledger.functions import age_days, age_week_decimal, entity_code, like_label, parent_key, week_of_life
from farmledger.operators import dims
from farmledger.plans.registry import query
from farmledger.plans.standins import day
from farmledger.sources.tables import Tables


@query(
    "dim_build_default_member",
    """SELECT DISTINCT p_brand, p_type FROM part UNION SELECT 'Sin marca', 'Sin tipo'""",
)
def dim_build_default_member(t: Tables):
    return dims.build_dimension(t.part, ["p_brand", "p_type"], {"p_brand": "Sin marca", "p_type": "Sin tipo"})


@query(
    "dim_surrogate_key",
    """SELECT c_name, c_mktsegment, ROW_NUMBER() OVER (ORDER BY c_name, c_mktsegment) AS sk
    FROM (SELECT DISTINCT c_name, c_mktsegment FROM customer)""",
)
def dim_surrogate_key(t: Tables):
    return dims.assign_sk(t.customer.select("c_name", "c_mktsegment").distinct(), ["c_name", "c_mktsegment"], "sk")


@query(
    "dim_extend_surrogate_key",
    """WITH old AS (SELECT c_name, ROW_NUMBER() OVER (ORDER BY c_name) AS sk FROM customer WHERE c_acctbal >= 0),
    fresh AS (SELECT c_name FROM customer WHERE c_name NOT IN (SELECT c_name FROM old))
    SELECT c_name, sk FROM old UNION ALL
    SELECT c_name, (SELECT MAX(sk) FROM old) + ROW_NUMBER() OVER (ORDER BY c_name) FROM fresh""",
)
def dim_extend_surrogate_key(t: Tables):
    old = dims.assign_sk(t.customer.where(F.col("c_acctbal") >= 0).select("c_name"), ["c_name"], "sk")
    return dims.extend_sk(old, t.customer.select("c_name"), ["c_name"], "sk")


def supplier_dimension(t: Tables):
    """Suppliers in credit and a default member with key -1."""
    known = t.supplier.where(F.col("s_acctbal") >= 0).select("s_suppkey", F.col("s_suppkey").alias("supplier_sk"))
    return dims.build_dimension(known, ["s_suppkey", "supplier_sk"], {"s_suppkey": -999, "supplier_sk": -1})


def part_dimension(t: Tables):
    """Parts listed at 1000 or more and a default member with key -2."""
    known = t.part.where(F.col("p_retailprice") >= 1000).select("p_partkey", F.col("p_partkey").alias("part_sk"))
    return dims.build_dimension(known, ["p_partkey", "part_sk"], {"p_partkey": -999, "part_sk": -2})


STAR = """SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, COALESCE(s.s_suppkey, -1) AS supplier_sk, COALESCE(p.p_partkey, -2) AS part_sk
FROM lineitem l LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) s ON l.l_suppkey = s.s_suppkey
LEFT JOIN (SELECT * FROM part WHERE p_retailprice >= 1000) p ON l.l_partkey = p.p_partkey"""


@query("star_lookup_default", STAR)
def star_lookup_default(t: Tables):
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey", "l_partkey")
    out = dims.star_lookup(
        fact,
        [
            (supplier_dimension(t), {"l_suppkey": "s_suppkey"}, "supplier_sk", F.col("s_suppkey") == -999),
            (part_dimension(t), {"l_partkey": "p_partkey"}, "part_sk", F.col("p_partkey") == -999),
        ],
    )
    return out.drop("l_suppkey", "l_partkey")


@query(
    "dim_merge_source_wins",
    """WITH src AS (SELECT c_custkey, upper(c_mktsegment) || '*' AS c_mktsegment FROM customer WHERE c_acctbal < 5000)
    SELECT * FROM src UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM src)""",
)
def dim_merge_source_wins(t: Tables):
    target = t.customer.select("c_custkey", "c_mktsegment")
    source = t.customer.where(F.col("c_acctbal") < 5000).select(
        "c_custkey", F.concat(F.upper("c_mktsegment"), F.lit("*")).alias("c_mktsegment")
    )
    return dims.merge_dim(target, source, ["c_custkey"])


@query(
    "scd1_refresh",
    """SELECT s.s_suppkey, s.s_name, CASE WHEN s.s_nationkey < 10 AND f.k IS NOT NULL THEN f.total ELSE s.s_acctbal END AS s_acctbal
    FROM supplier s LEFT JOIN (SELECT l_suppkey AS k, ROUND(SUM(l_quantity), 2) AS total FROM lineitem GROUP BY 1) f ON s.s_suppkey = f.k""",
)
def scd1_refresh(t: Tables):
    fresh = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.round(F.sum("l_quantity"), 2).alias("s_acctbal"))
    out = dims.scd1_refresh(t.supplier, fresh, ["s_suppkey"], ["s_acctbal"], F.col("s_nationkey") < 10)
    return out.select("s_suppkey", "s_name", "s_acctbal")


@query(
    "enum_dimension",
    """WITH e(code, label) AS (VALUES ('F', 'Cerrado'), ('O', 'Abierto'), ('P', 'En proceso'), ('X', 'Sin estado'))
    SELECT e.code, e.label, COUNT(o.o_orderkey) AS n_orders FROM e LEFT JOIN orders o ON o.o_orderstatus = e.code GROUP BY 1, 2""",
)
def enum_dimension(t: Tables):
    states = dims.enum_dim(
        t.spark,
        [("F", "Cerrado"), ("O", "Abierto"), ("P", "En proceso"), ("X", "Sin estado")],
        "code string, label string",
    )
    used = t.orders.groupBy(F.col("o_orderstatus").alias("code")).agg(F.count("o_orderkey").alias("n_orders"))
    return states.join(used, "code", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


@query(
    "calendar_dim",
    """WITH d AS (SELECT CAST(UNNEST(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day
      FROM (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders))
    SELECT day, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS day_id, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
      strftime(day, '%Y%m') AS month_id, 'T' || quarter(day) AS quarter_label, 'W' || lpad(CAST(weekofyear(day) AS VARCHAR), 2, '0') AS week_label FROM d""",
)
def calendar_dim(t: Tables):
    return dims.calendar_of(t.orders, "o_orderdate")


@query(
    "age_dim",
    """WITH a AS (SELECT DISTINCT date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT CAST(d AS INTEGER) AS age_day, CASE WHEN d > 9 THEN 'D' || d ELSE 'D0' || d END AS age_code, 'Dia ' || d AS age_label,
      CASE WHEN d = 0 THEN 1 ELSE CAST(CEIL(d / 7.0) AS INTEGER) + 1 END AS age_week FROM a WHERE d >= 0""",
)
def age_dim(t: Tables):
    born = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return dims.age_dim(t.lineitem.join(born, "l_orderkey"), age_days("l_shipdate", "o_orderdate"))


@query(
    "priority_union",
    """WITH a AS (SELECT p_partkey AS code, 'promo' AS origin FROM part WHERE p_type = 'PROMO'),
    b AS (SELECT DISTINCT l_partkey AS code, 'returned' AS origin FROM lineitem WHERE l_returnflag = 'R' AND l_discount = 0),
    c AS (SELECT p_partkey AS code, 'listed' AS origin FROM part)
    SELECT * FROM a UNION ALL SELECT * FROM b WHERE code NOT IN (SELECT code FROM a)
    UNION ALL SELECT * FROM c WHERE code NOT IN (SELECT code FROM a) AND code NOT IN (SELECT code FROM b)""",
)
def priority_union(t: Tables):
    code = F.col("p_partkey").alias("code")
    promo = t.part.where(F.col("p_type") == "PROMO").select(code, F.lit("promo").alias("origin"))
    returned = (
        t.lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_discount") == 0))
        .select(F.col("l_partkey").alias("code")).distinct().withColumn("origin", F.lit("returned"))
    )
    listed = t.part.select(code, F.lit("listed").alias("origin"))
    return dims.priority_union([promo, returned, listed], ["code"])


@query(
    "code_rederivation",
    """SELECT p_partkey, replace(p_brand, 'Brand#', 'B') AS brand_code, substring(p_name, instr(p_name, ' ') + 1) AS product,
    CASE WHEN p_name LIKE '%ring%' THEN 'RING' WHEN p_name LIKE '%bolt' THEN 'BOLT' ELSE 'OTRO' END AS family FROM part""",
)
def code_rederivation(t: Tables):
    name = F.col("p_name")
    return t.part.select(
        "p_partkey",
        F.replace("p_brand", F.lit("Brand#"), F.lit("B")).alias("brand_code"),
        F.substring(name, F.instr(name, " ") + 1, F.length(name)).alias("product"),
        like_label(name, [("%ring%", "RING"), ("%bolt", "BOLT")], "OTRO").alias("family"),
    )


@query(
    "regroup_by_list",
    """SELECT p_partkey, p_type, CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'EMPACADO' WHEN p_type IN ('LARGE') THEN 'TROZADO' ELSE 'ENTERO' END AS product_group FROM part""",
)
def regroup_by_list(t: Tables):
    groups = {"EMPACADO": ["SMALL", "MEDIUM"], "TROZADO": ["LARGE"]}
    return dims.regroup(t.part, "p_type", groups, "ENTERO", "product_group").select("p_partkey", "p_type", "product_group")


@query(
    "repair_date",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders""",
)
def repair_date(t: Tables):
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd.MM")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    parts = (F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"))
    return t.orders.select("o_orderkey", dims.repair_date(text, *parts).alias("day"))


_PEN = "lpad(CAST(l_orderkey AS VARCHAR), 8, '0') || '-' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '-' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0')"


@query(
    "hierarchy_keys",
    f"""SELECT pen, substring(pen, 1, length(pen) - 3) AS house, substring(pen, 1, length(pen) - 6) AS lot, COUNT(*) AS n
    FROM (SELECT {_PEN} AS pen FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1, 2, 3""",
)
def hierarchy_keys(t: Tables):
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size")
    pen = F.concat_ws(
        "-",
        F.lpad(F.col("l_orderkey").cast("string"), 8, "0"),
        F.lpad(F.col("p_size").cast("string"), 2, "0"),
        F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
    )
    pens = t.lineitem.join(part, "l_partkey").groupBy(pen.alias("pen")).agg(F.count(F.lit(1)).alias("n"))
    return pens.select("pen", parent_key("pen", "house").alias("house"), parent_key("pen", "lot").alias("lot"), "n")


@query(
    "entity_code",
    "SELECT p_partkey, concat_ws('-', upper(rtrim(p_brand || '  ')), upper(rtrim(p_type)), CAST(p_size AS VARCHAR)) AS code FROM part",
)
def entity_code_query(t: Tables):
    return t.part.select("p_partkey", entity_code(F.concat("p_brand", F.lit("  ")), "p_type", "p_size").alias("code"))


@query(
    "age_days",
    """SELECT l_orderkey, l_linenumber, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE
      CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) END AS age
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def age_days_query(t: Tables):
    sentinel = dt.date(1899, 11, 30)
    born = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.when(F.col("o_orderstatus") == "P", F.lit(sentinel)).otherwise(day("o_orderdate")).alias("born"),
    )
    return t.lineitem.join(born, "l_orderkey").select("l_orderkey", "l_linenumber", age_days("l_shipdate", "born").alias("age"))


@query(
    "week_of_life",
    """WITH a AS (SELECT l_orderkey, l_linenumber, GREATEST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)), 0) AS d
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT l_orderkey, l_linenumber, CAST(floor((d + 6) / 7) AS INTEGER) AS week, ROUND(ROUND(d / 7, 0) + (d % 7) / 10, 1) AS age_weeks FROM a""",
)
def week_of_life_query(t: Tables):
    born = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    aged = t.lineitem.join(born, "l_orderkey").withColumn("d", F.greatest(age_days("l_shipdate", "o_orderdate"), F.lit(0)))
    return aged.select("l_orderkey", "l_linenumber", week_of_life("d").alias("week"), age_week_decimal("d").alias("age_weeks"))


@query(
    "campaign_gap",
    """WITH r AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS placed,
        DENSE_RANK() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE)) AS campaign FROM orders),
    c AS (SELECT o_custkey, campaign, MIN(placed) AS campaign_start, MAX(placed) AS campaign_end FROM r GROUP BY 1, 2)
    SELECT r.o_custkey, r.o_orderkey, r.placed, CAST(r.campaign AS INTEGER) AS campaign, c.campaign_start, c.campaign_end, p.campaign_end AS previous_end
    FROM r JOIN c USING (o_custkey, campaign) LEFT JOIN c p ON r.o_custkey = p.o_custkey AND p.campaign = r.campaign - 1""",
)
def campaign_gap(t: Tables):
    lots = t.orders.select("o_custkey", "o_orderkey", day("o_orderdate").alias("placed"))
    return dims.campaign_sequence(lots, ["o_custkey"], ["placed"], "placed", "placed")
