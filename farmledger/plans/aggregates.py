"""Queries over aggregations and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from farmledger.functions import fixed, safe_pct, wavg, wavg_date, wavg_nonzero
from farmledger.operators import agg as A
from farmledger.operators import dims
from farmledger.plans.dimensions import supplier_dimension
from farmledger.plans.registry import query
from farmledger.plans.standins import FARM_LINES, day, farm_lines, fx
from farmledger.sources.tables import Tables


def _sum2(c):
    return F.round(F.sum(c), 2)


_FLAG_LINES = f"""lines AS (SELECT f.*, COALESCE(s.s_suppkey, -1) AS supplier_sk FROM {FARM_LINES} f
    LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) s ON f.l_suppkey = s.s_suppkey)"""


@query(
    "flagship",
    f"""WITH {_FLAG_LINES},
    lot AS (SELECT zone, farm, l_orderkey, SUM(l_quantity) AS q, SUM(l_quantity * l_discount) AS qd,
      SUM(CASE WHEN supplier_sk = -1 THEN l_quantity ELSE 0 END) AS unknown_q FROM lines GROUP BY 1, 2, 3),
    f AS (SELECT zone, farm, SUM(q) AS q, SUM(qd) AS qd FROM lot GROUP BY 1, 2),
    z AS (SELECT zone, SUM(q) AS q, SUM(qd) AS qd FROM f GROUP BY 1)
    SELECT lot.zone, lot.farm, lot.l_orderkey AS lot, ROUND(lot.q, 2) AS quantity,
      COALESCE({fx("lot.qd / NULLIF(lot.q, 0)")}, 0) AS discount_lot, COALESCE({fx("f.qd / NULLIF(f.q, 0)")}, 0) AS discount_farm,
      COALESCE({fx("z.qd / NULLIF(z.q, 0)")}, 0) AS discount_zone, COALESCE({fx("lot.q / NULLIF(z.q, 0) * 100", 6)}, 0) AS pct_of_zone,
      COALESCE({fx("lot.unknown_q / NULLIF(lot.q, 0) * 100", 6)}, 0) AS pct_unknown_supplier
    FROM lot JOIN f USING (zone, farm) JOIN z USING (zone)""",
)
def flagship(t: Tables):
    lines = dims.star_lookup(
        farm_lines(t), [(supplier_dimension(t), {"l_suppkey": "s_suppkey"}, "supplier_sk", F.col("s_suppkey") == -999)]
    )
    unknown = F.when(F.col("supplier_sk") == -1, F.col("l_quantity")).otherwise(F.lit(0.0))
    levels = A.rollup_chain(
        lines,
        [("lot", ["zone", "farm", "l_orderkey"]), ("farm", ["zone", "farm"]), ("zone", ["zone"])],
        {"q": "l_quantity", "qd": F.col("l_quantity") * F.col("l_discount"), "u": unknown},
        {"discount": F.coalesce(fixed(F.try_divide("qd", "q")), F.lit(0.0))},
    )
    farm = levels["farm"].select("zone", "farm", F.col("discount").alias("discount_farm"))
    zone = levels["zone"].select("zone", F.col("discount").alias("discount_zone"), F.col("q").alias("zone_q"))
    return levels["lot"].join(farm, ["zone", "farm"]).join(zone, "zone").select(
        "zone", "farm", F.col("l_orderkey").alias("lot"), F.round("q", 2).alias("quantity"),
        F.col("discount").alias("discount_lot"), "discount_farm", "discount_zone",
        safe_pct("q", "zone_q", 6).alias("pct_of_zone"), safe_pct("u", "q", 6).alias("pct_unknown_supplier"),
    )


@query(
    "agg_basic",
    f"""SELECT l_returnflag, l_linestatus, ROUND(SUM(l_quantity), 2) AS sum_qty, {fx("SUM(l_extendedprice * (1 - l_discount))", 2)} AS revenue,
    MIN(l_extendedprice) AS min_price, MAX(l_extendedprice) AS max_price, {fx("AVG(l_discount)", 6)} AS avg_discount, COUNT(*) AS n FROM lineitem GROUP BY 1, 2""",
)
def agg_basic(t: Tables):
    return A.agg(
        t.lineitem,
        ["l_returnflag", "l_linestatus"],
        sum_qty=_sum2("l_quantity"),
        revenue=fixed(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2),
        min_price=F.min("l_extendedprice"),
        max_price=F.max("l_extendedprice"),
        avg_discount=fixed(F.avg("l_discount"), 6),
        n=F.count(F.lit(1)),
    )


@query(
    "agg_computed_key",
    """SELECT strftime(l_shipdate, '%Y%m') AS month_id, upper(p_type) AS kind, ROUND(SUM(l_quantity), 2) AS qty
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def agg_computed_key(t: Tables):
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    keys = [F.date_format("l_shipdate", "yyyyMM").alias("month_id"), F.upper("p_type").alias("kind")]
    return A.agg(t.lineitem.join(part, "l_partkey"), keys, qty=_sum2("l_quantity"))


@query(
    "agg_count_distinct",
    """SELECT l_suppkey, COUNT(DISTINCT l_partkey) AS n_parts, COUNT(DISTINCT l_orderkey) AS n_orders, COUNT(*) AS n_lines FROM lineitem GROUP BY 1""",
)
def agg_count_distinct(t: Tables):
    return A.agg(
        t.lineitem, ["l_suppkey"],
        n_parts=F.count_distinct("l_partkey"), n_orders=F.count_distinct("l_orderkey"), n_lines=F.count(F.lit(1)),
    )


@query(
    "agg_string_list",
    """SELECT o_custkey, string_agg(p, '/' ORDER BY p) AS priorities FROM (SELECT DISTINCT o_custkey, o_orderpriority AS p FROM orders) GROUP BY 1""",
)
def agg_string_list(t: Tables):
    return A.agg_string_list(t.orders, ["o_custkey"], "o_orderpriority", "priorities", "/")


@query(
    "agg_two_level",
    """WITH d AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, MAX(l_quantity) AS top, SUM(l_extendedprice) AS amount FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey, strftime(d, '%Y%m') AS month_id, ROUND(SUM(top), 2) AS sum_of_daily_max, ROUND(MAX(amount), 2) AS best_day FROM d GROUP BY 1, 2""",
)
def agg_two_level(t: Tables):
    daily = t.lineitem.withColumn("d", day("l_shipdate"))
    return A.two_level_agg(
        daily, ["l_suppkey", "d"], {"top": F.max("l_quantity"), "amount": F.sum("l_extendedprice")},
        ["l_suppkey", F.date_format("d", "yyyyMM").alias("month_id")],
        {"sum_of_daily_max": _sum2("top"), "best_day": F.round(F.max("amount"), 2)},
    )


@query(
    "weighted_avg",
    f"""SELECT l_partkey, {fx("SUM(l_discount * l_quantity) / NULLIF(SUM(l_quantity), 0)")} AS wavg_discount FROM lineitem GROUP BY 1""",
)
def weighted_avg(t: Tables):
    return A.agg(t.lineitem, ["l_partkey"], wavg_discount=fixed(wavg("l_discount", "l_quantity")))


@query(
    "weighted_avg_nonzero",
    f"""SELECT l_partkey, {fx("SUM(l_discount * l_quantity) / NULLIF(SUM(CASE WHEN l_discount <> 0 THEN l_quantity END), 0)")} AS wavg_discount FROM lineitem GROUP BY 1""",
)
def weighted_avg_nonzero(t: Tables):
    return A.agg(t.lineitem, ["l_partkey"], wavg_discount=fixed(wavg_nonzero("l_discount", "l_quantity")))


@query(
    "weighted_avg_levels",
    f"""WITH f AS {FARM_LINES}, p AS (SELECT zone, farm, l_orderkey, SUM(l_discount * l_quantity) AS x, SUM(l_quantity) AS w FROM f GROUP BY 1, 2, 3)
    SELECT zone, farm, l_orderkey, {fx("x / w")} AS lot_level,
    {fx("SUM(x) OVER (PARTITION BY zone, farm) / SUM(w) OVER (PARTITION BY zone, farm)")} AS farm_level,
    {fx("SUM(x) OVER (PARTITION BY zone) / SUM(w) OVER (PARTITION BY zone)")} AS zone_level FROM p""",
)
def weighted_avg_levels(t: Tables):
    levels = {"lot_level": ["zone", "farm", "l_orderkey"], "farm_level": ["zone", "farm"], "zone_level": ["zone"]}
    return A.rollup_levels(farm_lines(t), levels, "l_discount", "l_quantity")


@query(
    "weighted_avg_date",
    """SELECT l_suppkey, DATE '1900-01-01' + CAST(floor(SUM(date_diff('day', DATE '1900-01-01', CAST(l_shipdate AS DATE)) * l_quantity) / SUM(l_quantity)) AS INTEGER) AS mean_day
    FROM lineitem GROUP BY 1""",
)
def weighted_avg_date(t: Tables):
    return A.agg(t.lineitem, ["l_suppkey"], mean_day=wavg_date("l_shipdate", "l_quantity"))


@query(
    "dominant_category",
    f"""WITH c AS (SELECT l_suppkey, p_type, SUM(l_quantity) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
    r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY q DESC, p_type) AS rn, SUM(q) OVER (PARTITION BY l_suppkey) AS total FROM c)
    SELECT l_suppkey, p_type, {fx("q / total")} AS share FROM r WHERE rn = 1""",
)
def dominant_category(t: Tables):
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return A.dominant(t.lineitem.join(part, "l_partkey"), ["l_suppkey"], "p_type", "l_quantity")


@query(
    "share_by_predicate",
    f"""SELECT l_suppkey, COALESCE({fx("SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity END) / SUM(l_quantity)")}, 0) AS returned,
    COALESCE({fx("SUM(CASE WHEN l_discount <= 0.02 THEN l_quantity END) / SUM(l_quantity)")}, 0) AS light_discount FROM lineitem GROUP BY 1""",
)
def share_by_predicate(t: Tables):
    preds = {"returned": F.col("l_returnflag") == "R", "light_discount": F.col("l_discount") <= 0.02}
    return A.share(t.lineitem, ["l_suppkey"], preds, "l_quantity")


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def latest_per_key(t: Tables):
    return A.latest(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"])


@query(
    "date_span",
    """SELECT l_orderkey, CAST(MIN(l_shipdate) AS DATE) AS first_date, CAST(MAX(l_shipdate) AS DATE) AS last_date FROM lineitem GROUP BY 1""",
)
def date_span(t: Tables):
    return A.span(t.lineitem, ["l_orderkey"], "l_shipdate")


_CHAIN_LEVELS = [
    ("pen", ["zone", "farm", "l_orderkey", "l_linenumber"]),
    ("lot", ["zone", "farm", "l_orderkey"]),
    ("farm", ["zone", "farm"]),
    ("zone", ["zone"]),
]


@query(
    "rollup_chain",
    f"""WITH f AS {FARM_LINES}
    SELECT CASE grouping_id(farm, l_orderkey, l_linenumber) WHEN 0 THEN 'pen' WHEN 1 THEN 'lot' WHEN 3 THEN 'farm' ELSE 'zone' END AS level,
    zone, farm, l_orderkey, l_linenumber, ROUND(SUM(l_quantity), 2) AS qty, ROUND(SUM(l_extendedprice), 2) AS amount,
    COALESCE({fx("SUM(l_extendedprice) / NULLIF(SUM(l_quantity), 0)")}, 0) AS price
    FROM f GROUP BY GROUPING SETS ((zone, farm, l_orderkey, l_linenumber), (zone, farm, l_orderkey), (zone, farm), (zone))""",
)
def rollup_chain(t: Tables):
    from farmledger.operators.setops import union_all

    levels = A.rollup_chain(
        farm_lines(t), _CHAIN_LEVELS, {"qty": "l_quantity", "amount": "l_extendedprice"},
        {"price": F.coalesce(fixed(F.try_divide("amount", "qty")), F.lit(0.0))},
    )
    tagged = [df.withColumn("level", F.lit(name)) for name, df in levels.items()]
    return union_all(*tagged, fill_missing=True).select(
        "level", "zone", "farm", "l_orderkey", "l_linenumber",
        F.round("qty", 2).alias("qty"), F.round("amount", 2).alias("amount"), "price",
    )


_TWIN = "ROUND(SUM(l_quantity), 2) AS qty, COUNT(*) AS n"


@query(
    "rollup_excluding_outliers",
    f"""WITH a AS (SELECT l_orderkey, l_suppkey, {_TWIN} FROM lineitem GROUP BY 1, 2),
    b AS (SELECT l_orderkey, l_suppkey, {_TWIN} FROM lineitem WHERE l_quantity < 45 GROUP BY 1, 2)
    SELECT * FROM a UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def rollup_excluding_outliers(t: Tables):
    return A.with_and_without(
        t.lineitem, F.col("l_quantity") < 45, ["l_orderkey", "l_suppkey"],
        {"qty": _sum2("l_quantity"), "n": F.count(F.lit(1))},
    )


@query(
    "rollup_excluding_outliers_tagged",
    f"""SELECT l_suppkey, {_TWIN}, CAST(2 AS INTEGER) AS scope FROM lineitem GROUP BY 1
    UNION ALL SELECT l_suppkey, {_TWIN}, 1 FROM lineitem WHERE l_quantity < 45 GROUP BY 1""",
)
def rollup_excluding_outliers_tagged(t: Tables):
    return A.with_and_without(
        t.lineitem, F.col("l_quantity") < 45, ["l_suppkey"],
        {"qty": _sum2("l_quantity"), "n": F.count(F.lit(1))}, tag="scope",
    )


@query(
    "agg_bands",
    """SELECT l_suppkey, ROUND(COALESCE(SUM(CASE WHEN p_size <= 7 THEN l_quantity END), 0), 2) AS first_week,
    ROUND(COALESCE(SUM(CASE WHEN p_size BETWEEN 8 AND 21 THEN l_quantity END), 0), 2) AS rest,
    ROUND(COALESCE(SUM(CASE WHEN p_size >= 22 THEN l_quantity END), 0), 2) AS cleaning FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def agg_bands(t: Tables):
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size")
    bands = {"first_week": (None, 7), "rest": (8, 21), "cleaning": (22, None)}
    out = A.band_sums(t.lineitem.join(part, "l_partkey"), ["l_suppkey"], "p_size", "l_quantity", bands)
    return out.select("l_suppkey", *[F.round(b, 2).alias(b) for b in bands])


@query(
    "fill_from_group_max",
    """SELECT p_partkey, p_brand, CASE WHEN p_size < 10 THEN MAX(p_retailprice) OVER (PARTITION BY p_brand) ELSE p_retailprice END AS p_retailprice,
    CASE WHEN p_size < 10 THEN MAX(p_size) OVER (PARTITION BY p_brand) ELSE p_size END AS p_size FROM part""",
)
def fill_from_group_max(t: Tables):
    parts = t.part.select("p_partkey", "p_brand", "p_retailprice", "p_size")
    return A.fill_from_group_max(parts, ["p_brand"], ["p_retailprice", "p_size"], F.col("p_size") < 10)


@query(
    "split_movements",
    """SELECT l_orderkey, COALESCE(SUM(CASE WHEN l_returnflag = 'R' THEN abs(q) END), 0) AS returned,
    COALESCE(SUM(CASE WHEN l_returnflag <> 'R' AND l_linestatus = 'O' THEN abs(q) END), 0) AS open_out,
    COALESCE(SUM(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN abs(q) END), 0) AS closed_out
    FROM (SELECT *, CASE WHEN l_linestatus = 'F' THEN -l_quantity ELSE l_quantity END AS q FROM lineitem) GROUP BY 1""",
)
def split_movements(t: Tables):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    signed = t.lineitem.withColumn("q", F.when(status == "F", -F.col("l_quantity")).otherwise(F.col("l_quantity")))
    rules = {
        "returned": flag == "R",
        "open_out": (flag != "R") & (status == "O"),
        "closed_out": (flag == "A") & (status == "F"),
    }
    return A.split_movements(signed, ["l_orderkey"], "q", rules)


@query(
    "detail_plus_summary",
    """WITH d AS (SELECT l_suppkey, l_returnflag, l_linestatus, SUM(l_quantity) AS qty FROM lineitem GROUP BY 1, 2, 3)
    SELECT 'detail' AS row_kind, l_suppkey, l_returnflag, l_linestatus, ROUND(qty, 2) AS qty FROM d
    UNION ALL SELECT 'summary', l_suppkey, '-', '-', ROUND(SUM(qty), 2) FROM d GROUP BY 2""",
)
def detail_plus_summary(t: Tables):
    out = A.detail_plus_summary(
        t.lineitem, ["l_suppkey", "l_returnflag", "l_linestatus"], ["l_suppkey"], {"qty": "l_quantity"}, "-"
    )
    return out.withColumn("qty", F.round("qty", 2))
