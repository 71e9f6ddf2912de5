"""Queries over filters, projections and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from farmledger.functions import fixed, from_year_start, like_label, rolling_months
from farmledger.operators import filters, joins
from farmledger.operators.setops import union_all
from farmledger.plans.registry import query
from farmledger.plans.standins import AS_OF, DAILY_READINGS, daily_readings, day, fx
from farmledger.sources.tables import Tables


@query(
    "ledger_filter",
    """SELECT o_orderkey, o_orderpriority, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')
    AND o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW') AND o_totalprice BETWEEN 100000 AND 300000
    AND (starts_with(o_orderpriority, '1-') OR starts_with(o_orderpriority, '2-') OR o_orderpriority >= '3')""",
)
def ledger_filter(t: Tables):
    priority = F.col("o_orderpriority")
    return filters.where(
        t.orders,
        F.col("o_orderstatus").isin("F", "O"),
        ~priority.isin("4-NOT SPECIFIED", "5-LOW"),
        F.col("o_totalprice").between(100000, 300000),
        priority.startswith("1-") | priority.startswith("2-") | (priority >= "3"),
    ).select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")


@query(
    "like_label",
    """SELECT c_custkey, CASE WHEN c_mktsegment LIKE 'AUTO%' THEN 'Vehiculos' WHEN c_mktsegment LIKE '%HOLD' THEN 'Hogar'
    WHEN c_mktsegment LIKE '%U%' THEN 'Otros' ELSE 'Sin rubro' END AS channel FROM customer WHERE c_name NOT LIKE '%99'""",
)
def like_label_query(t: Tables):
    rules = [("AUTO%", "Vehiculos"), ("%HOLD", "Hogar"), ("%U%", "Otros")]
    return t.customer.where(~F.col("c_name").like("%99")).select(
        "c_custkey", like_label("c_mktsegment", rules, "Sin rubro").alias("channel")
    )


@query(
    "project_wide",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
    l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS ship_day FROM lineitem""",
)
def project_wide(t: Tables):
    kept = [c for c in t.lineitem.columns if c != "l_shipdate"]
    return t.lineitem.select(*kept, day("l_shipdate").alias("ship_day"))


@query(
    "rolling_months_filter",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate >= DATE '2000-11-01'",
)
def rolling_months_filter(t: Tables):
    return t.lineitem.where(rolling_months("l_shipdate", AS_OF, 9)).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "year_start_filter",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= DATE '2000-01-01'",
)
def year_start_filter(t: Tables):
    return t.orders.where(from_year_start("o_orderdate", AS_OF, 12)).select("o_orderkey", "o_totalprice")


@query(
    "in_subquery",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def in_subquery(t: Tables):
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderkey").alias("l_orderkey"))
    return filters.semi(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), urgent, ["l_orderkey"])


@query(
    "not_in_subquery",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""",
)
def not_in_subquery(t: Tables):
    busy = t.orders.where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return filters.anti(t.customer.select("c_custkey", "c_name"), busy, "c_custkey")


@query(
    "split_actual_plan",
    """SELECT 'actual' AS version, l_orderkey, l_linenumber, p_brand, l_extendedprice FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE l_linestatus = 'F' UNION ALL
    SELECT 'plan', l_orderkey, l_linenumber, p_brand, l_extendedprice FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'O'""",
)
def split_actual_plan(t: Tables):
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    joined = t.lineitem.join(part, "l_partkey")
    cols = ["l_orderkey", "l_linenumber", "p_brand", "l_extendedprice"]
    actual, plan = filters.split_by(joined, "l_linestatus", ["F", "O"])
    return union_all(
        actual.select(F.lit("actual").alias("version"), *cols), plan.select(F.lit("plan").alias("version"), *cols)
    )


@query(
    "keep_max_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders o
    WHERE o_totalprice = (SELECT MAX(o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)""",
)
def keep_max_per_key(t: Tables):
    return filters.keep_max(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_totalprice").select(
        "o_custkey", "o_orderkey", "o_totalprice"
    )


@query(
    "limit_ordered",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)
def limit_ordered(t: Tables):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return filters.first_n(rows, [F.col("o_totalprice").desc(), "o_orderkey"], 25)


@query(
    "first_per_key",
    """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS placed, o_totalprice FROM (SELECT *, ROW_NUMBER() OVER
    (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def first_per_key(t: Tables):
    lots = t.orders.select("o_custkey", "o_orderkey", day("o_orderdate").alias("placed"), "o_totalprice")
    return filters.first_per_key(lots, ["o_custkey"], ["placed", "o_orderkey"])


@query(
    "zero_blank",
    """WITH x AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '  ' WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS code FROM orders)
    SELECT o_orderkey, COALESCE(NULLIF(TRIM(code), ''), '0') AS code FROM x""",
)
def zero_blank(t: Tables):
    code = (
        F.when(F.col("o_orderstatus") == "P", "  ")
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    return filters.zero_blank(t.orders.select("o_orderkey", code.alias("code")), ["code"])


@query(
    "cast_decimal",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(20, 5)) AS DOUBLE) AS amount,
    CAST(NULL AS DOUBLE) AS bad FROM lineitem""",
)
def cast_decimal(t: Tables):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("amount"), F.concat("l_returnflag", "l_linestatus").alias("bad")
    )
    out = filters.cast_decimal(rows, ["amount", "bad"], 20, 5)
    return out.withColumns({"amount": F.col("amount").cast("double"), "bad": F.col("bad").cast("double")})


@query(
    "join_inner",
    """SELECT l_orderkey, l_linenumber, o_custkey, o_orderpriority, l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def join_inner(t: Tables):
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity").join(orders, "l_orderkey")


@query(
    "join_composite_key",
    """WITH s AS (SELECT l_partkey, l_suppkey, ROUND(SUM(l_quantity), 2) AS supplied FROM lineitem GROUP BY 1, 2)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, supplied FROM lineitem JOIN s USING (l_partkey, l_suppkey)""",
)
def join_composite_key(t: Tables):
    key = ["l_partkey", "l_suppkey"]
    supplied = t.lineitem.groupBy(*key).agg(F.round(F.sum("l_quantity"), 2).alias("supplied"))
    return t.lineitem.select("l_orderkey", "l_linenumber", *key).join(supplied, key)


@query(
    "join_left_chain",
    """SELECT o_orderkey, c_name, n_name, r_name FROM orders
    LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON n_regionkey = r_regionkey""",
)
def join_left_chain(t: Tables):
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    customer = t.customer.where(F.col("c_acctbal") >= 0).select("c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey"))
    nation = t.nation.select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    region = t.region.where(F.col("r_name") != "ASIA")
    chained = joins.left_chain(
        orders, [(customer, ["c_custkey"]), (nation, ["n_nationkey"]), (region, ["r_regionkey"])]
    )
    return chained.select("o_orderkey", "c_name", "n_name", "r_name")


@query(
    "join_anti",
    """SELECT p_partkey, p_brand FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 50 AND l_returnflag = 'R')""",
)
def join_anti(t: Tables):
    moved = t.lineitem.where((F.col("l_quantity") >= 50) & (F.col("l_returnflag") == "R"))
    return t.part.select("p_partkey", "p_brand").join(moved.select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_anti")


@query(
    "join_semi",
    """SELECT s_suppkey, s_name FROM supplier WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_discount = 0 AND l_quantity > 45)""",
)
def join_semi(t: Tables):
    sold = t.lineitem.where((F.col("l_discount") == 0) & (F.col("l_quantity") > 45)).select(F.col("l_suppkey").alias("s_suppkey"))
    return filters.semi(t.supplier.select("s_suppkey", "s_name"), sold, ["s_suppkey"])


@query(
    "join_scalar",
    """SELECT o_orderkey, o_totalprice, m.month_total, m.yesterday_total, m.week_total FROM orders CROSS JOIN (SELECT
      ROUND(SUM(CASE WHEN o_orderdate >= DATE '2001-08-01' THEN o_totalprice END), 2) AS month_total,
      ROUND(SUM(CASE WHEN CAST(o_orderdate AS DATE) = DATE '2001-07-31' THEN o_totalprice END), 2) AS yesterday_total,
      ROUND(SUM(CASE WHEN o_orderdate >= DATE '2001-07-25' AND o_orderdate < DATE '2001-08-01' THEN o_totalprice END), 2) AS week_total FROM orders) m""",
)
def join_scalar(t: Tables):
    placed, as_of = day("o_orderdate"), F.lit(AS_OF)

    def total(cond):
        return F.round(F.sum(F.when(cond, F.col("o_totalprice"))), 2)

    sums = t.orders.agg(
        total(placed >= F.trunc(as_of, "month")).alias("month_total"),
        total(placed == F.date_sub(as_of, 1)).alias("yesterday_total"),
        total((placed >= F.date_sub(as_of, 7)) & (placed < as_of)).alias("week_total"),
    )
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return joins.with_scalar(rows, sums, ["month_total", "yesterday_total", "week_total"])


@query(
    "triangular_rewrite",
    f"""WITH d AS {DAILY_READINGS} SELECT a.user_id, a.day, a.reading, MAX(b.reading) AS best_so_far,
    ROUND(SUM(b.reading), 2) AS total_so_far FROM d a JOIN d b ON a.user_id = b.user_id AND b.day <= a.day GROUP BY 1, 2, 3""",
)
def triangular_rewrite(t: Tables):
    from farmledger.operators.ordered import cumulate

    run = cumulate(
        daily_readings(t), ["user_id"], ["day"], [],
        {"best_so_far": ("max", "reading"), "total_so_far": ("sum", "reading")},
    )
    return run.select("user_id", "day", "reading", "best_so_far", F.round("total_so_far", 2).alias("total_so_far"))


@query(
    "lookahead_range_max",
    f"""WITH d AS {DAILY_READINGS} SELECT user_id, day, reading, MAX(reading) OVER (PARTITION BY user_id ORDER BY day
    RANGE BETWEEN CURRENT ROW AND 2 FOLLOWING) AS best_ahead FROM d""",
)
def lookahead_range_max(t: Tables):
    return joins.lookahead_max(daily_readings(t).drop("n_events"), ["user_id"], "day", "reading", 2, "best_ahead")


@query(
    "asof_max",
    """WITH r AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS d, MAX(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
    l AS (SELECT o_orderkey, o_custkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'O')
    SELECT l.o_orderkey, l.k AS farm, l.d AS day, COALESCE((SELECT MAX(v) FROM r WHERE r.k = l.k AND r.d <= l.d), 0.0) AS best FROM l""",
)
def asof_max(t: Tables):
    rows = t.orders.select("o_orderkey", F.col("o_custkey").alias("farm"), day("o_orderdate").alias("day"), "o_orderstatus", "o_totalprice")
    left = rows.where(F.col("o_orderstatus") == "O").select("o_orderkey", "farm", "day")
    right = rows.where(F.col("o_orderstatus") == "F").select("farm", "day", "o_totalprice")
    return joins.asof_max(left, right, ["farm"], "day", {"best": "o_totalprice"})


@query(
    "interval_join",
    """WITH s AS (SELECT o_custkey, o_orderkey, o_orderdate AS lo, o_orderdate + INTERVAL 45 DAY AS hi FROM orders),
    e AS (SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_shipdate, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
    SELECT e.o_custkey, e.l_orderkey, e.l_linenumber, e.l_quantity, s.o_orderkey AS lot FROM e JOIN s ON e.o_custkey = s.o_custkey AND e.l_shipdate BETWEEN s.lo AND s.hi""",
)
def interval_join(t: Tables):
    owner = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    events = (
        t.lineitem.join(owner, "l_orderkey")
        .select("o_custkey", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    )
    spans = t.orders.select(
        "o_custkey", F.col("o_orderkey").alias("lot"), F.col("o_orderdate").alias("lo"),
        (F.col("o_orderdate") + F.expr("interval 45 days")).alias("hi"),
    )
    return joins.interval_join(events, spans, ["o_custkey"], "l_shipdate", "lo", "hi").drop("l_shipdate", "lo", "hi")


@query(
    "join_theta_residual",
    """SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND l_shipdate <= o_orderdate""",
)
def join_theta_residual(t: Tables):
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_custkey")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    out = joins.join_where(lines, orders, ["l_orderkey"], F.col("a.l_shipdate") <= F.col("b.o_orderdate"), "left")
    return out.select("l_orderkey", "l_linenumber", "o_custkey")


@query(
    "lag_join",
    f"""WITH d AS {DAILY_READINGS} SELECT a.user_id, a.day, a.reading, a.n_events, b.reading AS reading_before FROM d a
    LEFT JOIN d b ON a.user_id = b.user_id AND a.day = b.day + 1""",
)
def lag_join(t: Tables):
    return joins.lag_join(daily_readings(t), ["user_id"], "day", {"reading_before": "reading"})


@query(
    "join_normalised_keys",
    """SELECT p_partkey, p_type, g.n_parts FROM part LEFT JOIN (SELECT p_type AS k, COUNT(*) AS n_parts FROM part GROUP BY 1) g ON upper(trim(p_type)) = upper(trim(g.k))""",
)
def join_normalised_keys(t: Tables):
    parts = t.part.select("p_partkey", "p_type")
    sizes = parts.groupBy(F.concat(F.lit(" "), F.lower("p_type"), F.lit(" ")).alias("p_type")).agg(F.count(F.lit(1)).alias("n_parts"))
    return joins.join_norm(parts, sizes, ["p_type"])


_TRANSFERS = """transfers AS (SELECT o_orderkey AS src, o_orderkey + 1 AS dst, o_custkey AS house FROM orders WHERE o_orderpriority = '1-URGENT')"""


def _transfers(t: Tables):
    return t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("src"), (F.col("o_orderkey") + 1).alias("dst"), F.col("o_custkey").alias("house")
    )


@query(
    "either_side_lookup",
    f"""WITH {_TRANSFERS} SELECT l_orderkey, l_linenumber, COALESCE(s.house, d.house) AS house, CASE WHEN COALESCE(s.house, d.house) IS NULL THEN 0 ELSE 1 END AS moved
    FROM lineitem LEFT JOIN transfers s ON l_orderkey = s.src LEFT JOIN transfers d ON l_orderkey = d.dst""",
)
def either_side_lookup(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber")
    return joins.either_side(lines, _transfers(t), "l_orderkey", "src", "dst", "house", "house", "moved")


@query(
    "reattribute_transfer",
    """WITH m AS (SELECT o_orderkey, o_custkey AS new_farm, o_orderpriority AS new_zone FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT l_orderkey, l_linenumber, CASE WHEN m.o_orderkey IS NOT NULL THEN m.new_farm ELSE l_suppkey END AS farm,
    CASE WHEN m.o_orderkey IS NOT NULL THEN m.new_zone ELSE l_returnflag END AS zone FROM lineitem LEFT JOIN m ON l_orderkey = m.o_orderkey""",
)
def reattribute_transfer(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("farm"), F.col("l_returnflag").alias("zone"))
    moved = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("new_farm"), F.col("o_orderpriority").alias("new_zone")
    )
    return joins.reattribute(lines, moved, "l_orderkey", {"farm": "new_farm", "zone": "new_zone"})


@query(
    "lookup_by_level",
    """SELECT l_orderkey, l_linenumber, l_returnflag AS level, CASE l_returnflag WHEN 'A' THEN CAST(o_totalprice AS DOUBLE) WHEN 'N' THEN s_acctbal
    WHEN 'R' THEN p_retailprice END AS measure FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""",
)
def lookup_by_level(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.col("l_returnflag").alias("level"))
    dims = {
        "A": (t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").alias("v")), "l_orderkey"),
        "N": (t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_acctbal").alias("v")), "l_suppkey"),
        "R": (t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").alias("v")), "l_partkey"),
    }
    return joins.lookup_by_level(lines, "level", dims, "v", "measure").drop("l_suppkey", "l_partkey")


@query(
    "std_curve_lookup",
    f"""WITH std AS (SELECT p_size AS std_age, p_type AS breed, {fx("AVG(p_retailprice)")} AS standard FROM part GROUP BY 1, 2)
    SELECT l_orderkey, l_linenumber, p_type AS breed, CAST(ceil(l_quantity * 1.02) AS INTEGER) AS std_age, standard
    FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN std ON std.breed = p_type AND std.std_age = ceil(l_quantity * 1.02)""",
)
def std_curve_lookup(t: Tables):
    std = t.part.groupBy(F.col("p_size").alias("std_age"), F.col("p_type").alias("breed")).agg(
        fixed(F.avg("p_retailprice")).alias("standard")
    )
    breed = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("breed"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").join(breed, "l_partkey")
    out = joins.std_lookup(lines, std, ["breed"], F.col("l_quantity") * 1.02, "std_age")
    return out.select("l_orderkey", "l_linenumber", "breed", "std_age", "standard")


@query(
    "push_parent_to_child",
    """SELECT l_orderkey, l_linenumber, top_price, last_order FROM lineitem JOIN (SELECT o_orderkey, o_custkey FROM orders) ON l_orderkey = o_orderkey
    LEFT JOIN (SELECT o_custkey AS k, MAX(o_totalprice) AS top_price, MAX(o_orderkey) AS last_order FROM orders GROUP BY 1) ON o_custkey = k""",
)
def push_parent_to_child(t: Tables):
    owner = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = t.lineitem.select("l_orderkey", "l_linenumber").join(owner, "l_orderkey")
    parents = t.orders.select("o_custkey", F.col("o_totalprice").alias("top_price"), F.col("o_orderkey").alias("last_order"))
    return joins.push_down(lines, parents, ["o_custkey"], ["top_price", "last_order"]).drop("o_custkey")


@query(
    "join_salted",
    """SELECT l_orderkey, l_linenumber, l_suppkey, s_name FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) ON l_suppkey = s_suppkey""",
)
def join_salted(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    supplier = t.supplier.where(F.col("s_acctbal") >= 0).select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return joins.salted_join(lines, supplier, ["l_suppkey"], ["l_orderkey", "l_linenumber"], 8)
