"""Queries over set operations and the scalar functions in use."""

from __future__ import annotations

from pyspark.sql import functions as F

from farmledger.operators import setops
from farmledger.plans.registry import query
from farmledger.plans.standins import day
from farmledger.sources.tables import Tables


@query(
    "union_all",
    """SELECT s_suppkey AS code, s_nationkey AS nation, s_acctbal AS balance FROM supplier UNION ALL SELECT c_custkey, c_nationkey, c_acctbal FROM customer""",
)
def union_all(t: Tables):
    a = t.supplier.select(F.col("s_suppkey").alias("code"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    b = t.customer.select(F.col("c_acctbal").alias("balance"), F.col("c_custkey").alias("code"), F.col("c_nationkey").alias("nation"))
    return setops.union_all(a, b)


@query("union_distinct", "SELECT l_partkey AS code, l_suppkey AS supplier FROM lineitem WHERE l_returnflag = 'R' UNION SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'O'")
def union_distinct(t: Tables):
    pairs = [F.col("l_partkey").alias("code"), F.col("l_suppkey").alias("supplier")]
    a = t.lineitem.where(F.col("l_returnflag") == "R").select(*pairs)
    b = t.lineitem.where(F.col("l_linestatus") == "O").select(*pairs)
    return setops.union_distinct(a, b)


@query("except_distinct", "SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_linestatus = 'O'")
def except_distinct(t: Tables):
    a = t.lineitem.where(F.col("l_returnflag") == "R").select("l_partkey", "l_suppkey")
    b = t.lineitem.where(F.col("l_linestatus") == "O").select("l_suppkey", "l_partkey")
    return setops.except_distinct(a, b)


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(t: Tables):
    return setops.distinct_rows(t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus"))


@query(
    "fn_string",
    """SELECT c_custkey, substring(c_name, 1, 8) AS head, right(c_name, 3) AS tail, rtrim(c_mktsegment || '  ') AS r_trimmed, ltrim('  ' || c_mktsegment) AS l_trimmed, trim(' ' || c_mktsegment || ' ') AS trimmed,
    upper(c_name) AS up, lower(c_name) AS low, replace(c_name, '#', '-') AS replaced, CAST(instr(c_name, '#') AS INTEGER) AS at, CAST(length(c_name) AS INTEGER) AS len, c_name || '/' || c_mktsegment AS joined,
    concat_ws('|', c_mktsegment, NULL, c_name) AS joined_ws, c_name LIKE '%9' AS ends_nine FROM customer""",
)
def fn_string(t: Tables):
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return t.customer.select(
        "c_custkey",
        F.substring(name, 1, 8).alias("head"),
        F.substring(name, -3, 3).alias("tail"),
        F.rtrim(F.concat(segment, F.lit("  "))).alias("r_trimmed"),
        F.ltrim(F.concat(F.lit("  "), segment)).alias("l_trimmed"),
        F.trim(F.concat(F.lit(" "), segment, F.lit(" "))).alias("trimmed"),
        F.upper(name).alias("up"),
        F.lower(name).alias("low"),
        F.replace(name, F.lit("#"), F.lit("-")).alias("replaced"),
        F.instr(name, "#").alias("at"),
        F.length(name).alias("len"),
        F.concat(name, F.lit("/"), segment).alias("joined"),
        F.concat_ws("|", segment, F.lit(None).cast("string"), name).alias("joined_ws"),
        name.like("%9").alias("ends_nine"),
    )


@query(
    "fn_date",
    """SELECT event_id, strftime(ts, '%Y%m') AS ym, CAST(CAST(ts AS DATE) + INTERVAL 2 MONTH AS DATE) AS plus_months, CAST(date_trunc('month', ts) AS DATE) AS month_start, last_day(CAST(ts AS DATE)) AS month_end,
    CAST(date_trunc('year', ts) AS DATE) AS year_start, CAST(date_diff('day', DATE '2023-12-31', CAST(ts AS DATE)) AS INTEGER) AS days, CAST(ts AS DATE) + 10 AS plus_days, CAST(ts AS DATE) - 10 AS minus_days,
    CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m, CAST(hour(ts) AS INTEGER) AS h, CAST(minute(ts) AS INTEGER) AS mi, CAST(floor(second(ts)) AS INTEGER) AS s,
    CAST(strptime(strftime(ts, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS parsed, strftime(ts - INTERVAL 575 MINUTE, '%Y-%m-%d %H:%M:%S') AS shifted,
    strftime(strptime(strftime(ts, '%Y-%m-%d %H:%M'), '%Y-%m-%d %H:%M'), '%Y%m%d%H%M%S') AS stamped, strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(event_id * 3600), '%Y-%m-%d %H:%M:%S') AS from_epoch FROM events""",
)
def fn_date(t: Tables):
    ts, d = F.col("ts"), day("ts")
    return t.events.select(
        "event_id",
        F.date_format(ts, "yyyyMM").alias("ym"),
        F.add_months(d, 2).alias("plus_months"),
        F.trunc(d, "month").alias("month_start"),
        F.last_day(d).alias("month_end"),
        F.date_trunc("year", ts).cast("date").alias("year_start"),
        F.datediff(d, F.lit("2023-12-31").cast("date")).alias("days"),
        F.date_add(d, 10).alias("plus_days"),
        F.date_sub(d, 10).alias("minus_days"),
        F.year(ts).alias("y"),
        F.month(ts).alias("m"),
        F.hour(ts).alias("h"),
        F.minute(ts).alias("mi"),
        F.second(ts).alias("s"),
        F.to_date(F.date_format(ts, "dd/MM/yyyy"), "dd/MM/yyyy").alias("parsed"),
        F.date_format(ts - F.expr("interval 9 hours 35 minutes"), "yyyy-MM-dd HH:mm:ss").alias("shifted"),
        F.date_format(F.to_timestamp(F.date_format(ts, "yyyy-MM-dd HH:mm"), "yyyy-MM-dd HH:mm"), "yyyyMMddHHmmss").alias("stamped"),
        F.from_unixtime(F.col("event_id") * 3600, "yyyy-MM-dd HH:mm:ss").alias("from_epoch"),
    )


@query(
    "fn_math",
    """SELECT l_orderkey, l_linenumber, ROUND(l_extendedprice, 1) AS rounded, CAST(floor(l_extendedprice) AS BIGINT) AS floored, CAST(ceil(l_extendedprice) AS BIGINT) AS ceiled, abs(l_discount - l_tax) AS gap,
    l_linenumber % 3 AS remainder, GREATEST(l_discount, l_tax) AS hi, LEAST(l_discount, l_tax) AS lo FROM lineitem""",
)
def fn_math(t: Tables):
    price, discount, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.round(price, 1).alias("rounded"), F.floor(price).alias("floored"), F.ceil(price).alias("ceiled"),
        F.abs(discount - tax).alias("gap"), (F.col("l_linenumber") % 3).alias("remainder"),
        F.greatest(discount, tax).alias("hi"), F.least(discount, tax).alias("lo"),
    )


@query(
    "fn_null",
    """SELECT o_orderkey, COALESCE(NULLIF(o_orderstatus, 'P'), 'none') AS status, NULLIF(o_orderstatus, 'P') IS NULL AS missing, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS code,
    TRY_CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS level, TRY_CAST(o_orderpriority AS INTEGER) AS no_number FROM orders""",
)
def fn_null(t: Tables):
    status = F.col("o_orderstatus")
    known = F.nullif(status, F.lit("P"))
    return t.orders.select(
        "o_orderkey",
        F.nvl(known, F.lit("none")).alias("status"),
        F.isnull(known).alias("missing"),
        F.when(status == "F", 1).when(status == "O", 2).otherwise(3).alias("code"),
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("level"),
        F.col("o_orderpriority").try_cast("int").alias("no_number"),
    )


@query(
    "fn_collection",
    """WITH d AS (SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem), e AS (SELECT l_suppkey, l_returnflag AS k, l_linestatus AS v FROM d)
    SELECT l_suppkey, string_agg(DISTINCT k, ',' ORDER BY k) AS flags, COUNT(*) AS pairs, string_agg(k || v, ',' ORDER BY k || v) AS combos FROM e GROUP BY 1""",
)
def fn_collection(t: Tables):
    kinds = t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()
    entries = kinds.select("l_suppkey", F.explode(F.create_map("l_returnflag", F.struct(F.col("l_linestatus").alias("v")))).alias("k", "s"))
    combos = F.collect_list(F.concat("k", F.col("s.v")))
    return entries.groupBy("l_suppkey").agg(
        F.concat_ws(",", F.sort_array(F.collect_set("k"))).alias("flags"),
        F.size(F.collect_list("k")).cast("long").alias("pairs"),
        F.concat_ws(",", F.sort_array(combos)).alias("combos"),
    )
