"""Queries over sources, sinks and incremental loads."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from farmledger.functions.calendar import in_month, previous_month
from farmledger.operators import merge
from farmledger.plans.registry import query
from farmledger.plans.standins import AS_OF, day
from farmledger.session import scratch_path
from farmledger.sources import append, detached, full_reload, safe_overwrite, strip_prefix
from farmledger.sources.tables import Tables


def _table() -> str:
    return f"farmledger_{uuid.uuid4().hex}"


@query("scan_parquet", "SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_day FROM orders")
def scan_parquet(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", day("o_orderdate").alias("order_day"))


@query("full_reload_roundtrip", "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part")
def full_reload_roundtrip(t: Tables):
    name = _table()
    full_reload(t.part.select("p_partkey", "p_brand", "p_size", "p_retailprice"), name, scratch_path(t.spark, "reload"))
    return detached(t.spark, name)


@query("append_roundtrip", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def append_roundtrip(t: Tables):
    name, path = _table(), scratch_path(t.spark, "append")
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    append(rows.where(F.col("c_acctbal") < 0), name, path)
    append(rows.where(F.col("c_acctbal") >= 0).select("c_acctbal", "c_custkey", "c_mktsegment"), name, path)
    return detached(t.spark, name)


@query("strip_prefix", "SELECT p_partkey, p_name, p_type FROM part")
def strip_prefix_query(t: Tables):
    part = t.part.select("p_partkey", "p_name", "p_type")
    return strip_prefix(part.toDF(*[f"part.{c}" for c in part.columns]))


@query("safe_overwrite_roundtrip", "SELECT o_orderkey, o_orderstatus, ROUND(o_totalprice * 2, 2) AS o_totalprice FROM orders")
def safe_overwrite_roundtrip(t: Tables):
    name, root = _table(), scratch_path(t.spark, "overwrite")
    safe_overwrite(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), name, root)
    itself = t.spark.table(name)
    safe_overwrite(itself.withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2)), name, root)
    return detached(t.spark, name)


CHANGES_SQL = """changes AS (SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN o_totalprice * 1.5 ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderstatus = 'P' THEN 'I' WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'D'
         WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'U' ELSE '' END AS opflag FROM orders),
target AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')),
result AS (SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changes WHERE opflag IN ('D', 'U'))
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM changes WHERE opflag IN ('I', 'U'))"""


def cdc_frames(t: Tables):
    """A target ledger and the change rows that arrive for it."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    update = (status == "O") & (priority == "5-LOW")
    flag = (
        F.when(status == "P", "I").when((status == "F") & (priority == "1-URGENT"), "D").when(update, "U").otherwise("")
    )
    price = F.when(update, F.col("o_totalprice") * 1.5).otherwise(F.col("o_totalprice"))
    changes = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", price.alias("o_totalprice"), flag.alias("opflag")
    )
    target = t.orders.where(status.isin("F", "O")).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return target, changes


@query("cdc_apply", f"WITH {CHANGES_SQL} SELECT * FROM result")
def cdc_apply(t: Tables):
    target, changes = cdc_frames(t)
    return merge.cdc_apply(target, changes, ["o_orderkey"], "opflag")


@query(
    "cdc_apply_latest_wins",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_custkey % 3 <> 0",
)
def cdc_apply_latest_wins(t: Tables):
    """Each key is updated first; a third of the customers' orders is deleted later, a fifth comes again without a flag."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    update = rows.withColumn("o_totalprice", F.col("o_totalprice") * 2).select("*", F.lit(" u").alias("opflag"), F.lit(1).alias("seq"))
    delete = rows.where("o_custkey % 3 = 0").select("*", F.lit("D").alias("opflag"), F.lit(2).alias("seq"))
    blank = rows.where("o_custkey % 5 = 0").select("*", F.lit(None).cast("string").alias("opflag"), F.lit(3).alias("seq"))
    target = rows.where(F.col("o_orderstatus").isin("F", "O"))
    changes = update.unionByName(delete).unionByName(blank)
    return merge.cdc_apply(target, changes, ["o_orderkey"], "opflag", order_col="seq")


@query(
    "load_reconciliation",
    f"""WITH {CHANGES_SQL} SELECT (SELECT COUNT(*) FROM target) AS rows_before,
    (SELECT COUNT(*) FROM changes WHERE opflag = 'I') AS rows_inserted,
    (SELECT COUNT(*) FROM changes WHERE opflag = 'U') AS rows_updated,
    (SELECT COUNT(*) FROM changes WHERE opflag = 'D') AS rows_deleted, (SELECT COUNT(*) FROM result) AS rows_after""",
)
def load_reconciliation(t: Tables):
    target, changes = cdc_frames(t)
    path = scratch_path(t.spark, "reconciled")
    return merge.reconciled_load(target, changes, ["o_orderkey"], "opflag", lambda merged: merged.write.parquet(path))


def _ledger(t: Tables):
    target = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    source = target.where(F.col("o_orderstatus") != "P").withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2))
    return target, source


def _replaced(inside: str) -> str:
    return f"""SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_day FROM orders WHERE NOT ({inside})
    UNION ALL SELECT o_orderkey, o_orderstatus, ROUND(o_totalprice * 2, 2), CAST(o_orderdate AS DATE) FROM orders
    WHERE ({inside}) AND o_orderstatus <> 'P'"""


def _dated(df):
    return df.select("o_orderkey", "o_orderstatus", "o_totalprice", day("o_orderdate").alias("order_day"))


@query("replace_month_range", _replaced("o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1999-07-01'"))
def replace_month_range(t: Tables):
    target, source = _ledger(t)
    return _dated(merge.replace_range(target, source, "o_orderdate", dt.date(1998, 1, 1), dt.date(1999, 6, 1)))


@query("replace_rolling_window", _replaced("o_orderdate >= DATE '2001-04-01'"))
def replace_rolling_window(t: Tables):
    target, source = _ledger(t)
    return _dated(merge.replace_rolling(target, source, "o_orderdate", AS_OF, 4))


@query(
    "append_new_rows",
    """WITH target AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT * FROM target UNION ALL (SELECT o_custkey, o_orderstatus FROM orders EXCEPT SELECT * FROM target)""",
)
def append_new_rows(t: Tables):
    pairs = t.orders.select("o_custkey", "o_orderstatus")
    target = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey", "o_orderstatus")
    return merge.append_new(target, pairs)


@query(
    "update_from_lookup",
    """SELECT c_custkey, c_mktsegment, CASE WHEN b.k IS NOT NULL AND c_mktsegment = 'BUILDING' THEN b.top ELSE c_acctbal END AS c_acctbal
    FROM customer LEFT JOIN (SELECT o_custkey AS k, MAX(o_totalprice) AS top FROM orders GROUP BY 1) b ON c_custkey = b.k""",
)
def update_from_lookup(t: Tables):
    top = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("top"))
    customer = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return merge.update_from(customer, top, ["c_custkey"], {"c_acctbal": "top"}, F.col("c_mktsegment") == "BUILDING")


@query(
    "rewrite_when",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN 0.01 WHEN l_discount > 0.08 THEN 0.08 ELSE l_discount END AS l_discount,
    CASE WHEN l_quantity < 5 THEN 'X' ELSE l_returnflag END AS l_returnflag FROM lineitem""",
)
def rewrite_when(t: Tables):
    discount, quantity = F.col("l_discount"), F.col("l_quantity")
    rules = {
        "l_discount": [(discount == 0, F.lit(0.01)), (discount > 0.08, F.lit(0.08))],
        "l_returnflag": [(quantity < 5, F.lit("X"))],
    }
    return merge.rewrite_when(t.lineitem, rules).select("l_orderkey", "l_linenumber", "l_discount", "l_returnflag")


@query(
    "previous_month_filter",
    """SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y%m') AS month_id FROM orders
    WHERE o_orderdate >= DATE '2001-07-01' AND o_orderdate < DATE '2001-08-01'""",
)
def previous_month_filter(t: Tables):
    orders = t.orders.where(in_month("o_orderdate", previous_month(AS_OF)))
    return orders.select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("month_id"))
