"""Farm concepts expressed on the driver tables.

Reporting date, hierarchy and daily readings as the queries use them. The hierarchy is region > nation (zone) >
customer (farm) > order (lot) > line number (pen); a user's event stream stands for an entity's sensor readings.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farmledger.sources.tables import Tables

AS_OF = dt.date(2001, 8, 1)


def fx(expression: str, scale: int = 4) -> str:
    """SQL twin of :func:`farmledger.functions.fixed`."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(30, 8)), {scale}) AS DOUBLE)"


def day(c: str):
    return F.col(c).cast("date")


def farm_lines(t: Tables) -> DataFrame:
    """Lines with their lot, farm and zone."""
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("farm"), "o_orderdate", "o_orderstatus")
    farms = t.customer.select(F.col("c_custkey").alias("farm"), F.col("c_nationkey").alias("zone"))
    return t.lineitem.join(orders, "l_orderkey").join(farms, "farm")


FARM_LINES = """(SELECT l.*, o.o_custkey AS farm, o.o_orderdate, o.o_orderstatus, c.c_nationkey AS zone
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey)"""


def daily_readings(t: Tables) -> DataFrame:
    """One row per user and day number (1 = 1 January 2024) with count and sum of values."""
    number = (F.datediff(day("ts"), F.lit(dt.date(2024, 1, 1))) + 1).cast("int")
    return (
        t.events.groupBy("user_id", number.alias("day"))
        .agg(F.round(F.sum("value"), 2).alias("reading"), F.count(F.lit(1)).alias("n_events"))
    )


DAILY_READINGS = """(SELECT user_id, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS day,
ROUND(SUM(value), 2) AS reading, COUNT(*) AS n_events FROM events GROUP BY 1, 2)"""
