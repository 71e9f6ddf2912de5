"""Finance jobs: ledger masters, change capture, profitability, billing, expenses, eggs and cost orders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from farmledger.operators.filters import split_by, where
from farmledger.plans.loads import CHANGES_SQL, cdc_frames
from farmledger.plans.registry import query
from farmledger.session import scratch_path
from farmledger.sources import detached, full_reload, load_list, read_table, read_table_list, run_table_list
from farmledger.sources.tables import LoadOutcome, Tables
from farmledger.sources.ledger import ledger_rows, load_landing
from farmledger.sources.snapshots import month_rows, replace_months_at_once
from farmledger.streaming.cdc import apply_changes, ledger_stream

# The ledger columns that the published tables hold.
PROFIT_HEADER = (
    "TRKEYNR ARTNR KNDNR BRSCH BZIRK COPA_KOSTL KDGRP KMVKBU MATKL WWCIC WWGCB WWCLC GJAHR PERDE BUKRS FKART KOKRS "
    "PRCTR VERSI VKORG VRGAR VTWEG PALEDGER"
).split()
PROFIT_VALUES = (
    "ERLOS KWSOHD RABAT VV990 VVADM VVALM VVALT VVCDS VVCFB VVCIR VVCL1 VVCL2 VVCL3 VVCL4 VVCL5 VVCOI VVCTC VVCVE "
    "VVCVM VVCVR VVD50 VVDBO VVDME VVDOT VVDRA VVEPG VVGFI VVGNF VVGUN VVGVD VVIMT VVIPV VVK10 VVK12 VVK40 VVK42 VVK44 "
    "VVK49 VVLOI VVMKT VVOEG VVOIN VVPAR VVPFN VVR11 VVR12 VVR13 VVRSV VVTD2 VVTRP VVTRT VVVEN VVVPR VV936 VVCEW VV991"
).split()
INVOICE_HEADER = "VBELN WAERK ERDAT BUKRS FKART BZIRK VKORG VTWEG SPART KUNAG FKSTO PLTYP KDGRP VBTYP FKDAT".split()
INVOICE_ITEM = (
    "POSNR PRCTR MATNR WERKS NETWR WAVWR SKFBP FKLMG MEINS NTGEW VKBUR VKGRP PRODH MATKL ARKTX"
).split()
EXPENSE_ACTUAL = (
    "RRCTY RVERS RYEAR POPER DOCCT RBUKRS RPRCTR KOKRS RACCT HRKFT RASSC SPRCTR SHOART HSL MSL CPUDT USNAM DOCTY BLDAT "
    "BUDAT REFRYEAR REFDOCCT WERKS KOSTL LSTAR AUFNR MATNR KUNNR EBELN KSTRG PS_PSP_PNR KDAUF FKART CO_PRZNR RSCOPE "
    "BLART SGTXT LIFNR"
).split()
EXPENSE_PLAN_HEAD = (
    "RRCTY RVERS RYEAR RPMAX DOCCT RBUKRS RPRCTR KOKRS RACCT HRKFT RASSC SPRCTR SHOART CPUDT USNAM DOCTY BLDAT BUDAT "
    "REFRYEAR REFDOCCT WERKS KOSTL LSTAR AUFNR MATNR KUNNR KSTRG PS_PSP_PNR KDAUF CO_PRZNR RSCOPE DOCNR DOCLN CPUTM "
    "ANLN1 ANLN2 RTCUR REFDOCLN"
).split()
# The plan ledger has a carry-forward and 16 period amounts in each of four currencies.
EXPENSE_PLAN = EXPENSE_PLAN_HEAD + [
    f"{currency}{period}" for currency in ("TSL", "HSL", "KSL", "MSL") for period in ("VT", *[f"{i:02d}" for i in range(1, 17)])
]
# What counts as billing per company, and which accounts and versions are expenses.
BILLING_RULES = {
    "SFER": {"sales_orgs": ["1001", "1002"], "profit_centre": "000150"},
    "CHIM": {"sales_orgs": ["2001", "2002", "2007"], "profit_centre": "00046"},
}
BILLING_EXCLUDED = ["ZFTC"]
EXPENSE_ACCOUNTS = ("0060000000", "0069999999")
EXPENSE_EXTRA = ["0090000000", "0095000000", "0095000001", "0090000005"]
EXPENSE_COMPANIES = ["SFER", "CHIM"]
EXPENSE_AREA = "GSFE"
EGG_MOVEMENTS = ["101", "102"]


def profitability_lines(
    header: DataFrame, values: DataFrame, header_cols: Sequence[str] = PROFIT_HEADER, value_cols: Sequence[str] = PROFIT_VALUES
) -> DataFrame:
    """Actual and plan profitability lines in one pass, labelled in ``version``."""
    wanted = header.where(F.col("PLIKZ").isin("0", "1"))
    lines = wanted.select(*header_cols, "PLIKZ").join(values.select("TRKEYNR", *value_cols), "TRKEYNR")
    return lines.withColumn("version", F.when(F.col("PLIKZ") == "0", "actual").otherwise("plan")).drop("PLIKZ")


def profitability(
    header: DataFrame, values: DataFrame, header_cols: Sequence[str] = PROFIT_HEADER, value_cols: Sequence[str] = PROFIT_VALUES
) -> tuple[DataFrame, DataFrame]:
    """Actual ('0') and plan ('1') profitability lines."""
    lines = profitability_lines(header, values, header_cols, value_cols)
    actual, plan = split_by(lines, "version", ["actual", "plan"])
    return actual.drop("version"), plan.drop("version")


def _billing_rule(company: str, rule: Mapping[str, Any]) -> Column:
    return (
        (F.col("BUKRS") == company)
        & F.col("VKORG").isin(rule["sales_orgs"])
        & F.col("PRCTR").startswith(rule["profit_centre"])
    )


def billing(
    header: DataFrame, item: DataFrame, header_cols: Sequence[str] = INVOICE_HEADER, item_cols: Sequence[str] = INVOICE_ITEM,
    rules: Mapping[str, Mapping[str, Any]] = BILLING_RULES, excluded: Sequence[str] = BILLING_EXCLUDED,
) -> DataFrame:
    """Invoice items of the companies' own sales organisations; one pass over header and item for all companies."""
    joined = header.select("MANDT", *header_cols).join(item.select("MANDT", "VBELN", *item_cols), ["MANDT", "VBELN"])
    wanted = reduce(Column.__or__, [_billing_rule(c, r) for c, r in rules.items()])
    return where(joined, ~F.col("FKART").isin(list(excluded)), wanted).select(*header_cols, *item_cols)


def expenses_actual(
    ledger: DataFrame, cols: Sequence[str] = EXPENSE_ACTUAL, companies: Sequence[str] = EXPENSE_COMPANIES, area: str = EXPENSE_AREA,
    accounts: tuple[str, str] = EXPENSE_ACCOUNTS, extra: Sequence[str] = EXPENSE_EXTRA,
) -> DataFrame:
    account = F.col("RACCT")
    return where(
        ledger,
        F.col("RHOART").isin("02", "05"),
        F.col("RBUKRS").isin(list(companies)),
        F.col("RVERS") == "000",
        F.col("KOKRS") == area,
        account.between(*accounts) | account.isin(list(extra)),
        F.col("ACTIV").between("0000", "ZZZZ"),
    ).select(*cols)


def expenses_plan(
    ledger: DataFrame, cols: Sequence[str] = EXPENSE_PLAN, area: str = EXPENSE_AREA, accounts: tuple[str, str] = EXPENSE_ACCOUNTS
) -> DataFrame:
    return where(
        ledger,
        F.col("RVERS") == "10A",
        F.col("KOKRS") == area,
        F.col("RACCT").between(*accounts),
        F.col("ACTIV").between("0000", "ZZZZ"),
    ).select(*cols)


def egg_movements(documents: DataFrame) -> DataFrame:
    return documents.where(F.col("BWART").isin(EGG_MOVEMENTS))


def reload_tables(spark: SparkSession, control_path: str, source_dir: str, target_root: str, prefix: str = "") -> list[LoadOutcome]:
    """Copy every table of a control list (source | target) to the next layer; missing sources are skipped."""

    def copy(row: Row) -> None:
        target = f"{prefix}{row[1]}".lower()
        full_reload(read_table(spark, source_dir, row[0].lower()), target, f"{target_root.rstrip('/')}/{target}")

    return run_table_list(load_list(read_table_list(spark, control_path)), copy)


def apply_ledger_changes(
    spark: SparkSession, control_path: str, landing_dir: str, target_root: str, flag: str = "OPFLAG",
    initial: str = "all_but_deletes", order_col: str | None = None, buckets: int = 64,
) -> list[LoadOutcome]:
    """Merge the landed changes of every ledger in a control list (source | target | PK1 | PK2 ...).

    Running it again over the same files gives the same ledgers; only partitions with changed keys are rewritten. Without
    ``order_col`` a folder must hold one change a key. With it ledgers keep the order of their changes, and a run applies
    the files that no earlier run has applied; read them with :func:`farmledger.sources.ledger.ledger_rows`.
    """

    def merge(row: Row) -> None:
        named = row.asDict()
        keys = [v for k, v in named.items() if k.upper().startswith("PK") and v]
        table = row[1].lower()
        if order_col is not None:
            load_landing(spark, f"{target_root.rstrip('/')}/{table}", f"{landing_dir.rstrip('/')}/{row[0]}", keys, flag, order_col, initial=initial, buckets=buckets)
            return
        changes = read_table(spark, landing_dir, row[0], glob="*.parquet")
        apply_changes(spark, table, changes, keys, flag, f"{target_root.rstrip('/')}/{table}", initial, buckets=buckets)

    return run_table_list(load_list(read_table_list(spark, control_path)), merge)



# --- the jobs over the driver tables ---------------------------------------------------------------------------------


def _control(t: Tables, root: str, rows: Sequence[tuple], header: Sequence[str]) -> str:
    path = f"{root}/control"
    t.spark.createDataFrame(list(rows), ", ".join(f"`{h}` string" for h in header)).write.option("header", True).csv(path, sep="|")
    return path


def _load_ledger(t: Tables, *landings: DataFrame) -> DataFrame:
    """Apply landed change sets one after the other and read the ledger that they give."""
    root = scratch_path(t.spark, "ledger")
    table = f"ledger_{root.rsplit('-', 1)[-1]}"
    control = _control(t, root, [("orders_ledger", table, "o_orderkey")], ["source", "target", "PK1"])
    for k, changes in enumerate(landings):
        changes.write.parquet(f"{root}/landing-{k}/orders_ledger")
        for _ in range(2):  # a load that is repeated changes nothing
            apply_ledger_changes(t.spark, control, f"{root}/landing-{k}", f"{root}/silver", "opflag", buckets=8)
    return detached(t.spark, table)


@query("plan_ledger_changes", f"WITH {CHANGES_SQL} SELECT * FROM result")
def plan_ledger_changes(t: Tables):
    target, changes = cdc_frames(t)
    return _load_ledger(t, target.withColumn("opflag", F.lit("")), changes)


@query("plan_ledger_first_load", f"WITH {CHANGES_SQL} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM changes WHERE opflag <> 'D'")
def plan_ledger_first_load(t: Tables):
    return _load_ledger(t, cdc_frames(t)[1])


def _dated_changes(t: Tables) -> dict[str, DataFrame]:
    """An initial extract and change sets of orders; ``seq`` is the order of a change, not of its landing."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")

    def some(where: str, mark: str, seq: int, factor: float = 1.0) -> DataFrame:
        return rows.where(where).withColumn("o_totalprice", F.round(F.col("o_totalprice") * factor, 2)).select("*", F.lit(mark).alias("opflag"), F.lit(seq).alias("seq"))

    return {
        "initial": some("o_orderstatus <> 'P'", "", 0),
        "a": some("o_orderkey % 3 = 0", "U", 1, 2).unionByName(some("o_orderkey % 7 = 0 AND o_orderkey % 3 <> 0", "D", 1)),
        "b": some("o_orderkey % 6 = 0", "u ", 2, 3).unionByName(some("o_orderkey % 5 = 0 AND o_orderkey % 6 <> 0", "D", 3)),
        "late": some("o_orderkey % 5 = 0", "I", 2, 9).unionByName(some("o_orderkey % 4 = 0", "", 9, 5)),
    }


# What the sets of ``_dated_changes`` amount to, in whatever order they land after the initial extract.
_DATED_LEDGER = """WITH ranked AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 0 AS seq, FALSE AS gone FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, ROUND(o_totalprice * 2, 2), 1, FALSE FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 1, TRUE FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 3 <> 0
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, ROUND(o_totalprice * 3, 2), 2, FALSE FROM orders WHERE o_orderkey % 6 = 0
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 3, TRUE FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 6 <> 0
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, ROUND(o_totalprice * 9, 2), 2, FALSE FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 6 <> 0)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM ranked
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1 AND NOT gone"""


@query("plan_ledger_versions", _DATED_LEDGER)
def plan_ledger_versions(t: Tables):
    """Loads A, B, A again and a late one: each run takes the files that are new, and older changes do not come back."""
    root, sets = scratch_path(t.spark, "versions"), _dated_changes(t)
    control = _control(t, root, [("orders_ledger", "orders", "o_orderkey")], ["source", "target", "PK1"])
    for name in ("initial", "a", "b", "a", "late"):
        sets[name].write.mode("append").parquet(f"{root}/landing/orders_ledger")
        apply_ledger_changes(t.spark, control, f"{root}/landing", f"{root}/silver", "opflag", order_col="seq", buckets=8)
    return ledger_rows(t.spark, f"{root}/silver/orders").drop("seq")


@query("plan_ledger_stream", _DATED_LEDGER)
def plan_ledger_stream(t: Tables):
    """The same sets through a stream, the latest change first."""
    root, sets = scratch_path(t.spark, "stream"), _dated_changes(t)
    for name in ("initial", "b", "late", "a"):
        sets[name].write.mode("append").parquet(f"{root}/landing")
        ledger_stream(t.spark, f"{root}/landing", sets[name].schema, f"{root}/ledger", ["o_orderkey"], "opflag", "seq", f"{root}/checkpoint", buckets=8).awaitTermination()
    return ledger_rows(t.spark, f"{root}/ledger").drop("seq")


@query(
    "plan_landing_register",
    """SELECT r AS run, CASE r WHEN 1 THEN (SELECT COUNT(*) FROM orders WHERE o_orderstatus <> 'P') ELSE n END AS live_rows
    FROM range(1, 5) AS runs(r) CROSS JOIN (SELECT COUNT(*) AS n FROM (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND NOT (o_orderkey % 7 = 0 AND o_orderkey % 3 <> 0)
    UNION SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0))""",
)
def plan_landing_register(t: Tables):
    """Rows of the ledger after each of four runs over a landing folder that grows once; runs without a new file add nothing."""
    root, sets = scratch_path(t.spark, "register"), _dated_changes(t)
    out = []
    for run, name in enumerate(("initial", "a", None, None), 1):
        if name:
            sets[name].write.mode("append").parquet(f"{root}/landing")
        load_landing(t.spark, f"{root}/ledger", f"{root}/landing", ["o_orderkey"], "opflag", "seq", buckets=8)
        out.append(ledger_rows(t.spark, f"{root}/ledger").agg(F.count(F.lit(1)).alias("live_rows")).select(F.lit(run).cast("long").alias("run"), "live_rows"))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query(
    "plan_months_at_once",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_day FROM orders
    WHERE o_orderdate < DATE '1998-01-01' OR o_orderdate >= DATE '1999-07-01'
    UNION ALL SELECT o_orderkey, o_orderstatus, ROUND(o_totalprice * 2, 2), CAST(o_orderdate AS DATE) FROM orders
    WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1999-07-01' AND o_orderstatus <> 'P'""",
)
def plan_months_at_once(t: Tables):
    """Eighteen months of a table give way in one step."""
    root = scratch_path(t.spark, "months")
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("order_day"))
    first, last = rows.agg(F.min("order_day"), F.max("order_day")).first()
    replace_months_at_once(t.spark, root, rows, "order_day", first, last)
    fresh = rows.where("o_orderstatus <> 'P'").withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2))
    replace_months_at_once(t.spark, root, fresh, "order_day", dt.date(1998, 1, 1), dt.date(1999, 6, 1))
    return month_rows(t.spark, root)


@query(
    "plan_masters_reload",
    "SELECT 'part' AS master, p_partkey AS code, p_name AS name FROM part UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier",
)
def plan_masters_reload(t: Tables):
    root = scratch_path(t.spark, "masters")
    prefix = f"m_{root.rsplit('-', 1)[-1]}_"
    control = _control(t, root, [("PART", "part"), ("ABSENT", "absent"), ("SUPPLIER", "supplier")], ["source", "target"])
    for _ in range(2):
        reload_tables(t.spark, control, t.directory, f"{root}/bronze", prefix)
    part, supplier = (detached(t.spark, f"{prefix}{name}") for name in ("part", "supplier"))
    rows = part.select(F.lit("part").alias("master"), F.col("p_partkey").alias("code"), F.col("p_name").alias("name"))
    return rows.unionByName(supplier.select(F.lit("supplier").alias("master"), F.col("s_suppkey").alias("code"), F.col("s_name").alias("name")))


@query(
    "plan_profitability",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'actual' ELSE 'plan' END AS version, o_orderkey AS "TRKEYNR", o_custkey AS "KNDNR", e AS "ERLOS", d AS "RABAT"
    FROM orders JOIN (SELECT l_orderkey, ROUND(SUM(l_extendedprice), 2) AS e, SUM(l_quantity) AS d FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey WHERE o_orderstatus IN ('F', 'O')""",
)
def plan_profitability(t: Tables):
    kind = F.when(F.col("o_orderstatus") == "F", "0").when(F.col("o_orderstatus") == "O", "1").otherwise("2")
    header = t.orders.select(F.col("o_orderkey").alias("TRKEYNR"), F.col("o_custkey").alias("KNDNR"), kind.alias("PLIKZ"))
    values = t.lineitem.groupBy(F.col("l_orderkey").alias("TRKEYNR")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("ERLOS"), F.sum("l_quantity").alias("RABAT")
    )
    return profitability_lines(header, values, ["TRKEYNR", "KNDNR"], ["ERLOS", "RABAT"])


@query(
    "plan_billing",
    """WITH i AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'SFER' ELSE 'CHIM' END AS bukrs, CASE o_orderpriority WHEN '1-URGENT' THEN '1001' WHEN '2-HIGH' THEN '2007' ELSE '2002' END AS vkorg,
      CASE WHEN o_orderstatus = 'P' THEN 'ZFTC' ELSE 'ZF01' END AS fkart, l_linenumber, l_extendedprice, CASE WHEN l_returnflag = 'R' THEN '0001501' ELSE '0004602' END AS prctr FROM orders JOIN lineitem ON o_orderkey = l_orderkey)
    SELECT o_orderkey AS "VBELN", bukrs AS "BUKRS", vkorg AS "VKORG", fkart AS "FKART", l_linenumber AS "POSNR", prctr AS "PRCTR", l_extendedprice AS "NETWR" FROM i
    WHERE fkart <> 'ZFTC' AND ((bukrs = 'SFER' AND vkorg IN ('1001', '1002') AND prctr LIKE '000150%') OR (bukrs = 'CHIM' AND vkorg IN ('2001', '2002', '2007') AND prctr LIKE '00046%'))""",
)
def plan_billing(t: Tables):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    header = t.orders.select(
        F.lit("300").alias("MANDT"),
        F.col("o_orderkey").alias("VBELN"),
        F.when(status == "F", "SFER").otherwise("CHIM").alias("BUKRS"),
        F.when(priority == "1-URGENT", "1001").when(priority == "2-HIGH", "2007").otherwise("2002").alias("VKORG"),
        F.when(status == "P", "ZFTC").otherwise("ZF01").alias("FKART"),
    )
    item = t.lineitem.select(
        F.lit("300").alias("MANDT"),
        F.col("l_orderkey").alias("VBELN"),
        F.col("l_linenumber").alias("POSNR"),
        F.when(F.col("l_returnflag") == "R", "0001501").otherwise("0004602").alias("PRCTR"),
        F.col("l_extendedprice").alias("NETWR"),
    )
    return billing(header, item, ["VBELN", "BUKRS", "VKORG", "FKART"], ["POSNR", "PRCTR", "NETWR"])


_GL = """gl AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS hsl, CASE l_returnflag WHEN 'A' THEN '02' WHEN 'R' THEN '05' ELSE '01' END AS rhoart, CASE WHEN l_discount < 0.05 THEN 'SFER' ELSE 'OTRA' END AS rbukrs,
    CASE WHEN l_linestatus = 'F' THEN '000' ELSE '10A' END AS rvers, CASE WHEN l_quantity < 40 THEN lpad(CAST(60000000 + l_partkey AS VARCHAR), 10, '0') WHEN l_quantity < 45 THEN '0095000001' ELSE '0070000000' END AS racct FROM lineitem)"""


def _ledger(t: Tables) -> DataFrame:
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity")
    account = F.lpad((F.col("l_partkey") + 60000000).cast("string"), 10, "0")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("HSL"),
        F.when(flag == "A", "02").when(flag == "R", "05").otherwise("01").alias("RHOART"),
        F.when(F.col("l_discount") < 0.05, "SFER").otherwise("OTRA").alias("RBUKRS"),
        F.when(F.col("l_linestatus") == "F", "000").otherwise("10A").alias("RVERS"),
        F.when(quantity < 40, account).when(quantity < 45, "0095000001").otherwise("0070000000").alias("RACCT"),
        F.lit("GSFE").alias("KOKRS"), F.lit("RFBU").alias("ACTIV"),
    )


@query(
    "plan_expenses",
    f"""WITH {_GL} SELECT 'actual' AS version, l_orderkey, l_linenumber, racct AS "RACCT", hsl AS "HSL" FROM gl WHERE rhoart IN ('02', '05') AND rbukrs IN ('SFER', 'CHIM') AND rvers = '000'
    AND (racct BETWEEN '0060000000' AND '0069999999' OR racct IN ('0090000000', '0095000000', '0095000001', '0090000005'))
    UNION ALL SELECT 'plan', l_orderkey, l_linenumber, racct, hsl FROM gl WHERE rvers = '10A' AND racct BETWEEN '0060000000' AND '0069999999'""",
)
def plan_expenses(t: Tables):
    ledger, cols = _ledger(t), ["l_orderkey", "l_linenumber", "RACCT", "HSL"]
    actual = expenses_actual(ledger, cols).withColumn("version", F.lit("actual"))
    return actual.unionByName(expenses_plan(ledger, cols).withColumn("version", F.lit("plan")))


@query(
    "plan_egg_movements",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN '101' ELSE '102' END AS "BWART", l_quantity FROM lineitem WHERE l_returnflag IN ('A', 'R')""",
)
def plan_egg_movements(t: Tables):
    flag = F.col("l_returnflag")
    movement = F.when(flag == "A", "101").when(flag == "R", "102").otherwise("261").alias("BWART")
    return egg_movements(t.lineitem.select("l_orderkey", "l_linenumber", movement, "l_quantity"))
