"""Change capture, period replacement, sinks and the metadata-driven loader."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farmledger.operators import dims, joins, merge
from farmledger.plans import finance
from farmledger.sources import (
    append,
    drop_old_versions,
    load_list,
    read_table_list,
    replace_months,
    run_table_list,
    safe_overwrite,
    strip_prefix,
)
from farmledger.streaming import cdc_stream

SCHEMA = "mandt string, id int, amount double, flag string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def target(spark):
    return spark.createDataFrame([("300", 1, 10.0), ("300", 2, 20.0), ("400", 1, 40.0)], "mandt string, id int, amount double")


def changes(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_cdc_composite_key(spark, target):
    got = merge.cdc_apply(
        target,
        changes(
            spark, ("300", 1, 11.0, "U"), ("300", 2, 0.0, "D"), ("500", 9, 90.0, "I"), ("600", 9, 5.0, "U"),
            ("700", 1, 1.0, "D"), ("800", 1, 1.0, ""), ("900", 1, 1.0, None),
        ),
        ["mandt", "id"], "flag",
    )
    # U of an absent key is added, D of an absent key and unflagged rows are ignored.
    assert rows(got) == [("300", 1, 11.0), ("400", 1, 40.0), ("500", 9, 90.0), ("600", 9, 5.0)]


def test_cdc_several_changes_of_one_key(spark, target):
    many = spark.createDataFrame(
        [("300", 1, 11.0, "U", 1), ("300", 1, 12.0, "U", 2), ("300", 2, 1.0, "U", 1), ("300", 2, 1.0, "D", 2)],
        SCHEMA + ", seq int",
    )
    kept = merge.cdc_apply(target, many.drop("seq"), ["mandt", "id"], "flag")
    assert rows(kept) == [("300", 1, 11.0), ("300", 1, 12.0), ("300", 2, 1.0), ("400", 1, 40.0)]
    latest = merge.cdc_apply(target, many, ["mandt", "id"], "flag", order_col="seq")
    assert rows(latest) == [("300", 1, 12.0), ("400", 1, 40.0)]


def test_cdc_is_idempotent(spark, target):
    batch = changes(spark, ("300", 1, 11.0, "U"), ("300", 2, 0.0, "D"))
    once = merge.cdc_apply(target, batch, ["mandt", "id"], "flag")
    assert rows(merge.cdc_apply(once, batch, ["mandt", "id"], "flag")) == rows(once)


def test_cdc_first_load(spark):
    batch = changes(spark, ("1", 1, 1.0, ""), ("1", 2, 2.0, None), ("1", 3, 3.0, "I"), ("1", 4, 4.0, "D"))
    assert [r[1] for r in rows(merge.cdc_apply(None, batch, ["id"], "flag"))] == [1, 2, 3]
    assert [r[1] for r in rows(merge.cdc_apply(None, batch, ["id"], "flag", initial="blank_only"))] == [1, 2]


def dated(spark, *data):
    df = spark.createDataFrame([(i, d) for i, d in data], "id int, d string")
    return df.withColumn("d", F.col("d").cast("timestamp_ntz"))


def test_replace_rolling_keeps_rows_outside_and_without_date(spark):
    target = dated(spark, (1, "2024-01-31"), (2, "2024-02-01"), (3, None), (4, "2024-06-15"))
    source = dated(spark, (10, "2024-01-31"), (11, "2024-02-01"), (12, "2024-07-01"), (13, None))
    got = merge.replace_rolling(target, source, "d", dt.date(2024, 6, 20), 4)
    assert [r[0] for r in rows(got)] == [1, 11, 12, 3]
    again = merge.replace_rolling(got, source, "d", dt.date(2024, 6, 20), 4)
    assert rows(again) == rows(got)


def test_replace_range_and_reload(spark):
    target = dated(spark, (1, "2023-12-31"), (2, "2024-01-01"), (3, "2024-02-29"), (4, "2024-03-01"))
    source = dated(spark, (20, "2024-02-10"), (21, "2024-03-02"))
    got = merge.replace_range(target, source, "d", dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    assert [r[0] for r in rows(got)] == [1, 20, 4]
    assert rows(merge.replace_range(target, source, None)) == rows(source)


def test_update_from_guard_and_missing(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, None, 3.0)], "id int, k string, v double")
    lookup = spark.createDataFrame([(1, 10.0), (2, None), (3, 30.0)], "id int, n double")
    got = merge.update_from(df, lookup, ["id"], {"v": "n"}, F.col("k").isin("a", "b"))
    assert rows(got) == [(1, "a", 10.0), (2, "b", None), (3, None, 3.0)]


def test_safe_overwrite_reads_itself_and_keeps_old_version(spark, tmp_path):
    root = str(tmp_path / "t")
    first = safe_overwrite(spark.range(3).toDF("id"), "t_safe", root)
    safe_overwrite(spark.table("t_safe").where("id > 0"), "t_safe", root)
    assert rows(spark.table("t_safe")) == [(1,), (2,)]
    assert spark.read.parquet(first).count() == 3
    safe_overwrite(spark.range(1).select(F.lit("x").alias("other")), "t_safe", root)
    assert rows(spark.table("t_safe")) == [("x",)]


def test_append_matches_columns_by_name(spark, tmp_path):
    path = str(tmp_path / "a")
    append(spark.sql("select 1 a, 'x' b"), "t_append", path)
    append(spark.sql("select 'y' b, 2 a"), "t_append", path)
    assert rows(spark.table("t_append")) == [(1, "x"), (2, "y")]


def test_replace_months_touches_only_its_range(spark, tmp_path):
    root = str(tmp_path / "m")
    base = dated(spark, (1, "2024-01-05"), (2, "2024-02-05"), (3, "2024-03-05"), (4, "2024-04-05"))
    base.withColumn("month", F.date_format("d", "yyyyMM")).write.partitionBy("month").option("path", f"{root}/0").saveAsTable("t_months")
    source = dated(spark, (30, "2024-03-09"), (50, "2024-05-09"), (60, "2024-06-09"))
    for _ in range(2):
        replace_months(spark, "t_months", source, "d", dt.date(2024, 2, 1), dt.date(2024, 5, 1), root)
        # February to May give way: 2, 3 and 4 go, 30 and 50 come, June is outside the range.
        assert sorted(r[0] for r in spark.table("t_months").select("id").collect()) == [1, 30, 50]


def test_control_list_and_missing_source(spark, tmp_path):
    (tmp_path / "list.txt").write_text("source|target|PK1|PK2\nsrc_a|tgt_a|id|\nsrc_missing|tgt_b|id|\n")
    landing = tmp_path / "landing"
    changes(spark, ("1", 1, 5.0, ""), ("1", 2, 6.0, "I")).write.parquet(str(landing / "src_a"))
    control = list(load_list(read_table_list(spark, str(tmp_path / "list.txt"))))
    assert [r["target"] for r in control] == ["tgt_a", "tgt_b"]
    done = finance.apply_ledger_changes(spark, str(tmp_path / "list.txt"), str(landing), str(tmp_path / "out"), flag="flag")
    assert [(o.entry["target"], o.loaded) for o in done] == [("tgt_a", True), ("tgt_b", False)]
    assert spark.table("tgt_a").count() == 2

    def broken(_):
        raise ValueError("not a missing source")

    with pytest.raises(ValueError):
        run_table_list(control, broken)


def test_ledger_load_is_idempotent_and_touches_changed_buckets_only(spark, tmp_path):
    (tmp_path / "list.txt").write_text("source|target|PK1\nsrc|ledger_t|id\n")
    first = changes(spark, *[("1", k, float(k), "") for k in range(40)])
    first.write.parquet(str(tmp_path / "a" / "src"))
    changes(spark, ("1", 3, 0.5, "I"), ("1", 99, 9.0, "I"), ("1", 4, 0.0, "D"), ("1", 5, 55.0, "U")).write.parquet(str(tmp_path / "b" / "src"))

    def load(folder):
        finance.apply_ledger_changes(spark, str(tmp_path / "list.txt"), str(tmp_path / folder), str(tmp_path / "out"), flag="flag", buckets=8)
        spark.catalog.refreshTable("ledger_t")
        return {r["id"]: r["amount"] for r in spark.table("ledger_t").select("id", "amount").collect()}

    def places():
        found = spark.table("ledger_t").select("key_bucket", F.input_file_name().alias("f")).distinct().collect()
        return {r["key_bucket"]: r["f"].split("version-")[1][:32] for r in found}

    assert load("a") == {k: float(k) for k in range(40)} == load("a")
    before = places()
    want = {k: float(k) for k in range(40) if k != 4} | {3: 0.5, 5: 55.0, 99: 9.0}
    assert load("b") == want
    after = places()
    moved = {b for b in after if before.get(b) != after[b]}
    assert 0 < len(moved) <= 4 and len(before) > 4
    assert load("b") == want
    root = str(tmp_path / "out" / "ledger_t")
    kept = {p.name for p in (tmp_path / "out" / "ledger_t").iterdir() if p.name.startswith("version-")}
    assert drop_old_versions(spark, "ledger_t", root, dt.timedelta(days=1)) == []
    gone = drop_old_versions(spark, "ledger_t", root, dt.timedelta(days=-1))
    assert set(gone) and set(gone) < kept and load("b") == want


def test_lookups_with_several_rows_of_a_key_do_not_multiply(spark):
    df = spark.createDataFrame([(1, "a", 1.0)], "id int, k string, v double")
    twice = spark.createDataFrame([(1, 10.0), (1, 30.0)], "id int, n double")
    assert rows(merge.update_from(df, twice, ["id"], {"v": "n"})) == [(1, "a", 30.0)]
    moves = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("a", "w", 3)], "k string, place string, at int")
    assert rows(joins.reattribute(df.withColumn("at", F.lit("old")), moves, "k", {"at": "place"}, "at")) == [(1, "a", 1.0, "w")]
    assert rows(joins.join_norm(df, spark.sql("select ' A' k, 1 q union all select 'a ', 2"), ["k"])) == [(1, "a", 1.0, 2)]
    dim = spark.sql("select 'a' code, 5 sk union all select 'a', 7 union all select 'none', -1")
    assert dims.star_lookup(df, [(dim, {"k": "code"}, "sk", F.col("code") == "none")]).select("sk").collect() == [(7,)]


def test_insert_if_new_compares_nulls_and_keeps_copies(spark):
    target = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    candidate = spark.createDataFrame([(1, None), (3, None), (3, None)], "a int, b string")
    assert rows(merge.append_new(target, candidate)) == rows(target) + [(3, None)]


def test_reload_tables(spark, tmp_path):
    (tmp_path / "l.txt").write_text("s|t\nsrc1|m1\nnone|m2\n")
    spark.range(4).write.parquet(str(tmp_path / "in" / "src1.parquet"))
    done = finance.reload_tables(spark, str(tmp_path / "l.txt"), str(tmp_path / "in"), str(tmp_path / "out"), "si_")
    assert [o.loaded for o in done] == [True, False]
    assert spark.table("si_m1").count() == 4


def test_strip_prefix(spark):
    assert strip_prefix(spark.sql("select 1 as `t.a`, 2 as b")).columns == ["a", "b"]


def test_stream_equals_batch(spark, tmp_path, target):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    schema = SCHEMA + ", seq int"
    first = spark.createDataFrame([("1", 1, 1.0, "I", 1), ("1", 2, 2.0, "", 1)], schema)
    second = spark.createDataFrame([("1", 1, 9.0, "U", 2), ("1", 2, 0.0, "D", 2), ("1", 3, 3.0, "I", 2)], schema)
    for batch in (first, second):
        batch.coalesce(1).write.mode("append").parquet(landing)
        cdc_stream(
            spark, landing, batch.schema, "t_stream", root, ["mandt", "id"], "flag", "seq", str(tmp_path / "cp")
        ).awaitTermination()
    expected = merge.cdc_apply(None, first, ["mandt", "id"], "flag", order_col="seq")
    expected = merge.cdc_apply(expected, second, ["mandt", "id"], "flag", order_col="seq")
    assert rows(spark.table("t_stream").select(*expected.columns)) == rows(expected)


def test_billing_rules(spark):
    header = spark.createDataFrame(
        [("300", "1", "SFER", "ZF", "1001"), ("300", "2", "SFER", "ZFTC", "1001"), ("300", "3", "CHIM", "ZF", "2007"), ("300", "4", "SFER", "ZF", "2001")],
        "MANDT string, VBELN string, BUKRS string, FKART string, VKORG string",
    )
    item = spark.createDataFrame(
        [("300", "1", "0001509"), ("300", "1", "0009"), ("300", "2", "0001509"), ("300", "3", "000461"), ("300", "4", "0001509")],
        "MANDT string, VBELN string, PRCTR string",
    )
    got = finance.billing(header, item, ["VBELN", "BUKRS", "FKART", "VKORG"], ["PRCTR"])
    assert sorted(r["VBELN"] for r in got.collect()) == ["1", "3"]
