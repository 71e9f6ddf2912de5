"""Ledgers that know the order of their changes, the register of landed files, and snapshot commits."""

import datetime as dt
import itertools
import os

import pytest
from py4j.protocol import Py4JJavaError

from farmledger.sources import drop_unnamed, ledger_rows, load_changes, load_landing, month_rows, read_snapshot, replace_months_at_once
from farmledger.sources import ledger, snapshots
from farmledger.streaming.cdc import apply_changes

SCHEMA = "mandt string, id int, amount double, flag string, seq int"
KEYS = ["mandt", "id"]


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def live(spark, root, number=None):
    return {(r["mandt"], r["id"]): r["amount"] for r in ledger_rows(spark, root, number).collect()}


def load(spark, root, rows, **options):
    return load_changes(spark, root, rows, KEYS, "flag", "seq", **{"buckets": 4, **options})


def test_loads_in_any_order_give_one_ledger(spark, tmp_path):
    first = frame(spark, *[("1", k, float(k), "", 0) for k in range(8)], (None, 1, 1.5, "", 0))
    a = frame(spark, ("1", 1, 11.0, "U", 1), ("1", 2, 0.0, "D", 1), ("2", 9, 9.0, "I", 1), (None, 1, 2.5, "U", 1))
    b = frame(spark, ("1", 1, 12.0, " u", 2), ("1", 1, 12.5, "U", 3), ("1", 3, 0.0, "D", 3), ("1", 7, 7.0, "", 9))
    late = frame(spark, ("1", 2, 22.0, "I", 0), ("1", 3, 33.0, "I", 2), ("1", 4, 44.0, "U", None), ("2", 9, 1.0, "D", 1))
    want = {("1", k): float(k) for k in (0, 4, 5, 6, 7)} | {("1", 1): 12.5, ("2", 9): 9.0, (None, 1): 2.5}
    for k, order in enumerate(itertools.permutations((a, b, late))):
        root = f"{tmp_path}/{k}"
        for rows in (first, *order, *order):
            load(spark, root, rows, compact_at=(0.0, 0.3, 100.0)[k % 3])
        # ("2", 9) has two changes with one order value: the one that was applied first counts
        assert live(spark, root) == (want if order.index(a) < order.index(late) else {k: v for k, v in want.items() if k != ("2", 9)})


def test_an_older_load_does_not_roll_the_bucketed_ledger_back(spark, tmp_path):
    first = frame(spark, ("1", 1, 1.0, "", 0), ("1", 2, 2.0, "", 0))
    a, b = frame(spark, ("1", 1, 11.0, "U", 1)), frame(spark, ("1", 1, 12.0, "U", 2))
    for rows in (first, a, b, a):
        apply_changes(spark, "t_order", rows, KEYS, "flag", str(tmp_path / "r"), order_col="seq", buckets=2)
        spark.catalog.refreshTable("t_order")
    assert {r["id"]: r["amount"] for r in spark.table("t_order").collect()} == {1: 12.0, 2: 2.0}


def size(root):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet"))


def test_a_load_writes_what_changes(spark, tmp_path):
    root = str(tmp_path / "l")
    many = spark.range(200_000).selectExpr("'1' mandt", "int(id) id", "rand(3) amount", "'' flag", "0 seq")
    load(spark, root, many, buckets=8)
    whole = size(root)
    load(spark, root, frame(spark, *[("1", 37 * k, 0.5, "U", 1) for k in range(200)]))
    grown = size(root) - whole
    assert grown < whole / 20
    before = size(root)
    load(spark, root, frame(spark, *[("1", 37 * k, 0.5, "U", 1) for k in range(200)]))  # again: only the staged copy
    assert size(root) - before < grown and live(spark, root)[("1", 37)] == 0.5 and len(live(spark, root)) == 200_000
    assert drop_unnamed(spark, root, dt.timedelta(days=-1)) and live(spark, root)[("1", 74)] == 0.5


def test_one_bucket_is_compacted_alone(spark, tmp_path):
    root = str(tmp_path / "c")
    first = load(spark, root, frame(spark, *[("1", k, 1.0, "", 0) for k in range(400)]))
    log = load(spark, root, frame(spark, ("1", 5, 2.0, "U", 1)), compact_at=0.5)
    (bucket,) = log.folders["log"]
    assert log.folders["base"] == first.folders["base"]
    whole = load(spark, root, frame(spark, ("1", 5, 3.0, "D", 2)), compact_at=0.0)
    assert not whole.folders["log"]
    assert {p for p in first.folders["base"] if first.folders["base"][p] != whole.folders["base"][p]} == {bucket}
    load(spark, root, frame(spark, ("1", 5, 9.0, "I", 1)))  # the tombstone outlives the compaction
    assert ("1", 5) not in live(spark, root) and len(live(spark, root)) == 399


def test_files_are_applied_once_and_a_crash_repeats_safely(spark, tmp_path, monkeypatch):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "l")
    run = lambda: load_landing(spark, root, landing, KEYS, "flag", "seq", buckets=2)
    frame(spark, ("1", 1, 1.0, "", 0), ("1", 2, 2.0, "", 0)).coalesce(1).write.parquet(landing)
    assert (run(), run()) == (1, 0)
    frame(spark, ("1", 1, 5.0, "U", 1)).coalesce(1).write.mode("append").parquet(landing)
    with monkeypatch.context() as m:
        m.setattr(ledger, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run()
    assert live(spark, root) == {("1", 1): 1.0, ("1", 2): 2.0}
    assert (run(), run()) == (1, 0)
    assert live(spark, root) == {("1", 1): 5.0, ("1", 2): 2.0} and live(spark, root, 1)[("1", 1)] == 1.0


def test_files_without_an_order_column_count_by_their_times(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "l")
    for k, amount in enumerate((1.0, 2.0, 3.0)):
        frame(spark, ("1", 1, amount, "U" if k else "", 0)).coalesce(1).write.mode("append").parquet(landing)
        for d, _, names in os.walk(landing):
            for f in names:
                if f.endswith(".parquet") and os.path.getmtime(f"{d}/{f}") > 1e9:
                    os.utime(f"{d}/{f}", (1000 - 100 * k, 1000 - 100 * k))  # the first one landed last
    load_landing(spark, root, landing, KEYS, "flag", buckets=2)
    assert live(spark, root) == {("1", 1): 1.0}


def test_months_change_at_once(spark, tmp_path):
    root = str(tmp_path / "m")
    rows = lambda *data: spark.createDataFrame([(i, dt.date.fromisoformat(d) if d else None) for i, d in data], "id int, day date")
    replace_months_at_once(spark, root, rows((1, "2024-01-05"), (2, "2024-02-05"), (3, "2024-03-05"), (4, None)), "day", dt.date(2024, 1, 1), dt.date(2024, 3, 1))
    old = read_snapshot(spark, root)
    replace_months_at_once(spark, root, rows((20, "2024-02-07"), (50, "2024-05-01")), "day", dt.date(2024, 2, 1), dt.date(2024, 4, 1))
    assert sorted(r.id for r in month_rows(spark, root).collect()) == [1, 20]
    assert sorted(r.id for r in snapshots.read_parts(spark, root, old, "month").collect()) == [1, 2, 3]  # a reader that opened before
    assert [r.id for r in month_rows(spark, root, ["202402"]).collect()] == [20]
    with pytest.raises(Py4JJavaError):
        snapshots.commit(spark, root, old)  # its number is taken
    assert sorted(r.id for r in month_rows(spark, root).collect()) == [1, 20]
