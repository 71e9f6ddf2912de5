"""Ledgers that know the order of their changes: base files, a keyed log of later changes, and a register of landed files.

A ledger keeps the order value of each key's last change, that of a delete as well (a tombstone), and a change counts only
when its value is higher. Loads may therefore come again, late or in any order and give the same ledger. A load writes the
changes that count, dealt by a hash of the key, to the log; readers take a key from the log where it has it, else from the
base. A bucket whose log has grown past a share of its base is written anew, alone. Data, log and the register of files that
were applied are named by one commit (:mod:`farmledger.sources.snapshots`).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farmledger.sources.snapshots import Snapshot, commit, read_parts, read_snapshot, write_parts

ORDER, GONE = "_order", "_gone"


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [left[k].eqNullSafe(right[k]) for k in keys]


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _last(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of each key with the highest order value, ties broken by the whole row."""
    rest = [c for c in rows.columns if c not in (*keys, ORDER)]
    best = rows.groupBy(*keys).agg(F.max(F.struct(ORDER, *rest)).alias("__row"))
    return best.select(*keys, "__row.*").select(*rows.columns)


def _state(spark: SparkSession, root: str, snapshot: Snapshot, keys: Sequence[str], parts: list[str] | None = None) -> DataFrame:
    """Every key's last row, tombstones included."""
    base = read_parts(spark, root, snapshot, "base", parts)
    if not any(p for p in snapshot.folders.get("log", {}) if parts is None or p in parts):
        return base
    log = _last(read_parts(spark, root, snapshot, "log", parts), keys)
    return base.join(log, _same_key(base, log, keys), "left_anti").unionByName(log)


def _marked(changes: DataFrame, flag: str, order: Column, initial: str | None) -> DataFrame:
    """Changes that have a meaning, without their flag, with order value and tombstone mark."""
    mark = F.coalesce(F.upper(F.trim(F.col(flag))), F.lit(""))
    if initial is None:
        known = mark.isin("I", "U", "D")
    else:
        known = mark == "" if initial == "blank_only" else F.lit(True)
    return changes.where(known).withColumn(ORDER, order).withColumn(GONE, mark == "D").drop(flag)


def load_changes(
    spark: SparkSession, root: str, changes: DataFrame, keys: Sequence[str], flag: str, order: str | Column,
    initial: str = "all_but_deletes", buckets: int = 64, compact_at: float = 0.25, most_logs: int = 16, applied: str | None = None,
) -> Snapshot:
    """Apply I/U/D rows to the ledger below ``root``; returns the commit that is current afterwards.

    A change counts when its order value is higher than that of the key's last change, so a load that is repeated writes
    nothing, and a late one cannot bring back older values or deleted rows. Of several changes of a key in one load the
    last counts (ties: the highest row). The first load takes unflagged rows, too (``initial="blank_only"``: only those);
    later loads ignore them. A null order value is lower than all others; null keys compare equal. ``compact_at`` is the
    share of a bucket's base that its log may reach, ``most_logs`` the number of its log folders. ``applied`` names a folder
    with the paths of the landed files, for :func:`load_landing`.
    """
    keys, order = list(keys), F.col(order) if isinstance(order, str) else order
    present = read_snapshot(spark, root)
    register = [applied] if applied else []
    if present is None:
        first = _last(_marked(changes, flag, order, initial), keys)
        schema = json.dumps(first.schema.jsonValue())
        name, rows = write_parts(first, _bucket(keys, buckets), root, "base")
        settings = {"keys": "\n".join(keys), "buckets": str(buckets)}
        return commit(spark, root, Snapshot(1, schema, {"base": {p: [name] for p in rows}, "log": {}}, {"base": rows, "log": {}}, register, settings))
    buckets = int(present.settings["buckets"])
    empty = read_parts(spark, root, present, "none")
    fresh = _last(_marked(changes, flag, order, None), keys)
    fresh = fresh.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in empty.schema.fields])
    # a staged copy: changes are read once, and the load goes on from files whatever becomes of its source
    staged, touched = write_parts(fresh, _bucket(keys, buckets), root, "staged")
    folders = {kind: {p: list(names) for p, names in present.folders[kind].items()} for kind in ("base", "log")}
    rows = {kind: dict(present.rows[kind]) for kind in ("base", "log")}
    if touched:
        held = Snapshot(schema=present.schema, folders={"staged": {p: [staged] for p in touched}})
        fresh = read_parts(spark, root, held, "staged")
        known = _state(spark, root, present, keys, list(touched)).select(*keys, F.col(ORDER).alias("_known"), F.lit(True).alias("_found"))
        newer = F.col("_found").isNull() | (F.col("_known").isNull() & F.col(ORDER).isNotNull()) | (F.col(ORDER) > F.col("_known"))
        counts = fresh.join(known, _same_key(fresh, known, keys), "left").where(newer).select(*[fresh[c] for c in fresh.columns])
        name, grown = write_parts(counts, _bucket(keys, buckets), root, "log")
        for p, n in grown.items():
            folders["log"].setdefault(p, []).append(name)
            rows["log"][p] = rows["log"].get(p, 0) + n
    snapshot = Snapshot(present.number + 1, present.schema, folders, rows, present.applied + register, present.settings)
    full = [p for p, n in rows["log"].items() if n > compact_at * rows["base"].get(p, 0) or len(folders["log"][p]) > most_logs]
    if full:
        name, written = write_parts(_state(spark, root, snapshot, keys, full), _bucket(keys, buckets), root, "base")
        for p in full:
            folders["base"][p], rows["base"][p] = [name], written[p]
            del folders["log"][p], rows["log"][p]
    if not touched and not register:
        return present
    return commit(spark, root, snapshot)


def ledger_rows(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The live rows of the ledger as of the last commit, or of an earlier one that is still there."""
    snapshot = read_snapshot(spark, root, number)
    return _state(spark, root, snapshot, snapshot.settings["keys"].split("\n")).where(~F.col(GONE)).drop(ORDER, GONE)


def load_landing(
    spark: SparkSession, root: str, landing: str, keys: Sequence[str], flag: str, order_col: str | None = None, **options,
) -> int:
    """Apply the files of a landing folder that no earlier load has applied; returns their number.

    Without ``order_col`` files count in the order of their modification times, then names. The register of applied files
    is committed with their data: a load that died half-way is run again and takes the same files. The driver holds the
    paths of the new files only.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(landing).select("path")
    present = read_snapshot(spark, root)
    if present and present.applied:
        register = spark.read.schema("path string").parquet(*[f"{root.rstrip('/')}/{name}" for name in present.applied])
        found = found.join(register, "path", "left_anti")
    paths = [r.path for r in found.collect()]
    if not paths:
        return 0
    applied = f"applied-{uuid.uuid4().hex}"
    spark.createDataFrame([(p,) for p in paths], "path string").write.parquet(f"{root.rstrip('/')}/{applied}")
    order = F.col(order_col) if order_col else F.struct("_metadata.file_modification_time", "_metadata.file_path")
    load_changes(spark, root, spark.read.parquet(*paths), keys, flag, order, applied=applied, **options)
    return len(paths)
