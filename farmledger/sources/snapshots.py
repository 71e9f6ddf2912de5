"""Snapshots of partitioned tables: one commit names the folders of all partitions, so readers see a load whole or not at all.

Below a root lie data folders and ``commits``, one small file a commit, numbered without gaps. A load writes its folders
first and its commit last, in one rename that fails where another load has taken the number; that load is run again. What a
load that died left behind is named by no commit and is removed by :func:`drop_unnamed`.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farmledger.functions.calendar import in_month_range

PART = "_part"


@dataclass(frozen=True)
class Snapshot:
    """A commit: for each kind of data the folders of each partition, oldest first, and the columns of the files."""

    number: int = 0
    schema: str = ""
    folders: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    rows: dict[str, dict[str, int]] = field(default_factory=dict)
    applied: list[str] = field(default_factory=list)
    settings: dict[str, str] = field(default_factory=dict)


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _commits(spark: SparkSession, root: str) -> list[int]:
    files, place = _folder(spark, f"{root.rstrip('/')}/commits")
    names = [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
    return sorted(int(n) for n in names if n.isdigit())


def read_snapshot(spark: SparkSession, root: str, number: int | None = None) -> Snapshot | None:
    """The last commit, or the one of that number; None where nothing was committed yet."""
    numbers = _commits(spark, root)
    if not numbers:
        return None
    text = spark.read.text(f"{root.rstrip('/')}/commits/{number or numbers[-1]}", wholetext=True).first()[0]
    return Snapshot(**json.loads(text))


def commit(spark: SparkSession, root: str, snapshot: Snapshot) -> Snapshot:
    """Make a snapshot the current one; fails where its number is taken already."""
    home = f"{root.rstrip('/')}/commits"
    files, draft = _folder(spark, f"{home}/draft-{uuid.uuid4().hex}")
    _, place = _folder(spark, f"{home}/{snapshot.number}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(snapshot.__dict__).encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context.rename(draft, place, no_options)
    return snapshot


def write_parts(df: DataFrame, part: Column, root: str, kind: str) -> tuple[str, dict[str, int]]:
    """Write rows to a fresh folder, one subfolder a partition; returns its name and the rows of each partition."""
    name = f"{kind}-{uuid.uuid4().hex}"
    path = f"{root.rstrip('/')}/{name}"
    placed = df.withColumn(PART, part.cast("string"))
    placed.hint("rebalance", PART).write.partitionBy(PART).parquet(path)
    counted = df.sparkSession.read.schema(placed.schema).parquet(path).groupBy(PART).count().collect()  # a row a partition
    return name, {r[0]: r[1] for r in counted}


def read_parts(spark: SparkSession, root: str, snapshot: Snapshot, kind: str, parts: list[str] | None = None) -> DataFrame:
    """The rows of one kind of data, of all partitions or of some."""
    schema = StructType.fromJson(json.loads(snapshot.schema))
    by_part = snapshot.folders.get(kind, {})
    chosen = by_part if parts is None else [p for p in parts if p in by_part]
    paths = [f"{root.rstrip('/')}/{name}/{PART}={p}" for p in chosen for name in by_part[p]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def drop_unnamed(spark: SparkSession, root: str, older_than: dt.timedelta, commits: int = 2) -> list[str]:
    """Remove data folders that none of the last ``commits`` commits names and that are older than given."""
    named = set()
    for number in _commits(spark, root)[-commits:]:
        snapshot = read_snapshot(spark, root, number)
        named.update(snapshot.applied)
        named.update(name for by_part in snapshot.folders.values() for names in by_part.values() for name in names)
    before = (dt.datetime.now(dt.timezone.utc) - older_than).timestamp() * 1000
    files, place = _folder(spark, root)
    gone = []
    for status in files.listStatus(place) if files.exists(place) else []:
        name = status.getPath().getName()
        if name != "commits" and name not in named and status.getModificationTime() < before:
            files.delete(status.getPath(), True)
            gone.append(name)
    return gone


def replace_months_at_once(spark: SparkSession, root: str, source: DataFrame, date_col: str, lo: dt.date, hi: dt.date) -> Snapshot:
    """Replace the months ``lo``..``hi`` of a snapshot table by the source rows of those months, in one step.

    Only those months are written. Readers see all of them old or all of them new; a run that failed is run again. Months of
    the range without source rows are empty afterwards; rows without a date belong to no month. The first run makes the
    table; later sources are read by its column names.
    """
    present = read_snapshot(spark, root) or Snapshot()
    fresh = source.where(in_month_range(F.col(date_col), lo, hi))
    schema = present.schema or json.dumps(source.schema.jsonValue())
    fresh = fresh.select(*[f.name for f in StructType.fromJson(json.loads(schema)).fields])
    name, rows = write_parts(fresh, F.date_format(date_col, "yyyyMM"), root, "month")
    first, last = f"{lo:%Y%m}", f"{hi:%Y%m}"
    kept = {m: names for m, names in present.folders.get("month", {}).items() if not first <= m <= last}
    counts = {m: n for m, n in present.rows.get("month", {}).items() if m in kept}
    folders = kept | {m: [name] for m in rows}
    return commit(spark, root, Snapshot(present.number + 1, schema, {"month": folders}, {"month": counts | rows}))


def month_rows(spark: SparkSession, root: str, months: list[str] | None = None) -> DataFrame:
    """The rows of a table written by :func:`replace_months_at_once`, of all months or of some (``yyyyMM``)."""
    return read_parts(spark, root, read_snapshot(spark, root), "month", months)
