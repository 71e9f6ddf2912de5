"""Table sinks. A path that may still be read is never overwritten in place."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farmledger.functions.calendar import in_month_range


def full_reload(df: DataFrame, table: str, path: str) -> str:
    """Replace the whole content of an external Parquet table; see :func:`safe_overwrite`."""
    return safe_overwrite(df, table, path)


def append(df: DataFrame, table: str, path: str) -> None:
    """Append ``df`` by column name to an external Parquet table, creating it when absent."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df = df.select(*spark.table(table).columns)
    df.write.format("parquet").mode("append").option("path", path).saveAsTable(table)


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def safe_overwrite(df: DataFrame, table: str, root: str) -> str:
    """Replace a table's content with ``df``, which may itself read that table.

    The rows go to a new version folder first; the catalog then points the table at it in one metadata step, so a
    failure at any moment leaves the previous version readable. Where the columns change, the table's entry is dropped and
    made anew, and for the moment between the two it is absent; the data of both versions stay. Earlier versions stay for
    readers under way until :func:`drop_old_versions` removes them.
    """
    spark = df.sparkSession
    version = f"{root.rstrip('/')}/version-{uuid.uuid4().hex}"
    df.write.parquet(version)
    if spark.catalog.tableExists(table) and _columns(spark.table(table)) == _columns(df):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=version, source="parquet")
    spark.catalog.refreshTable(table)
    return version


def _months(lo: dt.date, hi: dt.date) -> list[str]:
    first, last = lo.year * 12 + lo.month - 1, hi.year * 12 + hi.month - 1
    return [f"{m // 12:04d}{m % 12 + 1:02d}" for m in range(first, last + 1)]


def _point_partitions(spark: SparkSession, table: str, column: str, version: str, touched: list[str], written: set[str]) -> None:
    """Tell the catalog where each touched partition lies now; those without rows are dropped."""
    present = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    for value in touched:
        name, place = f"PARTITION ({column}='{value}')", f"'{version}/{column}={value}'"
        if value in written and value in present:
            spark.sql(f"ALTER TABLE {table} {name} SET LOCATION {place}")
        elif value in written:
            spark.sql(f"ALTER TABLE {table} ADD {name} LOCATION {place}")
        elif value in present:
            spark.sql(f"ALTER TABLE {table} DROP {name}")
    spark.catalog.refreshTable(table)


def _write_partitions(df: DataFrame, column: str, version: str) -> set[str]:
    """Write one folder a partition value, sized by the data and not by the value; returns the values written."""
    df.hint("rebalance", column).write.partitionBy(column).parquet(version)
    rows = df.sparkSession.read.schema(df.schema).parquet(version).select(F.col(column).cast("string")).distinct()
    return {r[0] for r in rows.collect()}  # at most the partitions touched


def replace_months(
    spark: SparkSession, table: str, source: DataFrame, date_col: str | Column, lo: dt.date, hi: dt.date, root: str
) -> str:
    """Replace the months ``lo``..``hi`` of a table partitioned by ``month`` (``yyyyMM``) and touch no other month.

    Only the new months are written, to a fresh folder; the catalog is then told where each month lies: months without a
    partition are added, those with one are moved, those without source rows are dropped. A month is readable, old or
    new, at every moment, and a run that failed half-way is completed by running it again. ``date_col`` is a date or a
    timestamp; it stays bare, so that the bounds can reach the scan.
    """
    date_col = F.col(date_col) if isinstance(date_col, str) else date_col
    version = f"{root.rstrip('/')}/version-{uuid.uuid4().hex}"
    fresh = source.where(in_month_range(date_col, lo, hi)).withColumn("month", F.date_format(date_col, "yyyyMM"))
    fresh = fresh.select(*spark.table(table).columns)
    written = _write_partitions(fresh, "month", version)
    _point_partitions(spark, table, "month", version, _months(lo, hi), written)
    return version


def merge_partitions(
    spark: SparkSession, table: str, changes: DataFrame, keys: list[str], merge: Callable[[DataFrame | None, DataFrame], DataFrame],
    root: str, buckets: int = 64,
) -> str:
    """Merge changes by key into a table partitioned by a hash of the key; partitions without a change are not touched.

    ``merge`` makes the new rows of the touched partitions from their present rows (None for a first load) and the changes.
    A key's rows lie in one of ``buckets`` partitions, a number that is fixed when the table is first written. Touched
    partitions are written to a fresh folder and the catalog is pointed at them, as in :func:`replace_months`.
    """
    version = f"{root.rstrip('/')}/version-{uuid.uuid4().hex}"
    if not spark.catalog.tableExists(table):
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        first = merge(None, changes).withColumn("key_bucket", bucket)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in first.schema.fields)
        written = _write_partitions(first, "key_bucket", version)
        properties = f"TBLPROPERTIES ('key_buckets'='{buckets}')"
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (key_bucket) {properties} LOCATION '{root.rstrip('/')}/base'")
        _point_partitions(spark, table, "key_bucket", version, sorted(written), written)
        return version
    buckets = int(spark.sql(f"SHOW TBLPROPERTIES {table}('key_buckets')").first()[1])
    target = spark.table(table)
    types = {f.name: f.dataType for f in target.schema.fields}
    bucket = F.pmod(F.xxhash64(*[F.col(k).cast(types[k]) for k in keys]), F.lit(buckets)).cast("int")
    touched = [r[0] for r in changes.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        return version
    present = target.where(F.col("key_bucket").isin(touched)).drop("key_bucket")
    fresh = merge(present, changes).withColumn("key_bucket", bucket).select(*target.columns)
    written = _write_partitions(fresh, "key_bucket", version)
    _point_partitions(spark, table, "key_bucket", version, [str(b) for b in touched], written)
    return version


def detached(spark: SparkSession, table: str) -> DataFrame:
    """The rows of an external table as files, without partition columns; the table leaves the catalog."""
    rows = spark.table(table)
    parts = {c.name for c in spark.catalog.listColumns(table) if c.isPartition}
    kept = [f for f in rows.schema.fields if f.name not in parts]
    files = rows.inputFiles()
    spark.sql(f"DROP TABLE {table}")
    schema = StructType(kept)
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def drop_old_versions(spark: SparkSession, table: str, root: str, older_than: dt.timedelta) -> list[str]:
    """Remove version folders below ``root`` that the table refers to no longer and that are older than given.

    The age protects readers that opened the table before its last switch.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    used = set()
    if spark.catalog.tableExists(table):
        for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
            if row[0] == "Location":
                used.add(row[1].rstrip("/").rsplit("/", 1)[-1])
        if any(c.isPartition for c in spark.catalog.listColumns(table)):
            for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
                spec = ", ".join(f"{k}='{v}'" for k, v in (p.split("=", 1) for p in row[0].split("/")))
                for line in spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec})").collect():
                    if line[0] == "Location":
                        used.update(line[1].rstrip("/").split("/")[-2:])
    before = (dt.datetime.now(dt.timezone.utc) - older_than).timestamp() * 1000
    gone = []
    for status in files.listStatus(path) if files.exists(path) else []:
        name = status.getPath().getName()
        if name.startswith("version-") and name not in used and status.getModificationTime() < before:
            files.delete(status.getPath(), True)
            gone.append(name)
    return gone
