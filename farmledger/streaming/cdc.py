"""Change files applied as they land."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from farmledger.operators.merge import cdc_apply
from farmledger.sources.ledger import load_changes
from farmledger.sources.sinks import merge_partitions


def cdc_stream(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    table: str,
    root: str,
    keys: Sequence[str],
    flag: str,
    order_col: str,
    checkpoint: str,
    archive: str | None = None,
    initial: str = "all_but_deletes",
) -> StreamingQuery:
    """Merge every change file in ``landing`` into ``table`` and stop; files are archived when ``archive`` is given.

    A micro-batch that is repeated after a failure finds its changes applied already and yields the same table, because
    the last change of a key wins and the merge replaces rows by key.
    """
    reader = spark.readStream.schema(schema).format("parquet")
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)

    def merge(batch: DataFrame, batch_id: int) -> None:
        apply_changes(batch.sparkSession, table, batch, list(keys), flag, root, initial, order_col)

    return (
        reader.load(landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ledger_stream(
    spark: SparkSession, landing: str, schema: StructType, root: str, keys: Sequence[str], flag: str, order_col: str, checkpoint: str,
    **options,
) -> StreamingQuery:
    """Apply every change file in ``landing`` to the ledger below ``root`` (:mod:`farmledger.sources.ledger`) and stop.

    Files may land late or twice: a change counts only when its order value is higher than that of the key's last change,
    deletes included, so the ledger does not depend on how files fall into micro-batches.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        load_changes(batch.sparkSession, root, batch, keys, flag, order_col, **options)

    reader = spark.readStream.schema(schema).format("parquet").load(landing)
    return reader.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def apply_changes(
    spark: SparkSession, table: str, changes: DataFrame, keys: list[str], flag: str, root: str,
    initial: str = "all_but_deletes", order_col: str | None = None, buckets: int = 64,
) -> str:
    """Merge a set of changes into a ledger partition by partition; applying the same set again changes nothing.

    An insert whose key the ledger holds already is the repeat of an earlier load and counts as an update. With
    ``order_col`` a change of a key that the ledger holds counts only from the key's order value on; the order of deletes is
    kept by :func:`farmledger.sources.ledger.load_changes` only.
    """

    def merged(target: DataFrame | None, rows: DataFrame) -> DataFrame:
        if target is not None:
            if order_col is not None:
                held = target.groupBy(*keys).agg(F.max(order_col).alias("__held"))
                rows = rows.join(held, keys, "left").where(F.col("__held").isNull() | (F.col(order_col) >= F.col("__held"))).select(*rows.columns)
            insert = F.upper(F.trim(F.col(flag))) == "I"
            rows = rows.withColumn(flag, F.when(insert, F.lit("U")).otherwise(F.col(flag)))
        return cdc_apply(target, rows, keys, flag, initial=initial, order_col=order_col)

    return merge_partitions(spark, table, changes, keys, merged, root, buckets)
