"""Sharding by longest processing time: groups of equal texts, largest first, to the least-loaded shard.

The schedule runs on a heap on the driver over a bounded number of entries. Groups larger than 1/``grain`` of a shard's
fair share are scheduled one by one: by arithmetic there are at most ``shards * grain`` of them. Smaller groups are
summarised in size classes (64 to each doubling of size, a few thousand at most); a class is dealt out in one heap round
after another, and its groups take their turn in order of size. The difference that dealing leaves in a class is at most
the width of the class, and the widths sum up to less than the largest small group.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farmledger.llm.registry import register, table
from farmledger.llm.scratch import keep

ROW_OVERHEAD = 16
ROWS_A_BLOCK = 100_000  # rows that are numbered by one task


def schedule(large: list[tuple[str, int]], classes: list[tuple[int, int, int]], shards: int) -> tuple[dict[str, int], list[tuple[int, int, int, int]]]:
    """Longest processing time first.

    ``large``: (group, size). ``classes``: (class, number of groups, total size). Returns the shard of each large group,
    and for each class rows (class, first turn, turns, shard): groups whose turn lies in the range go to that shard.
    """
    heap = [(0.0, s) for s in range(shards)]
    placed = {}
    for group, size in sorted(large, key=lambda x: (-x[1], x[0])):
        load, shard = heap[0]
        placed[group] = shard
        heapq.heapreplace(heap, (load + size, shard))
    dealt = []
    for name, count, total in sorted(classes, reverse=True):
        mean, left = total / count, count
        # level the loads first: whole runs of groups to shards that lie below the level, then one round-robin turn each
        quota = [0] * shards
        loads = sorted(heap)
        level = _level([load for load, _ in loads], total)
        for load, shard in loads:
            quota[shard] = min(left, max(0, int((level - load) / mean)))
            left -= quota[shard]
        heap = [(load + quota[shard] * mean, shard) for load, shard in loads]
        heapq.heapify(heap)
        for _ in range(left):  # fewer than the number of shards
            load, shard = heap[0]
            quota[shard] += 1
            heapq.heapreplace(heap, (load + mean, shard))
        dealt += _turns(name, quota)
    return placed, dealt


def _level(loads: list[float], total: float) -> float:
    """Height to which ``total`` fills the ascending ``loads``."""
    filled = 0.0
    for k, load in enumerate(loads):
        nxt = loads[k + 1] if k + 1 < len(loads) else float("inf")
        if filled + (nxt - load) * (k + 1) >= total:
            return load + (total - filled) / (k + 1)
        filled += (nxt - load) * (k + 1)
    return loads[-1]


def _turns(name: int, quota: list[int]) -> list[tuple[int, int, int, int]]:
    """Deal in rounds: in each round every shard with quota left takes one group, so neighbours in size are spread.

    Rounds with the same takers are one stretch (class, first turn, round length, rounds, place in the round, shard).
    """
    out, first, done = [], 0, 0
    for height in sorted({q for q in quota if q}):
        takers = [s for s, q in enumerate(quota) if q >= height]
        rounds = height - done
        out += [(name, first, len(takers), rounds, place, shard) for place, shard in enumerate(takers)]
        first += len(takers) * rounds
        done = height
    return out


def shard_documents(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", grain: int = 256) -> DataFrame:
    """Assign every document to a shard so that the shards' bytes are nearly equal and equal texts stay together.

    Returns (id_col, size, text_crc32, law, shard, slot, grown_shard), one row for each input row. A document's size is
    the UTF-8 bytes of its text plus 16; a null text counts as the empty one and is grouped with it. ``slot`` numbers a
    shard's rows from 0 without gaps. ``law`` is ``bytes``; ``grown_shard`` is null, as that law promises nothing for
    another number of shards. A group larger than a shard's fair share stays whole and takes a shard of its own. Repeated
    ids and rows are separate rows; an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = keep(
        docs.select(
            F.col(id_col),
            (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
            F.crc32(text).cast("long").alias("text_crc32"),
            F.sha2(text, 256).alias("_group"),
        ),
        "shard-rows",
    )
    groups = keep(rows.groupBy("_group").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")), "shard-groups")
    total = groups.agg(F.sum("_bytes")).first()[0] or 0
    bound = max(total / (shards * grain), 1)
    large = [(r[0], r[1]) for r in groups.where(F.col("_bytes") > bound).select("_group", "_bytes").collect()]  # at most shards * grain
    size_class = F.floor(F.log2(F.col("_bytes")) * 64)
    small = groups.where(F.col("_bytes") <= bound).withColumn("_class", size_class)
    classes = [tuple(r) for r in small.groupBy("_class").agg(F.count(F.lit(1)), F.sum("_bytes")).collect()]  # some thousands
    placed, dealt = schedule(large, classes, shards)

    # a class may hold most groups: its groups are ranked in blocks of equal hash, offset by the blocks before them
    blocks = max(1, -(-groups.count() // ROWS_A_BLOCK))
    turn = ranked(small.withColumn("_block", F.pmod(F.xxhash64("_group"), F.lit(blocks))), ["_class"], "_block", ["_bytes", "_group"], "_turn")
    stretches = spark.createDataFrame(dealt, "c long, first long, width long, rounds long, place long, shard int")
    by_turn = turn.join(
        F.broadcast(stretches),  # at most classes x shards x shards rows, whatever the corpus
        (F.col("_class") == F.col("c"))
        & (F.col("_turn") >= F.col("first"))
        & (F.col("_turn") < F.col("first") + F.col("width") * F.col("rounds"))
        & ((F.col("_turn") - F.col("first")) % F.col("width") == F.col("place")),
    ).select("_group", "shard")
    one_by_one = spark.createDataFrame(list(placed.items()), "_group string, shard int")
    assigned = rows.join(by_turn.unionByName(one_by_one), "_group")
    row_blocks = max(1, -(-rows.count() // (ROWS_A_BLOCK * shards)))
    slots = ranked(
        assigned.withColumn("_block", F.pmod(F.xxhash64(id_col, "_group"), F.lit(row_blocks))), ["shard"], "_block", [id_col, "_group"], "slot"
    )
    return slots.select(
        id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def ranked(df: DataFrame, key: list[str], block: str, order: list[str], name: str) -> DataFrame:
    """Number the rows of each key from 0 without gaps, one task for each (key, block) instead of each key."""
    counts = df.groupBy(*key, block).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*key, block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*key, block).orderBy(*order)
    numbered = df.withColumn("_inside", F.row_number().over(inside) - 1)
    return numbered.join(offsets, [*key, block]).withColumn(name, (F.col("_offset") + F.col("_inside")).cast("long"))


@register("op10_sharding")
def op10_sharding(spark: SparkSession, directory: str) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes."""
    return shard_documents(table(spark, directory, "documents"))
