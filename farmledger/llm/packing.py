"""Packing by cutting-stock column generation.

Every document is cut into full sequences and one remainder. Remainders are rounded up to size classes; the histogram of
the classes (its size depends on the sequence length alone) states a cutting-stock problem. Its linear program is solved
over patterns: the master program prices the classes, an unbounded knapsack by dynamic programming finds the pattern that
is worth most at these prices, until none is worth more than one sequence. Solutions are rounded down, what is left over is
filled first-fit decreasing. Remainders are ranked in their class and take the places of the patterns by their rank.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farmledger.llm.registry import register, table
from farmledger.llm.scratch import keep
from farmledger.llm.sharding import ROWS_A_BLOCK, ranked
from farmledger.llm.tokens import WordTokenizer

SEQUENCE, UNIT, END = 4096, 16, 2


def knapsack(prices: np.ndarray, widths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best pattern at the given prices: value and count of each class (unbounded knapsack over capacities)."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1, dtype=np.int64)
    for room in range(1, capacity + 1):
        fits = widths <= room
        value = np.where(fits, prices + best[np.where(fits, room - widths, 0)], -1.0)
        k = int(np.argmax(value)) if len(value) else -1
        best[room] = best[room - 1]
        if k >= 0 and value[k] > best[room] + 1e-12:
            best[room], choice[room] = value[k], k
    pattern, room = np.zeros(len(widths), dtype=np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
            continue
        pattern[choice[room]] += 1
        room -= widths[choice[room]]
    return float(best[capacity]), pattern


def column_generation(widths: np.ndarray, demand: np.ndarray, capacity: int, tolerance: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and their fractional multiplicities that cover the demand with fewest sequences.

    Revised simplex with the basis kept as its inverse: the start basis is one class a pattern, each step brings in the
    pattern that the knapsack finds at the current prices. The loop ends at the optimum within the tolerance, or after a
    number of steps that grows with the classes; every basis on the way covers the demand.
    """
    n = len(widths)
    basis = np.diag(capacity // widths).astype(float)
    inverse = np.linalg.inv(basis)
    steps = 0
    while steps < 50 * n + 1000:
        prices = np.ones(n) @ inverse
        value, pattern = knapsack(np.maximum(prices, 0), widths, capacity)
        if value <= 1 + tolerance:
            break
        pattern = pattern * (prices > 0)
        levels, direction = inverse @ demand, inverse @ pattern
        ratio = np.where(direction > 1e-9, np.maximum(levels, 0) / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(np.argmin(ratio))
        if not np.isfinite(ratio[leave]):
            break
        basis[:, leave] = pattern
        row = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, row)
        inverse[leave] = row
        steps += 1
        if steps % 200 == 0:
            inverse = np.linalg.inv(basis)
    return basis.astype(np.int64), np.maximum(np.linalg.solve(basis, demand), 0)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Patterns as (widths, counts, number of sequences) that hold exactly the items of a histogram of widths."""
    widths = np.array(sorted(w for w, c in histogram.items() if c), dtype=np.int64)
    left = np.array([histogram[w] for w in widths.tolist()], dtype=np.int64)
    out = []

    def use(pattern: np.ndarray, times: int) -> None:
        taken = pattern > 0
        out.append((widths[taken], pattern[taken].astype(np.int64), int(times)))
        left[:] -= pattern * times

    if len(widths):
        patterns, levels = column_generation(widths, left.astype(float), capacity)
        for k in np.argsort(-levels):
            taken = patterns[:, k] > 0
            times = min(int(levels[k] + 1e-7), int((left[taken] // patterns[taken, k]).min()) if taken.any() else 0)
            if times > 0:
                use(patterns[:, k], times)
    while left.any():  # fewer rounds than patterns times items: the fractions that rounding left
        pattern, room = np.zeros(len(widths), dtype=np.int64), capacity
        for k in range(len(widths) - 1, -1, -1):
            pattern[k] = min(left[k], room // widths[k])
            room -= pattern[k] * widths[k]
        taken = pattern > 0
        use(pattern, int((left[taken] // pattern[taken]).min()))
    return out


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str, text: str, length: int, end: int) -> DataFrame:
    """Pieces of at most ``length`` tokens of every document: (id_col, start, length, ids_crc32, doc_tokens)."""
    source = docs.select(F.col(id_col), F.col(text).cast("string").alias("text"))
    kind = dict(source.dtypes)[id_col]
    closing = np.array([end], dtype="<u4").tobytes()

    def cut(batches):
        words = WordTokenizer(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                rows = batch.slice(low, 256)
                place, start, size, crc, total = [], [], [], [], []
                for k, ids in enumerate(words.encode(rows.column(1).fill_null("").to_pylist())):
                    ids += closing
                    n = len(ids) // 4
                    for s in range(0, n, length):
                        place.append(k)
                        start.append(s)
                        size.append(min(length, n - s))
                        crc.append(zlib.crc32(ids[4 * s : 4 * (s + length)]))
                        total.append(n)
                arrays = [pa.array(x, pa.int64()) for x in (start, size, crc, total)]
                yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(place, pa.int64())), *arrays], [id_col, "start", "length", "ids_crc32", "doc_tokens"])

    return source.mapInArrow(cut, f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", length: int = SEQUENCE, unit: int = UNIT, end: int = END) -> DataFrame:
    """Pack all documents into sequences of at most ``length`` tokens.

    Returns (id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row a piece. A document is its ids and
    the end id; it is cut every ``length`` tokens and its remainder shares a sequence with other remainders. A null or
    empty text is the end id alone. Sequence numbers begin at 0 and have no gaps; offsets in a sequence neither. Repeated
    ids and rows are documents of their own, an empty table gives no piece, other columns are not read.
    """
    spark = docs.sparkSession
    pieces = keep(token_pieces(docs, tokenizer, id_col, text, length, end), "packing-pieces")
    classes = pieces.withColumn("_width", F.when(F.col("length") < length, F.ceil(F.col("length") / unit)).otherwise(F.lit(0)))
    histogram = {int(r[0]): int(r[1]) for r in classes.groupBy("_width").agg(F.count(F.lit(1))).collect()}  # length / unit rows
    full = histogram.pop(0, 0)
    stretches, base, first = [], full, dict.fromkeys(histogram, 0)
    for widths, counts, times in plan(histogram, length // unit):
        for w, c in zip(widths.tolist(), counts.tolist(), strict=True):
            stretches.append((w, first[w], first[w] + c * times, c, base))
            first[w] += c * times
        base += times

    blocks = max(1, -(-(full + sum(histogram.values())) // ROWS_A_BLOCK))
    dealt = classes.withColumn("_block", F.pmod(F.xxhash64(id_col, "start", "ids_crc32"), F.lit(blocks)))
    order = [F.desc("length"), F.col(id_col), F.col("start"), F.col("ids_crc32")]
    turn = ranked(dealt, ["_width"], "_block", order, "_turn")
    places = spark.createDataFrame([(0, 0, full, 1, 0), *stretches], "w long, lo long, hi long, each long, base long")
    placed = turn.join(
        F.broadcast(places),  # at most classes x patterns rows, whatever the corpus
        (F.col("_width") == F.col("w")) & (F.col("_turn") >= F.col("lo")) & (F.col("_turn") < F.col("hi")),
    ).withColumn("sequence_id", F.expr("base + (_turn - lo) div each"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "_width", "_turn").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
    )


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register("op3_packing")
def op3_packing(spark: SparkSession, directory: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return pack(table(spark, directory, "documents"), public_tokenizer())
