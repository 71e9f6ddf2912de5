"""Hard negatives by a vertical scan of vectors that prunes candidates dimension by dimension.

For each anchor the rows of a batch start as one bitmap. Dimensions are read column by column in the order of the anchor's
descending magnitudes. After each step a row's score lies between its partial sum plus the least and the greatest that the
remaining dimensions can add (from the columns' minima and maxima in the batch); rows that cannot enter any result leave the
bitmap. What is left after the last step has exact scores.

1. The first scan keeps each anchor's best rows of its own label, its positives.
2. Their scores set windows. The second scan keeps the best rows of other labels in each window.

Anchors go out in blocks of bounded size, one pair of scans a block; a task keeps a few rows an anchor, whatever it reads.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farmledger.llm.registry import register, table
from farmledger.llm.scratch import keep, shared_folder

SCALE = 256
LARGEST = 1 << 26  # components below this keep every score of 1,024 dimensions in 64 bits
STEP = 16  # dimensions read between two prunings
ANCHOR_NUMBERS = 1 << 21  # components of all anchors of a block together, about
BATCH_NUMBERS = 1 << 20  # components scanned at once, about
NO_ID = (1 << 63) - 1  # sorts a null id behind all others


def columns_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, labels, columns) of the rows of a batch that take part; columns are (dimension, row), absent ones 0."""
    vectors = batch.column(2)
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.values.slice(vectors.offsets[0].as_py(), int(lengths.sum()))
    values = np.floor(SCALE * flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False))
    row = np.repeat(np.arange(len(lengths)), lengths)
    bad = ~(np.abs(values) < LARGEST)  # true for what is not a number, too
    good = np.flatnonzero(np.bincount(row[bad], minlength=len(lengths)) == 0)
    out = np.zeros((int(lengths.max(initial=0)), len(lengths)))
    out[np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths), row] = np.where(bad, 0, values)
    ids = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
    return ids[good], batch.column(1).to_numpy(zero_copy_only=False)[good], out[:, good]


def slices(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    """Runs of rows of a batch with a bounded number of components, about."""
    numbers = len(batch.column(2).flatten())
    rows = max(1, batch.num_rows * BATCH_NUMBERS // max(numbers, 1))
    return [batch.slice(k, rows) for k in range(0, batch.num_rows, rows)]


class VerticalScan:
    """The columns of one batch, and what the dimensions that are still to be read can add."""

    def __init__(self, columns: np.ndarray):
        self.columns, self.whole = columns, None
        self.largest = np.abs(columns).max(initial=0)
        self.low, self.high = (columns.min(axis=1), columns.max(axis=1)) if columns.size else (np.zeros(len(columns)),) * 2

    def scores(self, anchor: np.ndarray, alive: np.ndarray) -> np.ndarray | None:
        """All scores in whole numbers where sums of floating-point products would not be exact, else nothing."""
        a = anchor[: len(self.columns)]
        if np.abs(a).sum() * self.largest < 2**53:
            return None
        if self.whole is None:
            self.whole = self.columns.astype(np.int64)
        return a.astype(np.int64) @ self.whole[: len(a), alive]

    def steps(self, anchor: np.ndarray, alive: np.ndarray):
        """Yield (partial scores of ``alive``, least rest, greatest rest); the caller sends back which rows stay."""
        size = min(len(anchor), len(self.columns))
        a = anchor[:size]
        order = np.argsort(-np.abs(a), kind="stable")
        one, other = a * self.low[:size], a * self.high[:size]
        least = np.concatenate([np.cumsum(np.minimum(one, other)[order][::-1])[::-1], [0]])
        greatest = np.concatenate([np.cumsum(np.maximum(one, other)[order][::-1])[::-1], [0]])
        partial = np.zeros(len(alive))
        for at in range(0, size, STEP):
            dims = order[at : at + STEP]
            partial = partial + a[dims] @ self.columns[np.ix_(dims, alive)]
            end = min(at + STEP, size)
            stay = yield partial, least[end], greatest[end]
            if stay is not None:
                alive, partial = alive[stay], partial[stay]
        return alive, partial


def best(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Indexes of the first ``count`` rows by descending score, then id."""
    if len(scores) > 4 * count:
        cut = np.partition(scores, len(scores) - count)[len(scores) - count]
        near = np.flatnonzero(scores >= cut)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:count]]


def _kth(values: np.ndarray, count: int) -> float:
    return np.partition(values, len(values) - count)[len(values) - count] if len(values) >= count else -np.inf


class BestRows:
    """Running best rows of one window: scores between ``low`` and ``high``."""

    def __init__(self, count: int, low: float = -np.inf, high: float = np.inf):
        self.count, self.low, self.high = count, low, high
        self.scores, self.ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def floor(self) -> float:
        return max(self.low, self.scores[-1]) if len(self.scores) >= self.count else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fit = np.flatnonzero((scores >= self.floor()) & (scores <= self.high))
        if len(fit):
            scores, ids = np.concatenate([self.scores, scores[fit].astype(np.int64)]), np.concatenate([self.ids, ids[fit]])
            order = best(scores, ids, self.count)
            self.scores, self.ids = scores[order], ids[order]

    def stay(self, partial: np.ndarray, least: float, greatest: float) -> np.ndarray:
        """Which rows can still be among the best of the window."""
        floor, lowest = self.floor(), partial + least
        sure = lowest[(lowest >= self.low) & (partial + greatest <= self.high)]
        return (partial + greatest >= max(floor, _kth(sure, self.count))) & (lowest <= self.high)


def scan_batch(scan: VerticalScan, ids: np.ndarray, anchor: np.ndarray, alive: np.ndarray, windows: list[BestRows]) -> None:
    """Bring the rows ``alive`` into the windows they belong to, reading as few columns of as few rows as the bounds allow."""
    if len(alive) == 0 or not windows:
        return
    scores = scan.scores(anchor, alive)
    steps, stay = scan.steps(anchor, alive), None
    while scores is None:
        try:
            partial, least, greatest = steps.send(stay)
        except StopIteration as end:
            alive, scores = end.value
            break
        stay = windows[0].stay(partial, least, greatest)
        for w in windows[1:]:
            stay |= w.stay(partial, least, greatest)
        if not stay.any():
            return
        if stay.all():
            stay = None
    for w in windows:
        w.add(scores, ids[alive])


def prepared(vectors: DataFrame, id_col: str, vector: str, label: str, relabel: int) -> DataFrame:
    """(id, label, vector) of the rows with a label and a vector, some of them relabelled."""
    changed = F.coalesce(F.col(id_col).cast("long") % relabel == 0, F.lit(False)) if relabel else F.lit(False)
    as_long = F.col(label).cast("long")
    return (
        vectors.where(F.col(label).isNotNull() & F.col(vector).isNotNull())
        .select(F.col(id_col).cast("long").alias("id"), F.when(changed, (as_long + 1) % 10).otherwise(as_long).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    )


def _anchor_blocks(rows: DataFrame, every: int):
    """Yield lists of (id, label, vector as whole numbers): each anchor once, in blocks of bounded size."""
    spark = rows.sparkSession
    anchors = keep(rows.where(F.col("id") % every == 0).distinct(), "negatives-anchors")
    n, longest = anchors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    blocks = max(1, -(-n * max(longest, 1) // ANCHOR_NUMBERS))
    placed = anchors.withColumn("block", F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks)))
    path = f"{shared_folder(spark)}/llm/negatives-blocks-{uuid.uuid4().hex}"
    placed.repartition("block").write.partitionBy("block").parquet(path)
    by_block = spark.read.schema("id long, label long, vector array<double>, block int").parquet(path)
    for k in range(blocks):
        block = []
        for batch in by_block.where(F.col("block") == k).select("id", "label", "vector").toArrow().to_batches():
            ids, labels, columns = columns_of(batch)
            block += list(zip(ids.tolist(), labels.tolist(), columns.T, strict=True))
        if block:
            yield block


def _first(rows: DataFrame, keys: list[str], count: int) -> DataFrame:
    """The first rows of each key by score, then id; every task's share is cut to ``count`` a key before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
    every: int = 100, positives: int = 5, negatives: int = 10, percent: tuple[int, int] = (30, 90), relabel: int = 7,
) -> DataFrame:
    """For each anchor and each of its positives the best rows of other labels whose score is a share of the positive's.

    Components become ``floor(256 * x)``; a score is the inner product of these whole numbers, higher scores come first, ties
    by smaller id. Anchors are rows whose id is divisible by ``every``; positives are the first rows of the anchor's label
    with another id. Negatives satisfy ``low * positive <= 100 * negative <= high * positive``. Returns (anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score).

    Rows with a null label, a null vector, a null or non-finite component, or one of 2^26 and more after scaling (a 64-bit
    score could not hold it) take no part. A null id is never an anchor, is not relabelled and comes last among ties. Of
    vectors of different lengths the shorter counts as filled with zeros; an empty vector scores 0. Repeated rows each take a
    place among positives and negatives; a repeated anchor is one anchor. Other columns are not read. An empty table gives
    no rows. Memory of the driver and of a task: one block of anchors, one batch of rows, a few rows an anchor.
    """
    spark = vectors.sparkSession
    rows = prepared(vectors, id_col, vector, label, relabel)
    path = f"{shared_folder(spark)}/llm/negatives-{uuid.uuid4().hex}"
    found = "anchor int, slot int, score long, id long"
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out.write.parquet(path)

    def searched(block, windows_of, same: bool):
        """Arrow function: the best rows of each anchor's windows in one task."""

        def run(batches):
            windows = [[BestRows(*w) for w in windows_of(k)] for k in range(len(block))]
            for ids, labels, columns in (columns_of(part) for batch in batches for part in slices(batch)):
                scan = VerticalScan(columns)
                groups = {x: np.flatnonzero(labels == x) if same else np.flatnonzero(labels != x) for x in {b[1] for b in block}}
                for k, (name, own, anchor) in enumerate(block):
                    alive = groups[own]
                    scan_batch(scan, ids, anchor, alive[ids[alive] != name], windows[k])
            for k, own in enumerate(windows):
                for slot, w in enumerate(own):
                    if len(w.scores):
                        size = len(w.scores)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(size, k, np.int32)), pa.array(np.full(size, slot, np.int32)), pa.array(w.scores.astype(np.int64)), pa.array(w.ids)],
                            ["anchor", "slot", "score", "id"],
                        )

        return run

    for block in _anchor_blocks(rows, every):
        near = _first(rows.mapInArrow(searched(block, lambda k: [(positives,)], True), found), ["anchor"], positives)
        links = sorted((r.anchor, r.rank, r.score, r.id) for r in near.collect())  # a few rows an anchor of the block
        spans: list[dict] = [{} for _ in block]
        for k, _, score, _ in links:
            low, high = -(-percent[0] * score // 100), percent[1] * score // 100
            if low <= high:
                spans[k].setdefault(score, (negatives, low, high))
        slots = [list(s) for s in spans]
        pairs = [(k, slots[k].index(score), block[k][0], None if name == NO_ID else name, score) for k, _, score, name in links if score in spans[k]]
        if not pairs:
            continue
        hard = _first(rows.mapInArrow(searched(block, lambda k, s=spans: list(s[k].values()), False), found), ["anchor", "slot"], negatives)
        with_positive = F.broadcast(spark.createDataFrame(pairs, "anchor int, slot int, anchor_id long, positive_id long, positive_score long"))  # a few rows an anchor of the block
        hard.join(with_positive, ["anchor", "slot"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.nullif(F.col("id"), F.lit(NO_ID)).alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        ).write.mode("append").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


ORACLE = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.q, b.q)]) AS BIGINT) AS score
    FROM whole a JOIN whole b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
    SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS rank
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
     AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10
"""


@register("op11_hard_negatives", oracle=ORACLE)
def op11_hard_negatives(spark: SparkSession, directory: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all vectors."""
    return hard_negatives(table(spark, directory, "embeddings"))
