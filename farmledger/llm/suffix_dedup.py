"""Suffix-array deduplication of byte strings by merging Burrows-Wheeler transforms.

Every byte that lies in a string of ``length`` bytes which also starts earlier is removed.

1. Each text is cut into stretches of string starts that share a minimizer: the smallest hash of the 32-byte substrings of a
   string. Equal strings have equal minimizers, so a stretch whose minimizer occurs nowhere else needs no further work, and
   stretches can be dealt out by minimizer without parting equal strings. Equal whole texts are one class before that.
2. A task takes the stretches of some minimizers in batches, sorts the suffixes of small shards and keeps their transforms.
   The shards are merged by refining their interleave: from classes of suffixes with h equal first bytes and the h-th power of
   the last-to-first mapping come classes for 2h bytes. Within a shard the suffixes stay in order, so a round only merges.
   Where neighbours are still in one class after ``length`` bytes, their common prefix is that long: a repeated interval.
3. A minimizer with very many stretches is dealt to several tasks. What a task leaves of it is dealt again by whole strings.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farmledger.llm.registry import register, table
from farmledger.llm.scratch import keep
from farmledger.llm.sharding import ROWS_A_BLOCK, ranked
from farmledger.llm.textcore import SpanHasher, covered, mix, per_text, runs, text_chunks

LENGTH, SEED = 100, 32
STRETCH = 256  # string starts in one stretch, at most
HOT = 4096  # stretches of one minimizer in one task, about
BATCH_BYTES, SHARD_BYTES = 1_000_000, 125_000


def _slide(values: np.ndarray, window: int, combine) -> np.ndarray:
    """Minimum or maximum of each run of ``window`` values."""
    width = 1
    while 2 * width <= window:
        values = combine(values[:-width], values[width:])
        width *= 2
    return combine(values[: -(window - width)], values[window - width :]) if width < window else values


def stretches(data: np.ndarray, offsets: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimizer, first and last string start of each stretch, and whether it may repeat itself, for the texts of a chunk."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none.astype(bool)
    hasher = SpanHasher(data)
    count = len(data) - seed + 1
    seeds = mix((hasher.total[seed:] - hasher.total[:count]) * hasher.down[:count])
    window = length - seed + 1
    least = _slide(seeds, window, np.minimum)
    # the strings that begin in a text and end in it
    valid = np.zeros(len(least) + 1, dtype=np.int64)
    size = np.diff(offsets)
    fits = size >= length
    np.add.at(valid, offsets[:-1][fits], 1)
    np.add.at(valid, offsets[1:][fits] - length + 1, -1)
    valid = np.cumsum(valid)[:-1] > 0
    change = np.ones(len(least), dtype=bool)
    change[1:] = least[1:] != least[:-1]
    change[offsets[:-1][fits]] = True
    first = np.flatnonzero(valid & change)
    if len(first) == 0:
        return none.astype(np.uint64), none, none, none.astype(bool)
    ends = np.zeros(len(least), dtype=bool)
    ends[:-1] = change[1:] | ~valid[1:]
    ends[-1] = True
    last = np.flatnonzero(valid & ends)
    parts = (last - first) // STRETCH + 1
    if (parts > 1).any():
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.repeat(first, parts) + STRETCH * within
        last = np.minimum(np.repeat(last, parts), begin + STRETCH - 1)
        first = begin
    # a stretch that holds its minimizer twice may repeat itself: minimizers that follow each other within a window
    most = _slide(np.concatenate([np.zeros(window - 1, np.uint64), least, np.zeros(window - 1, np.uint64)]), window, np.maximum)
    chosen = np.flatnonzero(seeds == most)
    twice = (seeds[chosen[1:]] == seeds[chosen[:-1]]) & (chosen[1:] - chosen[:-1] <= window)
    return least[first], first, last, np.isin(least[first], seeds[chosen[1:][twice]])


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of spans end to end, and their offsets."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    return data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], size)], offsets


class Shard:
    """A text of pieces, each closed by a mark of its own, as its suffix array and Burrows-Wheeler transform."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        pieces = len(offsets) - 1
        at = np.arange(len(data)) + np.repeat(np.arange(pieces), np.diff(offsets))
        self.symbols = np.zeros(len(data) + pieces, dtype=np.int64)
        self.symbols[at] = data.astype(np.int64) + pieces
        self.symbols[offsets[1:] + np.arange(pieces)] = np.arange(pieces)
        self.pieces = pieces
        self.order = self._sorted()
        self.bwt = self.symbols[self.order - 1]
        # last-to-first mapping from the transform alone: occurrences of a symbol keep their order
        self.back = np.empty(len(self.bwt), dtype=np.int64)
        self.back[np.argsort(self.bwt, kind="stable")] = np.arange(len(self.bwt))

    def _sorted(self) -> np.ndarray:
        bits = int(self.pieces + 256).bit_length()
        step = max(1, 60 // bits)
        n = len(self.symbols)
        rank = np.zeros(n, dtype=np.int64)
        for k in range(step):
            rank <<= bits
            rank[: n - k] |= self.symbols[k:]
        while True:
            order = np.argsort(rank)
            ordered = rank[order]
            new = np.empty(n, dtype=np.int64)
            new[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
            if new[order[-1]] == n - 1:
                return order
            rank = new * (n + 1)
            rank[: n - step] += new[step:] + 1
            step *= 2


def interleave(shards: list[Shard], length: int) -> list[np.ndarray]:
    """Classes of the suffixes of each shard, in its order: equal for suffixes with the same first ``length`` bytes.

    Suffixes that reach a mark within that length are alone in their class.
    """
    marks = np.cumsum([0] + [s.pieces for s in shards])
    classes = []
    for k, s in enumerate(shards):
        first = s.symbols[s.order]
        classes.append(np.where(first < s.pieces, first + marks[k], first - s.pieces + marks[-1]))
    cuts = np.cumsum([len(s.order) for s in shards])[:-1]
    powers = {1: [s.back for s in shards]}

    def refine(ahead: list[np.ndarray]) -> None:
        nonlocal classes
        top = max(int(c[-1]) for c in classes) + 2
        keys = []
        for c, b in zip(classes, ahead, strict=True):
            later = np.empty_like(c)
            later[b] = c  # the suffix that starts so many bytes earlier is continued by this one
            keys.append(c * top + later)
        key = np.concatenate(keys)
        merged = np.argsort(key, kind="stable")  # each shard's keys ascend: runs are merged, not sorted anew
        ordered = key[merged]
        out = np.empty(len(key), dtype=np.int64)
        out[merged] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        classes = np.split(out, cuts)

    h = 1
    while 2 * h <= length:
        refine(powers[h])
        powers[2 * h] = [b[b] for b in powers[h]]
        h *= 2
    rest = length - h
    if rest:
        steps = [np.arange(len(s.order)) for s in shards]
        for p, back in powers.items():
            if rest & p:
                steps = [b[x] for b, x in zip(back, steps, strict=True)]
        refine(steps)
    return classes


def repeated(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """For each byte of the pieces, whether the string that starts there also starts earlier.

    ``rank`` orders the bytes: of equal strings the one with the lowest rank is the first; equal ranks are one place.
    """
    cuts = [0]
    while cuts[-1] < len(offsets) - 1:
        at = int(np.searchsorted(offsets, offsets[cuts[-1]] + SHARD_BYTES, side="right")) - 1
        cuts.append(max(at, cuts[-1] + 1))
    shards, places = [], []
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        shard = Shard(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        shards.append(shard)
        size = np.diff(offsets[low : high + 1]) + 1
        byte = np.arange(size.sum()) - np.repeat(np.arange(high - low), size) + offsets[low]
        byte[np.cumsum(size) - 1] = -1  # marks
        places.append(byte[shard.order])
    classes, place = np.concatenate(interleave(shards, length)), np.concatenate(places)
    count = np.bincount(classes)
    several = (count[classes] > 1) & (place >= 0)
    classes, place = classes[several], place[several]
    first = np.full(len(count), np.iinfo(np.int64).max)
    np.minimum.at(first, classes, rank[place])
    out = np.zeros(len(data), dtype=bool)
    out[place[rank[place] > first[classes]]] = True
    return out


RANGES = "num long, low int, high int, key long, piece binary"


def _resolve(batches, length: int):
    """Rows (key, hot, num, start, piece) in order of key: emit ranges to remove, and the strings left of hot keys."""

    def solve(rows: pa.Table):
        key, hot = rows.column("key").to_numpy(), rows.column("hot").to_numpy(zero_copy_only=False)
        num, start = rows.column("num").to_numpy(), rows.column("start").to_numpy().astype(np.int64)
        column = rows.column("piece").combine_chunks().cast(pa.large_binary())
        bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]
        offsets = bounds - bounds[0]
        strings = np.diff(offsets) - length + 1
        # equal stretches of a key: the first stands for all, the others repeat it string by string
        hashes = SpanHasher(data)(offsets[:-1], offsets[1:])
        order = np.lexsort((start, num, hashes, key))
        same = (key[order][1:] == key[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
        later = order[1:][same]
        # equal number and start is the same place (a repeated row), which repeats nothing
        lead = order[np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(order)), 0))]
        twin = np.zeros(len(key), dtype=bool)
        twin[later] = True
        whole = later[(num[later] != num[lead[1:][same]]) | (start[later] != start[lead[1:][same]])]
        emit = [(num[whole], start[whole], start[whole] + strings[whole])]
        left = np.flatnonzero(~twin)
        # a stretch alone under its key can only repeat itself, which takes a seed twice
        alone = np.ones(len(left), dtype=bool)
        k = key[left]
        alone[1:] &= k[1:] != k[:-1]
        alone[:-1] &= k[1:] != k[:-1]
        quiet = np.flatnonzero(alone)
        if len(quiet):
            part, at = gather(data, offsets[left[quiet]], offsets[left[quiet] + 1])
            inside = np.arange(len(part)) + length <= np.repeat(at[1:], np.diff(at))
            where = np.flatnonzero(inside)
            owner = np.searchsorted(at, where, side="right") - 1
            string = mix(SpanHasher(part)(where, where + length) + owner.astype(np.uint64))
            twice = np.unique(string, return_inverse=True, return_counts=True)
            loud = np.unique(owner[twice[2][twice[1]] > 1])
            alone[quiet[loud]] = False
        work = left[~alone]
        part, at = gather(data, offsets[work], offsets[work + 1])
        if len(part):
            places = np.repeat(start[work] - at[:-1], np.diff(at)) + np.arange(len(part))
            numbers = np.repeat(num[work], np.diff(at))
            by = np.lexsort((places, numbers))
            new = np.concatenate([[0], (numbers[by][1:] != numbers[by][:-1]) | (places[by][1:] != places[by][:-1])])
            rank = np.empty(len(part), dtype=np.int64)
            rank[by] = np.cumsum(new)
            again = repeated(part, at, rank, length)
            low, high = runs(again, at)
            emit.append((numbers[low], places[low], places[low] + high - low))
        rest_num, rest_at, rest_key, rest_piece = [], [], [], None
        burning = np.flatnonzero(hot[left])
        if len(burning):
            part2, at2 = gather(data, offsets[left[burning]], offsets[left[burning] + 1])
            where = np.flatnonzero(np.arange(len(part2)) + length <= np.repeat(at2[1:], np.diff(at2)))
            owner = left[burning][np.searchsorted(at2, where, side="right") - 1]
            place = start[owner] + where - at2[np.searchsorted(at2, where, side="right") - 1]
            if len(part):
                gone = set(zip(numbers[again].tolist(), places[again].tolist(), strict=True))
                kept = np.array([(n, p) not in gone for n, p in zip(num[owner].tolist(), place.tolist(), strict=True)], dtype=bool)
                where, owner, place = where[kept], owner[kept], place[kept]
            rest_num, rest_at = num[owner], place
            rest_key = SpanHasher(part2)(where, where + length).view(np.int64)
            body, cut = gather(part2, where, where + length)
            rest_piece = pa.Array.from_buffers(pa.large_binary(), len(where), [None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(body)])
        n, a, b = (np.concatenate(x) for x in zip(*emit, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(n), pa.array(a.astype(np.int32)), pa.array((b + length - 1).astype(np.int32)), pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.binary())],
            ["num", "low", "high", "key", "piece"],
        )
        if rest_piece is not None and len(rest_num):
            yield pa.RecordBatch.from_arrays(
                [pa.array(rest_num), pa.array(rest_at.astype(np.int32)), pa.nulls(len(rest_num), pa.int32()), pa.array(rest_key), rest_piece.cast(pa.binary())],
                ["num", "low", "high", "key", "piece"],
            )

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        while batch.num_rows > at:
            take = min(4096, batch.num_rows - at)
            part = batch.slice(at, take)
            at += take
            held.append(part)
            size += part.column(part.schema.get_field_index("piece")).nbytes
            if size >= BATCH_BYTES:
                rows = pa.Table.from_batches(held)
                key, salt = rows.column("key").to_numpy(), rows.column("salt").to_numpy()
                same = (key == key[-1]) & (salt == salt[-1])
                cut = len(key) - int(same.sum())  # the last key may go on in the next rows
                if cut:
                    yield from solve(rows.slice(0, cut))
                    held = rows.slice(cut).to_batches()
                    size = sum(b.column(b.schema.get_field_index("piece")).nbytes for b in held)
    if held:
        yield from solve(pa.Table.from_batches(held))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Remove every byte covered by a string of ``length`` bytes that also starts earlier.

    Returns (id_col, n_bytes, n_removed, n_spans, kept_sha256, spans), one row for each input row; ``spans`` are the removed
    [low, high) byte ranges. "Earlier" is a smaller id, or the same text and an earlier start; strings are judged on the
    input. A null text is empty. A null id comes before all others. Rows with the same id and text are one document and get
    the same result; texts that share an id are ordered by their SHA-256. Other columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    source = source.withColumn("sha", F.sha2("text", 256))
    signed = keep(source.select("id", "sha", F.octet_length("text").cast("long").alias("n_bytes")), "repeats-texts")
    names = signed.select("id", "sha").distinct()
    low = F.lit(-(1 << 63)).cast("long")
    counts = names.agg(F.count(F.lit(1)), F.countDistinct(F.coalesce("id", low))).first()
    number = F.coalesce("id", low)
    if counts[0] != counts[1]:  # an id with several texts: number the documents in order
        blocks = max(1, counts[0] // ROWS_A_BLOCK)
        by_range = names.withColumn("_order", number).repartitionByRange(blocks, "_order", "sha")
        placed = keep(by_range.withColumn("_block", F.spark_partition_id()).withColumn("_all", F.lit(0)), "repeats-names")
        numbers = ranked(placed, ["_all"], "_block", ["_order", "sha"], "num").select("id", "sha", "num")
        numbers = keep(numbers, "repeats-numbers").select(F.col("id").alias("_id"), F.col("sha").alias("_sha"), "num")
        source, signed = (
            d.join(numbers, d["id"].eqNullSafe(F.col("_id")) & (d["sha"] == F.col("_sha"))).drop("_id", "_sha") for d in (source, signed)
        )
    else:
        source, signed = source.withColumn("num", number), signed.withColumn("num", number)
    first = signed.groupBy("sha").agg(F.min("num").alias("lead"))

    # 1. stretches whose minimizer occurs more than once
    def cut(batches):
        for batch, data, offsets in text_chunks(batches, "text"):
            v, a, b, inner = stretches(data, offsets, length, seed)
            more = np.where(inner, -1 - (b - a), b - a)  # negative: it may repeat itself
            owner = np.searchsorted(offsets, a, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(v.view(np.int64)), batch.column(0).take(pa.array(owner)), pa.array((a - offsets[owner]).astype(np.int32)), pa.array(more.astype(np.int16))],
                ["key", "num", "start", "more"],
            )

    cuts = source.select("num", "text").mapInArrow(cut, "key long, num long, start int, more short")
    counted = cuts.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("df > 1 OR more < 0")
    leads = first.select(F.col("lead").alias("num"))
    listed = counted.join(leads, "num", "left_semi").groupBy("num").agg(F.collect_list(F.struct("key", F.col("df").cast("int").alias("df"), "start", "more")).alias("cuts"))
    texts = source.select("num", "text").join(listed, "num")
    texts = keep(texts, "repeats-candidates")

    # 2. merge transforms for each minimizer
    def pieces(batches):
        for batch, data, offsets in text_chunks(batches, "text"):
            lists = batch.column(2)
            at = lists.offsets.to_numpy().astype(np.int64)
            rows = lists.flatten()
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
            start = rows.field("start").to_numpy().astype(np.int64)
            more = rows.field("more").to_numpy().astype(np.int64)
            more = np.where(more < 0, -1 - more, more)
            low = offsets[owner] + start
            for k in range(0, len(low), 20_000):
                part = slice(k, k + 20_000)
                body, cut = gather(data, low[part], low[part] + more[part] + length)
                piece = pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(body)])
                yield pa.RecordBatch.from_arrays(
                    [rows.field("key")[part], rows.field("df")[part], batch.column(0).take(pa.array(owner[part])), rows.field("start")[part], piece],
                    ["key", "df", "num", "start", "piece"],
                )

    cut_out = texts.select("num", "text", "cuts").mapInArrow(pieces, "key long, df int, num long, start int, piece binary")
    split = F.ceil(F.col("df") / HOT)
    dealt = cut_out.select("key", F.pmod(F.xxhash64("num"), split).cast("int").alias("salt"), (split > 1).alias("hot"), "num", "start", "piece")
    solved = dealt.repartition(F.col("key"), F.col("salt")).sortWithinPartitions("key", "salt").mapInArrow(lambda b: _resolve(b, length), RANGES)
    solved = keep(solved, "repeats-ranges")

    # 3. what is left of hot minimizers, by whole strings
    again = solved.where("piece IS NOT NULL").select("key", F.lit(0).alias("salt"), F.lit(False).alias("hot"), "num", F.col("low").alias("start"), "piece")
    strings = again.repartition("key").sortWithinPartitions("key").mapInArrow(lambda b: _resolve(b, length), RANGES)
    ranges = solved.where("piece IS NULL").unionByName(strings).groupBy("num").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))

    # 4. what remains of each text
    def removed(batches):
        for batch, data, offsets in text_chunks(batches, "text"):
            lists = batch.column(2)
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(lists.offsets.to_numpy()))
            rows = lists.flatten()
            gone = covered(len(data), offsets[owner] + rows.field("low").to_numpy(), offsets[owner] + rows.field("high").to_numpy())
            low, high = runs(gone, offsets)
            at = np.searchsorted(low, offsets)
            spans = pa.StructArray.from_arrays(
                [pa.array(x.astype(np.int64)) for x in (low - np.repeat(offsets[:-1], np.diff(at)), high - np.repeat(offsets[:-1], np.diff(at)))], ["low", "high"]
            )
            digests = [hashlib.sha256(data[a:b][~gone[a:b]].tobytes()).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(per_text(gone, offsets)), pa.array(digests, pa.string()), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), spans)],
                ["lead", "gone", "left_sha", "parts"],
            )

    changed = texts.select("num", "text").join(ranges, "num").mapInArrow(removed, "lead long, gone long, left_sha string, parts array<struct<low: long, high: long>>")
    changed = changed.dropDuplicates(["lead"])  # repeated rows give equal results
    rows = signed.join(first, "sha").join(changed, "lead", "left")
    copy = (F.col("num") != F.col("lead")) & (F.col("n_bytes") >= length)
    own = (F.col("num") == F.col("lead")) & F.col("gone").isNotNull()
    none = F.array().cast("array<struct<low: long, high: long>>")
    spans = F.when(copy, F.array(F.struct(F.lit(0).cast("long").alias("low"), F.col("n_bytes").alias("high")))).when(own, F.col("parts")).otherwise(none)
    return rows.select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.when(copy, F.col("n_bytes")).when(own, F.col("gone")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).when(own, F.col("left_sha")).otherwise(F.col("sha")).alias("kept_sha256"),
        spans.alias("spans"),
    )


@register("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, directory: str) -> DataFrame:
    """All documents without the bytes of strings of 100 bytes that occur earlier."""
    return remove_repeats(table(spark, directory, "documents")).drop("spans")
