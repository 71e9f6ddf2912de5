"""Benchmark decontamination with an FM-index for each shard of the training texts.

A shard is a chunk of documents in one task. Its words are mapped to symbols: 1 ends a text or stands for a stretch that
cannot matter, 2 and up are the words of the benchmark. A stretch of benchmark words shorter than the shortest window
cannot hold one, so it becomes a single 1; what is left is indexed. The index is the Burrows-Wheeler transform of the
symbols, a wavelet tree over it that answers rank queries, and the positions of sampled suffixes. All windows of a
benchmark block are searched backwards together, one word at a time; the occurrences of those that are left are located by
stepping to a sampled suffix, and become spans of words that are merged for each document.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farmledger.llm.registry import register, table
from farmledger.llm.textcore import LOWER, byte_table, covered, per_text, runs, span_hashes, text_chunks

# Words are runs of digits, a-z and every byte of a code point beyond ASCII, after A-Z is lower-cased.
WORD_BYTES = byte_table(b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))
WINDOW = 10
SAMPLE = 8
BLOCK_WORDS = 1_000_000  # benchmark words that are searched in one pass over the documents; bounds what is sent to a task


@dataclass
class Wavelet:
    """Wavelet tree over symbols below 2**levels, as one bit array with prefix counts for each level."""

    levels: int
    ones: list[np.ndarray]
    zeros: list[int]

    @staticmethod
    def build(symbols: np.ndarray, levels: int) -> Wavelet:
        ones, zeros = [], []
        for k in reversed(range(levels)):
            bit = (symbols >> k) & 1
            ones.append(np.concatenate([[0], np.cumsum(bit)]))
            zeros.append(int(len(bit) - ones[-1][-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])  # stable: zeros first, then ones
        return Wavelet(levels, ones, zeros)

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each end."""
        begin = np.zeros_like(end)
        for k, ones, zeros in zip(reversed(range(self.levels)), self.ones, self.zeros, strict=True):
            bit = (symbol >> k) & 1
            begin = np.where(bit == 1, zeros + ones[begin], begin - ones[begin])
            end = np.where(bit == 1, zeros + ones[end], end - ones[end])
        return end - begin


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1
    step = 1
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[: max(n - step, 0)] = rank[step:]
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]]))
        if n == 0 or rank[order[-1]] == n:
            return order
        step *= 2


class FmIndex:
    """FM-index of integer symbols; the last symbol must be smaller than all others and occur once."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        order = suffix_array(symbols)
        self.bwt = symbols[order - 1]
        self.tree = Wavelet.build(self.bwt, max(1, int(symbols.max()).bit_length()))
        counts = np.bincount(symbols)
        self.below = np.concatenate([[0], np.cumsum(counts)])
        self.size = len(symbols)
        kept = order % sample == 0
        self.sampled = np.concatenate([[0], np.cumsum(kept)])
        self.positions = order[kept]

    def _step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.below[symbol] + self.tree.rank(symbol, at)

    def search(self, phrases: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of suffixes that begin with each phrase; phrases are rows, padded at the right, of the given length."""
        count = len(phrases)
        low, high = np.zeros(count, dtype=np.int64), np.full(count, self.size, dtype=np.int64)
        live = np.arange(count)
        for back in range(1, int(length.max(initial=0)) + 1):
            turn = live[length[live] >= back]
            symbol = phrases[turn, length[turn] - back]
            known = symbol < len(self.below) - 1
            low[turn[~known]] = high[turn[~known]] = 0
            turn, symbol = turn[known], symbol[known]
            low[turn], high[turn] = self._step(symbol, low[turn]), self._step(symbol, high[turn])
            live = live[low[live] < high[live]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position of each suffix, by stepping back to a sampled one."""
        found, at, steps, live = np.zeros(len(rows), dtype=np.int64), rows.copy(), 0, np.arange(len(rows))
        while len(live):
            here = at[live]
            hit = self.sampled[here + 1] > self.sampled[here]
            found[live[hit]] = self.positions[self.sampled[here[hit]]] + steps
            live, here = live[~hit], here[~hit]
            at[live] = self._step(self.bwt[here], here)
            steps += 1
        return found


@dataclass
class Block:
    """A bounded part of the benchmark, ready for search."""

    vocabulary: np.ndarray  # sorted word hashes; word k is symbol k + 2
    phrases: np.ndarray  # distinct windows as rows of symbols, zeros behind short ones
    length: np.ndarray
    owners: list[tuple[str, ...]]  # of each window the ids of the items that hold it
    shortest: int


def benchmark_words(text: str | None) -> np.ndarray:
    """Hashes of the words of a text."""
    data = LOWER[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    starts, ends = runs(WORD_BYTES[data], np.array([0, len(data)]))
    return span_hashes(data, starts, ends)


def make_block(items: list[tuple[str | None, np.ndarray]], window: int) -> Block:
    vocabulary = np.unique(np.concatenate([w for _, w in items]))
    pieces, owner = [], []
    for k, (_, words) in enumerate(items):
        symbols = np.searchsorted(vocabulary, words) + 2
        if len(symbols) < window:
            symbols = np.concatenate([symbols, np.zeros(window - len(symbols), dtype=np.int64)])
        pieces.append(np.lib.stride_tricks.sliding_window_view(symbols, window))
        owner.append(np.full(len(pieces[-1]), k))
    # equal windows are searched and located once, however many items hold them
    phrases, place = np.unique(np.concatenate(pieces), axis=0, return_inverse=True)
    held = np.unique(np.column_stack([place.ravel(), np.concatenate(owner)]), axis=0)
    at = np.searchsorted(held[:, 0], np.arange(len(phrases) + 1))
    names = [items[k][0] for k in held[:, 1].tolist()]
    owners = [tuple({n for n in names[x:y] if n is not None}) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    length = (phrases > 0).sum(axis=1)
    return Block(vocabulary, phrases, length, owners, int(length.min()))


def _occurrences(block: Block, words: np.ndarray, word_offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts (in words of the chunk), lengths and windows of all occurrences of windows."""
    at = np.minimum(np.searchsorted(block.vocabulary, words), len(block.vocabulary) - 1)
    known = block.vocabulary[at] == words
    starts, ends = runs(known, word_offsets)
    long = ends - starts >= block.shortest
    starts, ends = starts[long], ends[long]
    none = np.zeros(0, dtype=np.int64)
    if len(starts) == 0:
        return none, none, none
    size = ends - starts
    # stretches end to end, a 1 after each, a 0 at the end of the shard
    base = np.cumsum(size + 1) - (size + 1)
    inside = np.repeat(starts - base, size) + (np.arange(size.sum()) + np.repeat(np.arange(len(size)), size))
    symbols = np.ones(int((size + 1).sum()) + 1, dtype=np.int64)
    symbols[np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)] = at[inside] + 2
    symbols[-1] = 0
    index = FmIndex(symbols)
    low, high = index.search(block.phrases, block.length)
    count = high - low
    which = np.repeat(np.arange(len(count)), count)
    rows = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
    position = index.locate(rows)
    stretch = np.searchsorted(base, position, side="right") - 1
    return position - base[stretch] + starts[stretch], block.length[which], which


def benchmark_blocks(benchmark: DataFrame, item_id: str, item_text: str, window: int, block_words: int) -> list[Block]:
    """The benchmark in blocks of at most ``block_words`` words (or one item); an item without an id is named None."""
    blocks, items, held = [], [], 0
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).cast("string").alias("t"))
    for r in rows.where("t IS NOT NULL").toLocalIterator():
        words = benchmark_words(r.t)
        if len(words) == 0:
            continue
        if items and held + len(words) > block_words:
            blocks.append(make_block(items, window))
            items, held = [], 0
        items.append((r.i, words))
        held += len(words)
    if items:
        blocks.append(make_block(items, window))
    return blocks


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Occurrences of benchmark windows in every document.

    Returns (id_col, n_words, n_hit, n_items, items_sha256, contaminated, spans, items), one row for each input row:
    ``spans`` are the merged [start, end) word ranges that occurrences cover, ``items`` the ids (as sorted texts) of items
    with an occurring window. A document or item text that is null, empty or without words has none. An item without an
    id is searched as well: its windows count in ``spans``, ``n_hit`` and ``contaminated``, but ``items`` has no id to
    list. An item shorter than the window is one window; equal items and repeated ids count once in ``items``. Repeated documents are separate rows; other
    columns are not read. The benchmark is read in blocks of ``block_words`` words; each block is searched by a step of its
    own, which hands the documents on with what was found so far.
    """
    source = docs.select(F.col(id_col), F.col(text).cast("string").alias("text"))
    id_type = dict(source.dtypes)[id_col]
    found_type = "spans array<struct<first: long, last: long>>, items array<string>"
    spans_arrow, items_arrow = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])), pa.list_(pa.string())

    def search(df: DataFrame, block: Block | None, last: bool) -> DataFrame:
        def found(batches):
            for rows, data, offsets in text_chunks(batches, "text"):
                data = LOWER[data]
                starts, ends = runs(WORD_BYTES[data], offsets)
                at = np.searchsorted(starts, offsets)
                first = stop = which = np.zeros(0, dtype=np.int64)
                if block is not None:
                    first, length, which = _occurrences(block, span_hashes(data, starts, ends), at)
                    stop = first + length
                text_of = np.searchsorted(at, first, side="right") - 1
                names: list[set[str]] = [set() for _ in range(rows.num_rows)]
                for d, w in np.unique(np.column_stack([text_of, which]), axis=0).tolist():
                    names[d].update(block.owners[w])
                if rows.num_columns > 2:  # what earlier blocks have found
                    for d, (earlier, items) in enumerate(zip(rows.column(2).to_pylist(), rows.column(3).to_pylist(), strict=True)):
                        names[d].update(items)
                        first = np.append(first, [x["first"] + at[d] for x in earlier]).astype(np.int64)
                        stop = np.append(stop, [x["last"] + at[d] for x in earlier]).astype(np.int64)
                hit = covered(len(starts), first, stop)
                low, high = runs(hit, at)
                spans: list[list[dict]] = [[] for _ in range(rows.num_rows)]
                for d, x, y in zip((np.searchsorted(at, low, side="right") - 1).tolist(), low.tolist(), high.tolist(), strict=True):
                    spans[d].append({"first": x - int(at[d]), "last": y - int(at[d])})
                ordered = [sorted(n) for n in names]
                tail = [pa.array(spans, spans_arrow), pa.array(ordered, items_arrow)]
                if not last:
                    yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *tail], [id_col, "text", "spans", "items"])
                    continue
                n_hit = per_text(hit, at)
                digests = [hashlib.sha256(",".join(n).encode()).hexdigest() for n in ordered]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0), pa.array(np.diff(at).astype(np.int64)), pa.array(n_hit), pa.array([len(n) for n in ordered], pa.int64()),
                        pa.array(digests, pa.string()), pa.array(n_hit > 0), *tail,
                    ],
                    [id_col, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "items"],
                )

        middle = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean" if last else "text string"
        return df.mapInArrow(found, f"`{id_col}` {id_type}, {middle}, {found_type}")

    blocks = benchmark_blocks(benchmark, item_id, item_text, window, block_words)
    for block in blocks[:-1]:
        source = search(source, block, False)
    return search(source, blocks[-1] if blocks else None, True)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without any occurrence of a benchmark window, with all their columns; items need no id."""

    def hit(block: Block):
        @F.arrow_udf(T.BooleanType())
        def occurs(column: pa.Array) -> pa.Array:
            out = [np.zeros(0, dtype=bool)]
            for _, data, offsets in text_chunks([pa.RecordBatch.from_arrays([column], ["text"])], "text"):
                data = LOWER[data]
                starts, ends = runs(WORD_BYTES[data], offsets)
                at = np.searchsorted(starts, offsets)
                first, _, _ = _occurrences(block, span_hashes(data, starts, ends), at)
                found = np.zeros(len(offsets) - 1, dtype=bool)
                found[np.searchsorted(at, first, side="right") - 1] = True
                out.append(found)
            return pa.array(np.concatenate(out))

        return occurs

    for block in benchmark_blocks(benchmark, item_id, item_text, window, block_words):
        docs = docs.where(~hit(block)(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return docs


@register("op4_decontamination")
def op4_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    """All documents searched for all benchmark items."""
    found = contaminated_spans(table(spark, directory, "documents"), table(spark, directory, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
