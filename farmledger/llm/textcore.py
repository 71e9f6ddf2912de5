"""Vectorised helpers over the UTF-8 bytes of a text column, used inside Arrow tasks.

A chunk is a run of rows of a record batch whose texts together stay under a byte limit (one row may exceed it), so the
memory of a task is bounded by the limit or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4_000_000
_GOLD = 0x9E3779B97F4A7C15
_INVERSE = pow(_GOLD, -1, 1 << 64)


def byte_table(members: bytes) -> np.ndarray:
    """Boolean table over the 256 byte values."""
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


# Words are runs of anything but blank, tab, LF, VT, FF, CR.
NOT_BLANK = ~byte_table(b" \t\n\x0b\x0c\r")
# A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Yield (rows, bytes, offsets): the rows as a batch, their texts' bytes end to end, and where each text begins.

    A null text is an empty one.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()).fill_null("")
        buffers = column.buffers()
        offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        row = 0
        while row < len(column):
            end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
            end = min(max(end, row + 1), len(column))
            yield batch.slice(row, end - row), data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            row = end


def runs(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true positions; a run never crosses a text."""
    inner = offsets[1:-1]
    before = np.zeros(len(member), dtype=bool)
    before[1:] = member[:-1]
    before[inner[inner < len(member)]] = False
    starts = np.flatnonzero(member & ~before)
    after = np.zeros(len(member), dtype=bool)
    after[:-1] = member[1:]
    after[inner[inner > 0] - 1] = False
    return starts, np.flatnonzero(member & ~after) + 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_GOLD))


class _Cache(dict):
    """Arrays that every process makes for itself: they are not sent along with the functions that use them."""

    def __reduce__(self):
        return _Cache, ()


_POWERS = _Cache()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    held = len(_POWERS.get("up", ()))
    if held < n:
        size = max(n, 2 * held, 1 << 16)  # as long as the chunks that the process meets, so small inputs keep little
        for name, base in (("up", _GOLD), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps, out=steps)
    return _POWERS["up"], _POWERS["down"]


class SpanHasher:
    """64-bit hashes of byte spans: a polynomial over random byte values, equal for equal bytes wherever they stand."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.total = np.zeros(len(data) + 1, dtype=np.uint64)
        sums = self.total[1:]  # worked on in place: the arrays have eight times the size of the texts
        np.take(_BYTE_VALUES, data, out=sums, mode="clip")
        sums *= up[: len(data)]
        np.cumsum(sums, out=sums)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return SpanHasher(data)(starts, ends)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words, beginning at each word (the caller discards runs that cross texts)."""
    count = max(len(words) - n + 1, 0)
    out = np.zeros(count, dtype=np.uint64)
    for k in range(n):
        out *= np.uint64(_GOLD)
        out += words[k : k + count]
    return mix(out)


def covered(length: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Boolean array of the positions that lie in any [start, end)."""
    steps = np.zeros(length + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a per-position array over each [offset, next offset)."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
