"""Periodic runs of words, by longest common extensions on a difference cover.

A run is a stretch of consecutive words with smallest period q, at least ``max(24, 3 * q)`` words long, that no neighbouring
word extends with period q.

1. The words of a chunk of texts become numbers, equal for equal words; every text ends with a number of its own, so no
   comparison leaves its text.
2. Of all suffixes only those at positions of a difference cover are sorted: any two positions meet the cover together within
   ``MODULUS`` words. They get names by their first ``MODULUS`` words, then names of doubled length until all differ. The
   names of each length give the common prefixes of neighbours, and a sparse table their range minima.
3. A longest common extension compares the few words up to the next common cover position, then asks for one range minimum.
   Extensions to the left use the reversed words.
4. For each period q, positions a grid step apart (the step grows with q, so the grids of all periods together are a harmonic
   sum) are compared with those q words on. Every run covers a grid position whose two words are equal; its extensions to
   both sides give start and length. Of equal stretches the smallest period is kept.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from farmledger.llm.registry import register, table
from farmledger.llm.textcore import NOT_BLANK, SpanHasher, covered, runs, text_chunks

MIN_WORDS, MIN_PERIODS = 24, 3
# A perfect difference set; every difference modulo 31 is that of two members.
MODULUS, COVER = 31, (0, 1, 3, 8, 12, 18)
PAIRS_AT_ONCE = 1_000_000
SCHEMA = "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _cover_shift() -> np.ndarray:
    """For residues a, b the smallest shift d such that a + d and b + d are both in the cover."""
    member = np.isin(np.arange(MODULUS), COVER)
    shift = np.full((MODULUS, MODULUS), MODULUS, dtype=np.int64)
    for d in reversed(range(MODULUS)):
        here = np.roll(member, -d)
        shift[np.ix_(here, here)] = d
    return shift


SHIFT = _cover_shift()


class CommonExtension:
    """Longest common prefixes of suffixes of a sequence of numbers, by cover-sampled suffixes.

    The sequence must end with a number that stands nowhere else; then no two suffixes are equal.
    """

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        self.words = np.concatenate([words, np.full(MODULUS + 1, -1, words.dtype)])
        member = np.zeros(MODULUS, dtype=bool)
        member[list(COVER)] = True
        at = np.flatnonzero(member[np.arange(self.n) % MODULUS])
        self.sample = np.full(self.n + MODULUS + 1, -1, dtype=np.int64)  # position to sample
        self.sample[at] = np.arange(len(at))
        after = self.sample[np.minimum(at + MODULUS, self.n)]  # the sample one block on; -1 behind the end
        levels = [(self._blocks(at), after)]
        while True:
            name, jump = levels[-1]
            if len(name) == 0 or name.max() == len(name) - 1:
                break
            # a doubled name: of the suffix, then of the one as far on as the name reaches
            pair = (name + 1) * (len(name) + 1) + np.where(jump >= 0, name[jump] + 1, 0)
            doubled = np.unique(pair, return_inverse=True)[1]
            levels.append((doubled, np.where(jump >= 0, jump[jump], -1)))
        self.order = np.argsort(levels[-1][0], kind="stable")
        self.rank = np.empty(len(at), dtype=np.int64)
        self.rank[self.order] = np.arange(len(at))
        self._minima(self._neighbours(at, levels))

    def _blocks(self, at: np.ndarray) -> np.ndarray:
        """Names, in order, of the first ``MODULUS`` words of the sampled suffixes, three words to a sort key."""
        width = max(int(self.n), 1).bit_length() + 1
        a_key = max(1, 62 // width)
        dense = np.unique(self.words, return_inverse=True)[1]
        keys = []
        for low in range(0, MODULUS, a_key):
            key = np.zeros(len(at), dtype=np.int64)
            for k in range(low, min(low + a_key, MODULUS)):
                key = (key << width) | dense[at + k]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(at), dtype=bool)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        name = np.empty(len(at), dtype=np.int64)
        name[order] = np.cumsum(new)
        return name

    def _neighbours(self, at: np.ndarray, levels: list) -> np.ndarray:
        """Common prefix of each sampled suffix with the one before it in order, from the longest names to the words."""
        i, j = self.order[:-1].copy(), self.order[1:].copy()
        out = np.zeros(len(i), dtype=np.int64)
        for level in reversed(range(len(levels))):
            name, jump = levels[level]
            live = np.flatnonzero((i >= 0) & (j >= 0))
            same = live[name[i[live]] == name[j[live]]]
            out[same] += MODULUS << level
            i[same], j[same] = jump[i[same]], jump[j[same]]
        live = np.flatnonzero((i >= 0) & (j >= 0))
        out[live] += self._few(at[i[live]], at[j[live]], np.full(len(live), MODULUS))
        return out

    def _minima(self, common: np.ndarray) -> None:
        self.table = [common]
        width = 1
        while 2 * width <= len(common):
            row = self.table[-1]
            self.table.append(np.minimum(row[: len(row) - width], row[width:]))
            width *= 2

    def _few(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Number of equal words from i and j on, ``limit`` at most."""
        out = limit.copy()
        live = np.arange(len(i))
        for k in range(int(limit.max(initial=0))):
            live = live[limit[live] > k]
            differ = self.words[i[live] + k] != self.words[j[live] + k]
            out[live[differ]] = k
            live = live[~differ]
            if len(live) == 0:
                break
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Longest common prefixes of the suffixes at i and at j; i and j differ, the number of words has no suffix."""
        shift = SHIFT[i % MODULUS, j % MODULUS]
        out = self._few(i, j, shift)
        on = np.flatnonzero(out == shift)
        a, b = self.sample[i[on] + shift[on]], self.sample[j[on] + shift[on]]
        inside = (a >= 0) & (b >= 0)
        on, a, b = on[inside], self.rank[a[inside]], self.rank[b[inside]]
        if len(on) == 0:
            return out
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        least = np.empty(len(on), dtype=np.int64)
        for k in np.unique(level):
            here = level == k
            row = self.table[k]
            least[here] = np.minimum(row[low[here]], row[high[here] - (1 << k)])
        out[on] += least
        return out


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Dense numbers of words, equal for equal bytes: hashed, and every word's bytes compared with its class's."""
    if len(starts) == 0:
        return np.zeros(0, dtype=np.int64)
    _, first, number = np.unique(SpanHasher(data)(starts, ends), return_index=True, return_inverse=True)
    size, as_of = ends - starts, first[number]
    same = bool(np.all(size == size[as_of]))
    if same:
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        same = bool(np.array_equal(data[np.repeat(starts, size) + within], data[np.repeat(starts[as_of], size) + within]))
    if same:
        return number.astype(np.int64)
    seen: dict[bytes, int] = {}  # two words have one hash
    raw = data.tobytes()
    return np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], dtype=np.int64)


def grid_pairs(words: np.ndarray, first: np.ndarray, count: np.ndarray):
    """Yield arrays (position, period) of grid positions whose word stands again a period on.

    ``first`` and ``count`` give the words of each text. A run of period q holds ``max(24, 3 * q) - q`` or more consecutive
    positions whose words are equal to those q words on, so a grid of that step meets each run.
    """
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    found, size = [], 0
    for q in range(1, (int(count[0]) if len(count) else 0) // MIN_PERIODS + 1):
        shortest = max(MIN_WORDS, MIN_PERIODS * q)
        step = shortest - q
        texts = int(np.searchsorted(-count, -shortest, side="right"))
        if texts == 0:
            break
        points = (count[:texts] - q - 1) // step + 1
        if texts == 1:
            at = first[0] + np.arange(points[0]) * step
        else:
            within = np.arange(points.sum()) - np.repeat(np.cumsum(points) - points, points)
            at = np.repeat(first[:texts], points) + within * step
        at = at[words[at] == words[at + q]]
        if len(at):
            found.append((at, np.full(len(at), q)))
            size += len(at)
        if size >= PAIRS_AT_ONCE:
            yield tuple(map(np.concatenate, zip(*found, strict=True)))
            found, size = [], 0
    if found:
        yield tuple(map(np.concatenate, zip(*found, strict=True)))


def all_runs(words: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of all texts, by start, then period.

    ``words`` holds the texts one behind another, each followed by one place that it does not count.
    """
    words = words.copy()
    words[first + count] = words.max(initial=0) + 1 + np.arange(len(first))  # every text ends with a word of its own
    forward = backward = None
    out = [np.zeros((3, 0), dtype=np.int64)]
    for at, q in grid_pairs(words, first, count):
        if forward is None:
            forward, backward = CommonExtension(words), CommonExtension(words[::-1][1:])  # reversed, the first text's end is last
        right = forward(at, at + q)
        last = len(words) - 2
        left = np.zeros(len(at), dtype=np.int64)
        inner = np.flatnonzero(at > 0)
        # the suffix at x of the reversed words begins with the word before x in the texts
        left[inner] = backward(last - (at[inner] - 1), last - (at[inner] + q[inner] - 1))
        start, length = at - left, left + right + q
        long = length >= np.maximum(MIN_WORDS, MIN_PERIODS * q)
        out.append(np.unique(np.stack([start[long], length[long], q[long]]), axis=1))
    start, length, q = np.unique(np.concatenate(out, axis=1), axis=1)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])  # a longer period of the same stretch is no smallest one
    start, length, q = start[new], length[new], q[new]
    order = np.lexsort((q, start))
    return start[order], length[order], q[order]


def planted(number: np.ndarray, first: np.ndarray, count: np.ndarray, ids: list) -> np.ndarray:
    """Index of the word that stands at each place, after the rule that makes every tenth document (by a hash) periodic."""
    at = np.arange(len(number))
    for k, (name, n) in enumerate(zip(ids, count.tolist(), strict=True)):
        if name is None or n == 0:
            continue
        h = zlib.crc32(str(name).encode())
        if h % 10:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at[first[k] + a : first[k] + n] = first[k] + a + np.arange(n - a) % p
    return at


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words, each followed by a space, and where each word's bytes end (its space included)."""
    size = ends - starts + 1
    close = np.cumsum(size)
    within = np.arange(close[-1] if len(close) else 0) - np.repeat(close - size, size)
    out = data[np.minimum(np.repeat(starts, size) + within, max(len(data) - 1, 0))] if len(size) else np.zeros(0, np.uint8)
    out[close - 1] = 32
    return out, close


def describe_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """The runs of every text, and the text with each run cut to its first period.

    Returns (id_col, n_words, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256), one row for each
    input row; start to exponent_milli belong to the run with the greatest length / period (ties: smallest start, then period)
    and are null without a run. Null and empty texts have no words; repeated rows are described each; other columns are not
    read. ``plant`` first repeats words by a rule on a hash of the id (a null id: unchanged), as a test of the method on
    texts that have few runs of their own. A task's memory follows its chunk of texts or the longest single text.
    """
    names = [f.name for f in docs.select(id_col).schema]

    def described(batches):
        for batch, data, offsets in text_chunks(batches, "_text"):
            starts, ends = runs(NOT_BLANK[data], offsets)
            bounds = np.searchsorted(starts, offsets)
            count = np.diff(bounds)
            texts = len(count)
            first = bounds[:-1] + np.arange(texts)  # a place behind each text for its own end
            place = np.arange(len(starts)) + np.repeat(np.arange(texts), count)
            number = np.zeros(len(starts) + texts, dtype=np.int64)
            number[place] = word_numbers(data, starts, ends)
            source = np.arange(len(number))
            if plant:
                source = planted(number, first, count, batch.column(0).to_pylist())
                number = number[source]
            start, length, period = all_runs(number, first, count)
            owner = np.searchsorted(first, start, side="right") - 1
            start_in = start - first[owner]
            drop = covered(len(number), start + period, start + length)
            word_of = np.full(len(number), -1, dtype=np.int64)
            word_of[place] = np.arange(len(starts))
            kept = place[~drop[place]]
            word = word_of[source[kept]]
            joined, close = _joined(data, starts[word], ends[word])
            raw, close = joined.tobytes(), np.concatenate([[0], close])
            cut = close[np.searchsorted(kept, np.concatenate([first, [len(number)]]))].tolist()
            # greatest exponent: compared as fractions in whole numbers, runs being already in order of start and period
            runs_of = np.searchsorted(owner, np.arange(texts + 1)).tolist()
            rows = {name: [] for name in ("start", "length", "period", "milli", "runs", "collapsed")}
            s, z, q = start_in.tolist(), length.tolist(), period.tolist()
            for k in range(texts):
                best = None
                for r in range(runs_of[k], runs_of[k + 1]):
                    if best is None or z[r] * q[best] > z[best] * q[r]:
                        best = r
                rows["start"].append(None if best is None else s[best])
                rows["length"].append(None if best is None else z[best])
                rows["period"].append(None if best is None else q[best])
                rows["milli"].append(None if best is None else 1000 * z[best] // q[best])
                listed = "".join(f"{s[r]},{z[r]},{q[r]}\n" for r in range(runs_of[k], runs_of[k + 1]))
                rows["runs"].append(hashlib.sha256(listed.encode()).hexdigest())
                rows["collapsed"].append(hashlib.sha256(raw[cut[k] : max(cut[k + 1] - 1, cut[k])]).hexdigest())
            longs = [pa.array(rows[name], pa.int64()) for name in ("start", "length", "period", "milli")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(np.diff(runs_of), pa.int64()), *longs, pa.array(rows["runs"]), pa.array(rows["collapsed"])],
                [*names, "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
            )

    source = docs.select(docs[id_col], docs[text].cast("string").alias("_text"))
    return source.mapInArrow(described, f"`{id_col}` {source.schema[0].dataType.simpleString()}, {SCHEMA}")


@register("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, directory: str) -> DataFrame:
    """All documents, every tenth one made periodic."""
    return describe_runs(table(spark, directory, "documents"), plant=True)
