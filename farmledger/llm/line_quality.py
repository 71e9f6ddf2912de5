"""Document quality by a linear-chain conditional random field over lines.

Every line with a word is good or bad. Its features are shares of kinds of bytes, words and repeats, cut into bins; a line's
score has weights for its own bins and for those of the lines before and behind it, and neighbouring labels have weights of
transition. Weights maximise the conditional likelihood of labelled documents' lines: expectations come from forward and
backward sums. A document's quality is the mean of its lines' marginals, weighted by their lengths, on a logistic scale.

Forward and backward sums of all texts of a chunk are prefix products of 2 x 2 matrices, doubled in reach each round; a text's
first line starts anew, so no text sees another, and a text of a million lines takes twenty rounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farmledger.llm.registry import register, table
from farmledger.llm.scratch import keep
from farmledger.llm.textcore import NOT_BLANK, SpanHasher, byte_table, runs, text_chunks

SAMPLE = 6_000  # labelled documents that the model is fitted on, at most
LINES = 64  # consecutive lines of one document in the sample, at most, from a place set by a hash
HELD_OUT, HELD_OUT_REST = 4, 2
GOOD_FROM = 0.7
ROUNDS, RATE, RIDGE = 150, 0.1, 1e-3

UPPER, LOWER, DIGITS = byte_table(bytes(range(65, 91))), byte_table(bytes(range(97, 123))), byte_table(bytes(range(48, 58)))
SYMBOLS, STOPS, LOUD = byte_table(b"#*$%&|<>@^~_=+\\{}[]/"), byte_table(b".,;:'\"()-"), byte_table(b"!?")
BEYOND = byte_table(bytes(range(128, 256)))
WORD_BYTES = UPPER | LOWER | DIGITS | BEYOND
END_STOPS = byte_table(b".!?:;\"')")

# Borders between the bins of each feature: shares of one, then counts and lengths.
SHARES = (0.0, 0.02, 0.06, 0.12, 0.25, 0.5, 0.8)
FEATURES = (
    ("upper", SHARES), ("digits", SHARES), ("symbols", SHARES), ("stops", SHARES), ("loud", SHARES), ("beyond", SHARES),
    ("lone_marks", SHARES), ("marked_ends", SHARES), ("short_words", SHARES), ("again_next", SHARES),
    ("distinct", (0.05, 0.15, 0.3, 0.5, 0.7, 0.9)), ("distinct_pairs", (0.05, 0.15, 0.3, 0.5, 0.7, 0.9, 0.99)),
    ("mean_word", (2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 9.0, 14.0)), ("words", (1.0, 2.0, 4.0, 8.0, 16.0, 64.0, 256.0)),
    ("seen", (0.5, 1.5)), ("shape", (0.5, 1.5, 2.5)),
)
WIDTHS = [len(borders) + 1 for _, borders in FEATURES]
STARTS = np.concatenate([[0], np.cumsum(WIDTHS)[:-1]])
BINS = int(sum(WIDTHS))


def _total(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[starts]


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    new = np.ones(len(o), dtype=bool)
    new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    return np.bincount(o[new], minlength=n)


def line_bins(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bins, lengths, text) of the lines with a word: one bin a feature, bytes, and the index of the text."""
    text_of_byte_end = offsets[1:]
    starts, ends = runs(data != 10, offsets)
    word_at, word_end = runs(NOT_BLANK[data], offsets)  # a word never crosses a line
    first, last = np.searchsorted(word_at, starts), np.searchsorted(word_at, ends)
    some = last > first
    starts, ends, first, last = starts[some], ends[some], first[some], last[some]
    n, length = len(starts), (ends - starts).astype(np.float64)
    words = (last - first).astype(np.float64)
    text = np.searchsorted(text_of_byte_end, starts, side="right")
    if n == 0:
        return np.zeros((0, len(FEATURES)), dtype=np.int64), length, text
    hasher = SpanHasher(data)
    hashes = hasher(word_at, word_end)
    owner = np.repeat(np.arange(n), last - first)
    size = (word_end - word_at).astype(np.float64)
    wordy = _total(WORD_BYTES[data], word_at, word_end) > 0
    marks = SYMBOLS | LOUD
    again = np.zeros(len(hashes), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    pair_hashes = hashes[pair] * np.uint64(0x9E3779B97F4A7C15) + hashes[pair + 1]
    letters = np.maximum(_total((UPPER | LOWER)[data], starts, ends), 1)
    per_word = lambda flags: np.bincount(owner, weights=flags, minlength=n) / words
    whole = hasher(word_at[first], word_end[last - 1])  # the line without blanks around it
    order = np.lexsort((np.arange(n), whole, text))
    seen = np.zeros(n)
    seen[order[1:]] = (text[order[1:]] == text[order[:-1]]) & (whole[order[1:]] == whole[order[:-1]])
    seen = np.where((seen > 0) & (words >= 3), 2.0, seen)
    values = {
        "upper": _total(UPPER[data], starts, ends) / letters,
        "digits": _total(DIGITS[data], starts, ends) / length,
        "symbols": _total(SYMBOLS[data], starts, ends) / length,
        "stops": _total(STOPS[data], starts, ends) / length,
        "loud": _total(LOUD[data], starts, ends) / length,
        "beyond": _total(BEYOND[data], starts, ends) / length,
        "lone_marks": per_word(~wordy),
        "marked_ends": per_word(marks[data[word_end - 1]] & wordy),
        "short_words": per_word(size <= 3),
        "again_next": per_word(again),
        "distinct": _distinct(owner, hashes, n) / words,
        "distinct_pairs": (_distinct(owner[pair], pair_hashes, n) + 1) / words,
        "mean_word": np.bincount(owner, weights=size, minlength=n) / words,
        "words": words,
        "seen": seen,
        "shape": UPPER[data[word_at[first]]] * 1.0 + END_STOPS[data[word_end[last - 1] - 1]] * 2.0,
    }
    bins = [np.searchsorted(borders, values[name], side="left") + at for (name, borders), at in zip(FEATURES, STARTS, strict=True)]
    return np.stack(bins, axis=1), length, text


def products(steps: np.ndarray, reach: int) -> np.ndarray:
    """Prefix products of 2 x 2 matrices, each up to a factor, over ``reach`` matrices at least."""
    out = steps / steps.max(axis=(1, 2), keepdims=True)
    width = 1
    while width < reach:
        joined = out[:-width] @ out[width:]
        out = np.concatenate([out[:width], joined / np.maximum(joined.max(axis=(1, 2), keepdims=True), 1e-300)])
        width *= 2
    return out


class LineField:
    """Weights of a linear chain with the states bad (0) and good (1); scores are those of good against bad."""

    def __init__(self, own=None, before=None, behind=None, bias: float = 0.0, change=None):
        self.own, self.before, self.behind = (np.zeros(BINS) if w is None else w for w in (own, before, behind))
        self.bias, self.change = bias, np.zeros((2, 2)) if change is None else change

    def potentials(self, bins: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Score of good for each line; ``start`` and ``end`` mark the first and last line of each text."""
        back, ahead = self.before[bins].sum(axis=1), self.behind[bins].sum(axis=1)
        out = self.bias + self.own[bins].sum(axis=1)
        out[1:] += np.where(start[1:], 0, back[:-1])
        out[:-1] += np.where(end[:-1], 0, ahead[1:])
        return np.clip(out, -30, 30)

    def marginals(self, bins: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability that each line is good, and of each pair of labels of a line and the one before it (0 for a first line)."""
        n = len(bins)
        if n == 0:
            return np.zeros(0), np.zeros((0, 2, 2))
        start, end = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
        start[1:] = text[1:] != text[:-1]
        end[:-1] = start[1:]
        reach = int(np.diff(np.append(np.flatnonzero(start), n)).max())
        node = np.exp(np.stack([np.zeros(n), self.potentials(bins, start, end)], axis=1) / 1.0)
        node /= node.max(axis=1, keepdims=True)
        node = np.maximum(node, 1e-13)
        change = np.exp(np.clip(self.change, -20, 20))
        # a matrix with equal rows forgets what came before it
        forth = np.where(start[:, None, None], node[:, None, :], change[None] * node[:, None, :])
        forward = products(forth, reach)[:, 0, :]
        back = np.ones((n, 2, 2))
        back[:-1] = np.where(end[:-1, None, None], 1.0, change.T[None] * node[1:, :, None])
        # reversed, the backward sum of a line is a product of the lines behind it
        backward = products(back[::-1], reach)[::-1][:, 0, :]
        both = forward * backward
        good = both[:, 1] / both.sum(axis=1)
        pair = np.zeros((n, 2, 2))
        pair[1:] = forward[:-1, :, None] * change[None] * (node * backward)[1:, None, :]
        pair[start] = 0
        pair /= np.maximum(pair.sum(axis=(1, 2), keepdims=True), 1e-300)
        return good, pair

    def fit(self, bins: np.ndarray, text: np.ndarray, label: np.ndarray) -> LineField:
        """Maximise the mean conditional log-likelihood of the lines' labels, less a ridge, by gradient steps with momentum."""
        n = len(bins)
        start = np.ones(n, dtype=bool)
        start[1:] = text[1:] != text[:-1]
        seen = np.zeros((n, 2, 2))
        seen[np.arange(1, n), label[:-1], label[1:]] = 1
        seen[start] = 0
        inner = np.flatnonzero(~start)

        def counts(weight: np.ndarray) -> np.ndarray:
            return np.bincount(bins.ravel(), weights=np.repeat(weight, bins.shape[1]), minlength=BINS)

        def gradient() -> np.ndarray:
            good, pair = self.marginals(bins, text)
            rest = label - good
            back, ahead = np.zeros(n), np.zeros(n)
            back[inner - 1] = rest[inner]  # the line before sees the rest of the line behind it
            ahead[inner] = rest[inner - 1]
            return np.concatenate([counts(rest), counts(back), counts(ahead), [rest.sum()], (seen - pair).sum(axis=0).ravel()]) / n

        weights = np.zeros(3 * BINS + 5)
        first, second = np.zeros_like(weights), np.zeros_like(weights)
        for k in range(1, ROUNDS + 1):
            self.own, self.before, self.behind = weights[:BINS], weights[BINS : 2 * BINS], weights[2 * BINS : 3 * BINS]
            self.bias, self.change = float(weights[3 * BINS]), weights[3 * BINS + 1 :].reshape(2, 2)
            slope = gradient() - RIDGE * weights
            first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
            weights = weights + RATE * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
        return self

    def qualities(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Of each text the mean marginal of its lines, weighted by their lengths; one half without a line."""
        bins, length, text = line_bins(data, offsets)
        return mean_marginals(self.marginals(bins, text)[0], length, text, len(offsets) - 1)


def mean_marginals(good: np.ndarray, length: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    total = np.bincount(text, weights=length, minlength=n)
    return np.where(total > 0, np.bincount(text, weights=length * good, minlength=n) / np.maximum(total, 1), 0.5)


def fit_scale(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope (not negative) of a logistic scale, by Newton steps with a small ridge."""
    w = np.array([0.0, 1.0])
    design = np.column_stack([np.ones(len(x)), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (y - p) - 0.1 * (w - [0, 1])
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + 0.1 * np.eye(2), slope)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), max(float(w[1]), 0.0)


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def held_out(id_col: str):
    """True for documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % HELD_OUT == HELD_OUT_REST, F.lit(False))


def sampled_lines(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, sample: int) -> list:
    """Rows (good, part, bins, lengths) of at most ``sample`` labelled documents, the first by a hash of the id.

    One text an id; of a text at most ``LINES`` consecutive lines, from a place set by a hash of the id.
    """
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("good"))
        .where("_id IS NOT NULL AND good IS NOT NULL").groupBy("_id").agg((F.min("good") > 0).cast("int").alias("good"))
    )
    turns = keep(known.where(~held_out("_id")).withColumn("turn", F.xxhash64("_id")), "quality-labels")
    # hashes are uniform: this share of their range holds the sample and little else, so few rows are sorted in one place
    share = min(1.0, 1.2 * sample / max(turns.count(), 1) + 1e-9)
    chosen = turns.where(F.col("turn") < int((2 * share - 1) * (1 << 63)) if share < 1 else F.lit(True)).orderBy("turn", "_id").limit(sample)
    source = docs.select(F.col(id_col), F.col(text).cast("string").alias("text"))
    # at most ``sample`` ids are sent out, so no text is shuffled to find theirs
    rows = source.join(F.broadcast(chosen), source[id_col] == F.col("_id")).select("text", "turn", "good")

    def measured(batches):
        for batch, data, offsets in text_chunks(batches, "text"):
            bins, length, owner = line_bins(data, offsets)
            at = np.searchsorted(owner, np.arange(len(offsets)))
            turn = batch.column(1).to_pylist()
            out = []
            for k in range(len(turn)):
                low, high = int(at[k]), int(at[k + 1])
                low += (turn[k] >> 8) % max(high - low - LINES + 1, 1)
                high = min(high, low + LINES)
                out.append((bins[low:high].astype(np.uint8).tobytes(), length[low:high].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array([b for b, _ in out], pa.binary()), pa.array([w for _, w in out], pa.binary())], ["turn", "good", "bins", "lengths"]
            )

    measured_rows = rows.mapInArrow(measured, "turn long, good int, bins binary, lengths binary")
    one = Window.partitionBy("turn").orderBy("bins", "lengths")  # one row an id, whatever number of texts share it
    return measured_rows.withColumn("k", F.row_number().over(one)).where("k = 1").orderBy("turn").collect()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE):
    """Arrow function from a text column to scores, fitted on at most ``sample`` labelled documents.

    The field is fitted on three quarters of them, every line labelled as its document, the logistic scale on the rest.
    Without labels of both kinds weights stay zero, and every score is the share of good labels (one half without any).
    """
    rows = sampled_lines(docs, labels, id_col, text, label, sample)
    good = np.array([r.good for r in rows], dtype=np.int64)
    part = np.array([r.turn % 4 for r in rows], dtype=np.int64)
    bins = [np.frombuffer(r.bins, dtype=np.uint8).reshape(-1, len(FEATURES)).astype(np.int64) for r in rows]
    size = np.array([len(b) for b in bins], dtype=np.int64)
    flat = np.concatenate(bins) if bins else np.zeros((0, len(FEATURES)), dtype=np.int64)
    length = np.concatenate([np.frombuffer(r.lengths) for r in rows]) if rows else np.zeros(0)
    text_of = np.repeat(np.arange(len(rows)), size)
    field, scale = LineField(), (_logit(np.array([(good.sum() + 1) / (len(good) + 2)]))[0], 0.0)
    if 0 < good.sum() < len(good):
        use = part[text_of] > 0
        field.fit(flat[use], text_of[use], good[text_of[use]])
        quality = mean_marginals(field.marginals(flat, text_of)[0], length, text_of, len(rows))
        judged = part == 0 if 0 < good[part == 0].sum() < (part == 0).sum() else np.ones(len(part), dtype=bool)
        scale = fit_scale(_logit(quality[judged]), good[judged].astype(float))

    @F.arrow_udf(T.DoubleType())
    def score(column: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for _, data, offsets in text_chunks([pa.RecordBatch.from_arrays([column], ["text"])], "text"):
            x = scale[0] + scale[1] * _logit(field.qualities(data, offsets))
            out.append(1 / (1 + np.exp(-np.clip(x, -30, 30))))
        return pa.array(np.concatenate(out), pa.float64())

    return score


def score_lines(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """Score every document's quality between 0 and 1.

    Returns (id_col, held_out, score, predicted), one row for each input row. Labels of ``held_out`` rows are never used.
    Repeated labels of a document count as their minimum, a null label or id is left out. Texts without a word (null and
    empty ones, too) have no line and get the score of one half on the logistic scale; a null id is not held out. Repeated
    rows are scored each; other columns are not read. Empty tables give no rows; without labels every score is one half.
    """
    score = fit(docs, labels, id_col, text, label, sample)
    scored = docs.select(docs[id_col], held_out(id_col).alias("held_out"), score(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD_FROM).cast("int"))


@register("op12_quality_classifier")
def op12_quality_classifier(spark: SparkSession, directory: str) -> DataFrame:
    """All documents scored by a field learned from ``labels``."""
    return score_lines(table(spark, directory, "documents"), table(spark, directory, "labels"))
