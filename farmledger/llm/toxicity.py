"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, reported speech, other. Small transducers pass the symbols on with
a factor: negation and reported speech weaken what they govern, a target in the clause strengthens it. Their composition is
one machine; it runs over each clause that holds an insult or a threat, and the score of a text comes from its clauses.
Insults are learned from labelled documents, as whole words and as stems (the first bytes of a word), with the log ratio of
their document frequencies as weight; a short fixed list serves where nothing can be learned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farmledger.llm.registry import register, table
from farmledger.llm.scratch import keep
from farmledger.llm.textcore import SpanHasher, byte_table, runs, text_chunks

LETTERS = byte_table(b"abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))
CLAUSE_ENDS = byte_table(b".,;:!?\n")
STEMS = (4, 5, 6, 7)  # bytes of a stem; 0 stands for the whole word
SAMPLE = 20_000  # labelled documents that the model is fitted on, at most
LEXICON = 4096  # learned words and stems, at most: the strongest ones
MIN_DOCS, MIN_WEIGHT = 3, 1.5
HELD_OUT = 5

# The closed classes of the grammar.
TARGETS = "you your yours yourself youre u du dich dir ihr euch tu te toi vous votre usted tú vosotros".split()
NEGATIONS = "not never no isnt arent dont nicht kein keine nie jamais nunca jamás".split()
REPORTS = "said says say called calls wrote quoted claimed sagte nannte schrieb dit écrit appelé dijo llamó escribió".split()
THREATS = "kill hurt destroy beat töten umbringen tuer frapper matar golpear".split()
INSULTS = "idiot stupid moron pathetic worthless loser scum trash disgusting clown dumb imbecile idiota estúpido imbécile dummkopf".split()
SEED_WEIGHT = 3.0

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)


class Transducer:
    """A deterministic weighted transducer: (state, symbol) to (state, factor); states are hashable, 0 is the start."""

    def __init__(self, step):
        self.step = step

    def compose(self, other: Transducer) -> Transducer:
        """Both machines read the same clause; factors multiply."""

        def step(state, symbol):
            mine, theirs = state or (0, 0)
            mine, a = self.step(mine, symbol)
            theirs, b = other.step(theirs, symbol)
            return (mine, theirs), a * b

        return Transducer(step)


def negation(reach: int = 3, factor: float = 0.2) -> Transducer:
    """An insult or threat at most ``reach`` words after a negation."""

    def step(state, symbol):
        if symbol == NEGATION:
            return reach, 1.0
        return max(state - 1, 0), factor if state and symbol in (INSULT, THREAT) else 1.0

    return Transducer(step)


def reported(factor: float = 0.4) -> Transducer:
    """Everything after a verb of reporting in the clause."""

    def step(state, symbol):
        return int(state or symbol == REPORT), factor if state and symbol in (INSULT, THREAT) else 1.0

    return Transducer(step)


def target(factor: float = 1.5) -> Transducer:
    """Insults and threats after a target; a threat counts only then."""

    def step(state, symbol):
        if symbol == THREAT:
            return state, factor if state else 0.0
        return int(state or symbol == TARGET), factor if state and symbol == INSULT else 1.0

    return Transducer(step)


def grammar() -> Transducer:
    return target().compose(negation()).compose(reported())


def clause_score(machine: Transducer, symbols: list[int], weights: list[float]) -> float:
    """Sum of the weights of a clause's insults and threats, each times its factor."""
    state, score = 0, 0.0
    for symbol, weight in zip(symbols, weights, strict=True):
        state, factor = machine.step(state, symbol)
        if weight:
            score += weight * factor
    return score


def word_hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    ends = np.cumsum([len(w) for w in raw], dtype=np.int64)
    return SpanHasher(data)(ends - [len(w) for w in raw], ends)


class Lexicon:
    """Weights of words and stems, looked up by hash."""

    def __init__(self, entries: dict[tuple[int, int], float]):
        self.tables = {}
        for length in (0, *STEMS):
            key = np.array(sorted(h for size, h in entries if size == length), dtype=np.uint64)
            if len(key):
                seen = np.zeros(1 << 16, dtype=bool)
                seen[(key & np.uint64(0xFFFF)).astype(np.int64)] = True
                self.tables[length] = (key, np.array([entries[length, h] for h in key.tolist()]), seen)

    def weigh(self, hasher: SpanHasher, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Largest weight of each word or of one of its stems; 0 for an unknown word."""
        out = np.zeros(len(starts))
        for length, (key, weight, seen) in self.tables.items():
            at = np.arange(len(starts)) if length == 0 else np.flatnonzero(ends - starts > length)
            hashes = hasher(starts[at], ends[at] if length == 0 else starts[at] + length)
            maybe = seen[(hashes & np.uint64(0xFFFF)).astype(np.int64)]
            at, hashes = at[maybe], hashes[maybe]
            place = np.minimum(np.searchsorted(key, hashes), len(key) - 1)
            hit = key[place] == hashes
            out[at[hit]] = np.maximum(out[at[hit]], weight[place[hit]])
        return out


CLOSED = {
    **dict.fromkeys(word_hashes(TARGETS).tolist(), TARGET),
    **dict.fromkeys(word_hashes(NEGATIONS).tolist(), NEGATION),
    **dict.fromkeys(word_hashes(REPORTS).tolist(), REPORT),
    **dict.fromkeys(word_hashes(THREATS).tolist(), THREAT),
}


def text_scores(lexicon: Lexicon, machine: Transducer, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text the sum of its clause scores, and the largest one."""
    starts, ends = runs(LETTERS[data], offsets)
    at = np.searchsorted(starts, offsets)
    hasher = SpanHasher(data)
    weight = lexicon.weigh(hasher, starts, ends)
    whole = hasher(starts, ends)
    threats = np.isin(whole, np.array([h for h, s in CLOSED.items() if s == THREAT], dtype=np.uint64))
    marked = np.flatnonzero((weight > 0) | threats)
    out = np.zeros((len(offsets) - 1, 2))
    if len(marked) == 0:
        return out
    text_of = np.searchsorted(at, np.arange(len(starts)), side="right") - 1
    clause = np.cumsum(CLAUSE_ENDS[data])[starts] + text_of  # differs between clauses and between texts
    first = np.searchsorted(clause, np.unique(clause[marked]))
    last = np.searchsorted(clause, clause[first], side="right")
    closed, hashes, weights = CLOSED, whole, weight
    for low, high in zip(first.tolist(), last.tolist(), strict=True):
        w = weights[low:high].tolist()
        symbols = [INSULT if x else closed.get(h, OTHER) for x, h in zip(w, hashes[low:high].tolist(), strict=True)]
        w = [SEED_WEIGHT if s == THREAT else x for s, x in zip(symbols, w, strict=True)]
        score = clause_score(machine, symbols, w)
        text = text_of[low]
        out[text, 0] += score
        out[text, 1] = max(out[text, 1], score)
    return out


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Words and stems of (text, toxic) rows whose document frequencies differ most, and the fixed list."""

    def counted(batches):
        for batch, data, offsets in text_chunks(batches, "text"):
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            starts, ends = runs(LETTERS[data], offsets)
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
            hasher = SpanHasher(data)
            for length in (0, *STEMS):
                at = np.arange(len(starts)) if length == 0 else np.flatnonzero(ends - starts > length)
                hashes = hasher(starts[at], ends[at] if length == 0 else starts[at] + length)
                order = np.lexsort((owner[at], hashes))
                h, o = hashes[order], owner[at][order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])  # a word counts once a document
                key, inverse = np.unique(h[new], return_inverse=True)
                bad = np.bincount(inverse, weights=toxic[o[new]], minlength=len(key)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), length, np.int32)), pa.array(key.view(np.int64)), pa.array(bad), pa.array(np.bincount(inverse, minlength=len(key)))],
                    ["size", "hash", "bad", "n"],
                )

    total = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    n_bad, n_good = total[0], total[1] - total[0]
    counts = rows.select("text", "toxic").mapInArrow(counted, "size int, hash long, bad long, n long").groupBy("size", "hash").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    good = F.col("n") - F.col("bad")
    ratio = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((good + 0.5) / (n_good + 1))
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (good + 0.5))
    strong = counts.where(F.col("bad") >= MIN_DOCS).withColumn("weight", ratio).withColumn("sure", ratio - error).where(F.col("sure") >= MIN_WEIGHT)
    entries = {(0, h): SEED_WEIGHT for h in word_hashes(INSULTS).tolist()}
    for r in strong.orderBy(F.desc("sure"), "size", "hash").limit(LEXICON).collect():
        entries[r["size"], r["hash"] & (1 << 64) - 1] = r["weight"]
    return Lexicon(entries)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (intercept first) of a logistic regression, by Newton steps."""
    design = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(design.shape[1])
    penalty = np.diag([1e-3] + [ridge] * (design.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (y - p) - penalty @ w
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + penalty, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(id_col: str):
    """True for documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % HELD_OUT == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE):
    """Arrow function from a lower-cased text column to scores, fitted on at most ``sample`` labelled documents.

    They are the ones that come first in the order of a hash of the id: the lexicon is learned on three quarters, the
    logistic scale on the rest. Without labels of both kinds the fixed lists and a fixed scale are used.
    """
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("toxic"))
        .where("_id IS NOT NULL AND toxic IS NOT NULL").groupBy("_id").agg(F.max("toxic").alias("toxic"))
    )
    turns = keep(known.where(~held_out("_id")).withColumn("turn", F.xxhash64("_id")), "toxicity-labels")
    # hashes are uniform: this share of their range holds the sample and little else, so few rows are sorted in one place
    share = min(1.0, 1.2 * sample / max(turns.count(), 1) + 1e-9)
    chosen = turns.where(F.col("turn") < int((2 * share - 1) * (1 << 63)) if share < 1 else F.lit(True)).orderBy("turn", "_id").limit(sample)
    source = docs.select(F.col(id_col), lowered(text).alias("text"))
    # at most ``sample`` ids are sent out, so no text is shuffled to find theirs
    sampled = source.join(F.broadcast(chosen), source[id_col] == F.col("_id")).select("text", "toxic", F.pmod("turn", F.lit(4)).alias("part"))
    rows = keep(sampled, "toxicity-sample")
    lexicon, machine = learn_lexicon(rows.where("part > 0")), grammar()

    def measured(batches):
        for batch, data, offsets in text_chunks(batches, "text"):
            x = text_scores(lexicon, machine, data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(x[:, 0]), pa.array(x[:, 1])], ["toxic", "total", "most"])

    fitted = rows.where("part = 0").select("text", "toxic").mapInArrow(measured, "toxic int, total double, most double").collect()  # a quarter of the sample
    y = np.array([r.toxic for r in fitted], dtype=float)
    scale = np.array([-2.5, 1.5, 0.5])
    if len(y) and 0 < y.sum() < len(y):
        scale = fit_logistic(_design(np.array([(r.total, r.most) for r in fitted])), y)

    @F.arrow_udf(T.DoubleType())
    def score(column: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for _, data, offsets in text_chunks([pa.RecordBatch.from_arrays([column], ["text"])], "text"):
            x = _design(text_scores(lexicon, machine, data, offsets))
            out.append(1 / (1 + np.exp(-np.clip(scale[0] + x @ scale[1:], -30, 30))))
        return pa.array(np.concatenate(out), pa.float64())

    return score


def lowered(text: str):
    return F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """Score every document between 0 and 1.

    Returns (id_col, held_out, score, predicted), one row for each input row. Labels of ``held_out`` rows are never used.
    Repeated labels of a document count as their maximum, a null label or id is left out. Null and empty texts have no
    clause and get the score of such a text; a null id is not held out. Other columns are not read.
    """
    score = fit(docs, labels, id_col, text, label, sample)
    scored = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), score(lowered(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """The documents whose score is below one half, with all their columns."""
    return docs.where(fit(docs, labels, id_col, text, label, sample)(lowered(text)) < 0.5)


def _design(x: np.ndarray) -> np.ndarray:
    return np.log1p(np.maximum(x, 0))


@register("op6_toxicity")
def op6_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    """All documents scored by a grammar learned from ``labels``."""
    return score_toxicity(table(spark, directory, "documents"), table(spark, directory, "labels"))
