"""Quality rules: divergence of a document's histograms from those of its language.

Two histograms describe a text: its characters by class, and its words by the most common words of a language (with one
bin for all others). References are the sums over all documents of a language. A document is rejected when the
Jensen-Shannon distance of either histogram to the reference exceeds a limit; texts that are too short for a histogram
are judged by the base rule only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farmledger.llm.registry import register, table
from farmledger.llm.scratch import keep
from farmledger.llm.textcore import NOT_BLANK, byte_table, covered, mix, ngram_hashes, per_text, runs, span_hashes, text_chunks

SYMBOLS = byte_table(b"#*$%&|<>")
# Character classes of bytes; bytes of other code points count as letters, so that every script is one class.
CLASSES = ("lower", "upper", "digit", "stop", "symbol", "blank")
CLASS_OF = np.zeros(256, dtype=np.int64)
CLASS_OF[65:91] = 1
CLASS_OF[48:58] = 2
CLASS_OF[list(b"!\"'(),-.:;?[]_`{}")] = 3
CLASS_OF[list(b"#*$%&|<>@/\\^~+=")] = 4
CLASS_OF[:33] = 5
CLASS_OF[127] = 5

TOP_WORDS = 64
MIN_CHARS, MIN_WORDS = 100, 50
# Largest distances to the language (0 to 1), set on labelled documents: clean texts above the length guards stay below.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.3, 0.45
HASH_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _texts(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one text."""
    return mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _counts(data: np.ndarray, offsets: np.ndarray, window: int = 8) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Base counts of each text, and the hash and the text of each word."""
    texts = len(offsets) - 1
    inside = NOT_BLANK[data]
    starts, ends = runs(inside, offsets)
    at = np.searchsorted(starts, offsets)
    n_words = np.diff(at)
    owner = np.repeat(np.arange(texts), n_words)
    leading = (data & 0xC0) != 0x80
    words = span_hashes(data, starts, ends)

    # lines with a word, beyond the first of equal ones
    line_end = np.flatnonzero(data == 10)
    bounds = np.unique(np.concatenate([offsets[:-1], line_end + 1, offsets[-1:]]))
    line_start, line_stop = bounds[:-1], bounds[1:].copy()
    ends_with_break = data[line_stop - 1] == 10 if len(line_stop) else np.zeros(0, bool)
    line_stop -= ends_with_break
    first_word = np.searchsorted(starts, line_start)
    has_word = first_word < np.searchsorted(starts, line_stop)
    line_start, line_stop = line_start[has_word], line_stop[has_word]
    line_owner = np.searchsorted(offsets, line_start, side="right") - 1
    lines = np.bincount(line_owner, minlength=texts)
    keys = _texts(span_hashes(data, line_start, line_stop), line_owner)
    _, first = np.unique(keys, return_index=True)
    n_dup_lines = lines - np.bincount(line_owner[first], minlength=texts)

    # words of windows that occur again in their text
    n_repeat = np.zeros(texts, dtype=np.int64)
    if len(words) >= window:
        whole = np.flatnonzero(owner[: len(words) - window + 1] == owner[window - 1 :])
        grams = _texts(ngram_hashes(words, window)[whole], owner[whole])
        order = np.argsort(grams)
        same = grams[order[1:]] == grams[order[:-1]]
        twice = np.zeros(len(grams), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        begin = whole[twice]
        n_repeat = per_text(covered(len(words), begin, begin + window), at)
    counts = {
        "n_words": n_words,
        "word_chars": per_text(inside & leading, offsets),
        "n_symbols": per_text(SYMBOLS[data], offsets),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat,
    }
    return counts, words, owner


def class_histogram(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bytes of each class (columns) in each text (rows); a code point counts once."""
    leading = (data & 0xC0) != 0x80
    kind = CLASS_OF[data]
    return np.stack([per_text((kind == k) & leading, offsets) for k in range(len(CLASSES))], axis=1)


def js_distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of rows of counts to rows of reference; 0 for a row without counts."""
    p = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    q = reference / np.maximum(reference.sum(axis=1, keepdims=True), 1)
    m = (p + q) / 2

    def relative(a):
        return np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0).sum(axis=1)

    distance = np.sqrt(np.clip((relative(p) + relative(q)) / 2, 0, 1))
    return np.where(counts.sum(axis=1) > 0, distance, 0.0)


def language_references(docs: DataFrame, text: str = "text", lang: str = "lang", top_words: int = TOP_WORDS) -> DataFrame:
    """One row a language: class counts, hashes and counts of its commonest words, and the count of all its words.

    All documents count; each task sums its own rows first. A null language is the language ``''``.
    """
    schema = "lang string, kind int, key long, n long"

    def summed(batches):
        for rows, data, offsets in text_chunks(batches, "text"):
            names = rows.column(0).fill_null("").to_numpy(zero_copy_only=False)
            classes = class_histogram(data, offsets)
            starts, ends = runs(NOT_BLANK[data], offsets)
            words = span_hashes(data, starts, ends)
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(starts, offsets)))
            for name in np.unique(names.astype(str)):
                mine = names == name
                key, n = np.unique(words[mine[owner]], return_counts=True)
                keys = np.concatenate([np.arange(len(CLASSES)), key.view(np.int64)])
                counts = np.concatenate([classes[mine].sum(axis=0), n])
                kinds = np.repeat([0, 1], [len(CLASSES), len(key)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys)), pa.array(kinds), pa.array(keys), pa.array(counts)], ["lang", "kind", "key", "n"])

    source = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    counts = source.mapInArrow(summed, schema).groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "key"))
    total = keep(counts, "quality-counts")
    # the limit on the rank is applied by every task before the shuffle, so no task gets all words of a language
    common = total.where("kind = 1").withColumn("r", rank).where(F.col("r") <= top_words).drop("r").unionByName(total.where("kind = 0"))
    sizes = total.where("kind = 1").groupBy("lang").agg(F.sum("n").alias("all_words"))
    return common.join(sizes, "lang", "left").select("lang", "kind", "key", "n", "all_words")


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", max_class: float = MAX_CLASS_DISTANCE, max_words: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Count, measure and judge every document.

    Returns (id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, class_distance,
    word_distance), one row for each input row. Null and empty texts have no words, fail the base rule and are not kept.
    A null language is a language of its own. Ties among the commonest words go by hash. Repeated ids and rows are judged
    one by one, other columns are not read.
    """
    references = {}
    for r in language_references(docs, text, lang).toLocalIterator():  # some 70 rows a language
        classes, words, total = references.setdefault(r.lang, ([0] * len(CLASSES), {}, [0]))
        if r.kind == 0:
            classes[r.key] = r.n
        else:
            words[r.key] = r.n
            total[0] = r.all_words
    names = sorted(references)
    class_table = np.array([references[x][0] for x in names], dtype=float).reshape(len(names), len(CLASSES))
    tables = []
    for x in names:
        key = np.array(sorted(references[x][1]), dtype=np.int64)
        n = np.array([references[x][1][k] for k in key.tolist()], dtype=float)
        tables.append((key, np.append(n, references[x][2][0] - n.sum())))
    place = {x: k for k, x in enumerate(names)}

    def judged(batches):
        for rows, data, offsets in text_chunks(batches, "text"):
            counts, words, owner = _counts(data, offsets)
            which = np.array([place[x] for x in rows.column(1).fill_null("").to_pylist()], dtype=np.int64)
            classes = class_histogram(data, offsets)
            by_class = js_distance(classes, class_table[which])
            by_word = np.zeros(len(which))
            for k, (key, reference) in enumerate(tables):
                mine = which == k
                if not mine.any() or len(key) == 0:
                    continue
                row = np.cumsum(mine) - 1
                chosen = mine[owner]
                found = words[chosen].view(np.int64)
                at = np.minimum(np.searchsorted(key, found), len(key) - 1)
                bins = np.where(key[at] == found, at, len(key))
                histogram = np.bincount(row[owner[chosen]] * (len(key) + 1) + bins, minlength=int(mine.sum()) * (len(key) + 1))
                by_word[mine] = js_distance(histogram.reshape(-1, len(key) + 1).astype(float), np.broadcast_to(reference, (int(mine.sum()), len(reference))))
            n = counts["n_words"]
            failed = (n < 20) | (100 * counts["n_repeat_words"] > 30 * n)
            odd = ((classes.sum(axis=1) >= MIN_CHARS) & (by_class > max_class)) | ((n >= MIN_WORDS) & (by_word > max_words))
            yield pa.RecordBatch.from_arrays(
                [rows.column(2), *(pa.array(counts[c].astype(np.int64)) for c in HASH_COLUMNS), pa.array(failed), pa.array(~failed & ~odd), pa.array(by_class), pa.array(by_word)],
                [id_col, *HASH_COLUMNS, "base_failed", "kept", "class_distance", "word_distance"],
            )

    source = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"), F.col(id_col))
    kind = dict(source.dtypes)[id_col]
    return source.mapInArrow(
        judged,
        f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in HASH_COLUMNS) + ", base_failed boolean, kept boolean, class_distance double, word_distance double",
    )


@register("op5_quality_rules")
def op5_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    """Every document judged against all documents of its language."""
    return judge_quality(table(spark, directory, "documents"))
