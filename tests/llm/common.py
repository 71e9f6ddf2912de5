"""Small tables that hold the difficult cases."""

import random
import re

UPPER_TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, component_id string, shard string, "
    "spans string, num long, key string, kept string, sequence_id string, rule string"
)


def texts(seed: int = 3) -> list:
    """Random texts with copies, near copies, shared passages, repeats, blanks and one very long text."""
    rng = random.Random(seed)
    words = "the and thre ionst ea ableth whe ouré ß über Idiot password=Abcdef0123456789 a@b.example.org +1 (555) 010-9999 !".split()
    words += ["".join(rng.choice("abcdeftionr") for _ in range(rng.randint(2, 8))) for _ in range(60)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 120))) for _ in range(8)]
    out = [None, "", "   \n\t ", "x", "The the", "one two three", "\n".join(["same line here"] * 30), "ab" * 400, "z" * 300]
    out += [" ".join(rng.choice(words) for _ in range(40_000)), "é" * 5000, "0123456789abcdef" * 40]
    for _ in range(60):
        t = rng.choice(base)
        kind = rng.random()
        if kind < 0.3:
            w = t.split(" ")
            w[rng.randrange(len(w))] = rng.choice(words)
            t = " ".join(w)
        elif kind < 0.5:
            t = " ".join(rng.choice(words) for _ in range(20)) + " " + t
        elif kind < 0.6:
            t = t[: rng.randint(0, len(t))]
        out.append(t)
    return out


def documents(spark, seed: int = 3):
    """Documents with null ids and values, repeated rows, an id with two texts, and columns named like results."""
    rows = [(k, t, ("en", None, "de")[k % 3], None if k % 5 == 0 else "s", k) for k, t in enumerate(texts(seed))]
    rows += [rows[20], rows[20], (None, "a lone text without a number", None, None, None), (21, "another text of the same number", "en", "s", 1)]
    return spark.createDataFrame([(*r, 0.1, "c", "s", "p", 7, "k", "x", "q", "r") for r in rows], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(docs) -> list:
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
