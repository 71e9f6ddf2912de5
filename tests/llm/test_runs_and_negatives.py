"""Hard negatives, line quality and periodic runs against brute force and held-out labels."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pandas as pd

from farmledger.llm import line_quality
from farmledger.llm.hard_negatives import hard_negatives
from farmledger.llm.line_quality import LineField, line_bins, score_lines
from farmledger.llm.periodic_runs import COVER, MODULUS, CommonExtension, all_runs, describe_runs
from tests.llm.common import WORD, documents, empty, pairs

VECTORS = "vec_id long, embedding array<float>, label int, score long, rank string, anchor_id int, slot string"


def vectors(seed: int = 5, copies: int = 60) -> list:
    """Rows with nulls, non-finite and very large components, ties, copies, other lengths, empty vectors."""
    rng = random.Random(seed)
    rows = [(k, [rng.gauss(0.2, 0.5) for _ in range(6)], rng.randrange(3)) for k in range(320)]
    rows += [(400 + k, [0.5, 0.25, 0.0, -0.5, 0.125, 1.0], k % 2) for k in range(copies)]
    rows += [(500, [0.5, 0.25], 1), (600, [], 1), (601, [], 2), (700, [0.5] * 9, 0), (-100, [0.3] * 6, 2)]
    rows += [(800, None, 1), (801, [0.1, None], 1), (900, [float("nan")] * 6, 1), (901, [float("inf")] * 6, 1), (902, [1.0] * 6, None)]
    rows += [(None, [0.4] * 6, 1), (1000, [30000.0] * 6, 1), (1001, [29000.0] * 6, 0), (1002, [1e30] * 6, 0), rows[0], rows[5], rows[200]]
    return [(*r, 7, "x", 3, "s") for r in rows]


def negatives_by_force(rows, positives=5, negatives=10):
    kept = []
    for name, vector, label, *_ in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in vector]
        if any(abs(x) >= 1 << 26 for x in q):
            continue
        kept.append((name, q, (label + 1) % 10 if name is not None and name % 7 == 0 else label))
    out = []
    for name, q, label in {(n, tuple(v), y) for n, v, y in kept if n is not None and n % 100 == 0}:
        scored = sorted(((-sum(map(int.__mul__, q, v)), math.inf if n is None else n, y) for n, v, y in kept if n != name))
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            fit = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(name, None if p == math.inf else p, k, None if n == math.inf else n, -s, -t) for k, (t, n, _) in enumerate(fit, 1)]
    return sorted(out, key=repr)


def test_hard_negatives(spark):
    rows = vectors()
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    assert sorted(map(tuple, hard_negatives(frame).collect()), key=repr) == negatives_by_force(rows)
    assert hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0


def test_hard_negatives_in_several_blocks_of_anchors(spark, monkeypatch):
    monkeypatch.setattr("farmledger.llm.hard_negatives.ANCHOR_NUMBERS", 12)
    monkeypatch.setattr("farmledger.llm.hard_negatives.BATCH_NUMBERS", 100)
    rows = vectors(8, 30)
    got = hard_negatives(spark.createDataFrame(rows, VECTORS).repartition(2))
    assert sorted(map(tuple, got.collect()), key=repr) == negatives_by_force(rows)


def brute_runs(words):
    out = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(24, 3 * q) and i > start:
                out.setdefault((start, i - start + q), q)
            i += 1
    return sorted((s, z, q) for (s, z), q in out.items())


def periodic(rng, n, k):
    w = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 4:
            a, p = rng.randrange(n), rng.randint(1, max(1, n // 3))
            for i in range(a, rng.randint(a, n)):
                w[i] = w[a + (i - a) % p]
    return w


def test_all_runs():
    rng = random.Random(2)
    for _ in range(60):
        texts = [periodic(rng, rng.choice([0, 1, 5, 23, 24, 25, 60, 150, 300]), rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(1, 5))]
        count = np.array([len(w) for w in texts])
        first = np.concatenate([[0], np.cumsum(count + 1)[:-1]])
        start, length, period = all_runs(np.concatenate([np.array([*w, 0]) for w in texts]), first, count)
        owner = np.searchsorted(first, start, side="right") - 1
        for k, w in enumerate(texts):
            here = owner == k
            assert list(zip((start[here] - first[k]).tolist(), length[here].tolist(), period[here].tolist(), strict=True)) == brute_runs(w)


def test_common_extension():
    assert {(a - b) % MODULUS for a in COVER for b in COVER} == set(range(MODULUS))
    rng = random.Random(4)
    for n in (1, 2, 40, 400):
        words = periodic(rng, n, 2)
        words.append(9)
        find = CommonExtension(np.array(words))
        pairs_at = [(i, j) for i, j in itertools.product(range(n + 1), repeat=2) if i != j and (n < 100 or (i * 7 + j) % 11 == 0)]
        got = find(*(np.array(x) for x in zip(*pairs_at, strict=True)))
        for (i, j), z in zip(pairs_at, got.tolist(), strict=True):
            want = 0
            while max(i, j) + want <= n and words[i + want] == words[j + want]:
                want += 1
            assert z == want


def described(name, text, plant):
    w = WORD.findall(text or "")
    n = len(w)
    if plant and name is not None and n:
        h = zlib.crc32(str(name).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = brute_runs(w) if n < 3000 else []
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, z, q in found for i in range(s + q, s + z)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return name, n, len(found), *best, milli, sha("".join(f"{s},{z},{q}\n" for s, z, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone))


def test_describe_runs(spark):
    rng = random.Random(9)
    made = [(1000 + k, " ".join("abc"[x] + "é" * x for x in periodic(rng, 200, 3))) for k in range(40)]
    docs = documents(spark).select("doc_id", "text").union(spark.createDataFrame(made, "doc_id long, text string"))
    rows = [r for r in pairs(docs) if len(r[1].split()) < 3000]
    short = docs.where("text IS NULL OR size(split(text, ' ')) < 3000")
    for plant in (False, True):
        got = sorted((tuple(r) for r in describe_runs(short, plant=plant).collect()), key=repr)
        assert got == sorted((described(i, t, plant) for i, t in rows), key=repr)
    assert describe_runs(documents(spark)).count() == documents(spark).count()
    assert describe_runs(empty(spark)).count() == 0


def field_by_force(field, bins):
    """Marginals of one text by the sum over all labellings."""
    n = len(bins)
    start, end = np.arange(n) == 0, np.arange(n) == n - 1
    score = field.potentials(bins, start, end)
    total, good, pair = 0.0, np.zeros(n), np.zeros((n, 2, 2))
    for labels in itertools.product((0, 1), repeat=n):
        weight = math.exp(sum(score[k] for k in range(n) if labels[k]) + sum(field.change[a, b] for a, b in itertools.pairwise(labels)))
        total += weight
        good += weight * np.array(labels)
        for k in range(1, n):
            pair[k, labels[k - 1], labels[k]] += weight
    return good / total, pair / total


def test_marginals_and_gradient():
    rng = np.random.default_rng(3)
    texts = ["one line", "A b.\nTHE END!! ##\n\nmore | than | this", "x\ny\nz z z z\nw1 w2\nlast one here"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    bins, length, text = line_bins(data, offsets)
    assert text.tolist() == [0, 1, 1, 1, 2, 2, 2, 2, 2] and length[0] == 8
    size = line_quality.BINS
    field = LineField(rng.normal(0, 0.4, size), rng.normal(0, 0.4, size), rng.normal(0, 0.4, size), 0.3, rng.normal(0, 0.7, (2, 2)))
    good, pair = field.marginals(bins, text)
    for k in range(3):
        want, want_pair = field_by_force(field, bins[text == k])
        assert np.allclose(good[text == k], want) and np.allclose(pair[text == k], want_pair)


def test_quality_of_held_out_documents(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdehilmnorstu") for _ in range(rng.randint(1, 8)))
    plain = lambda: "\n".join(" ".join(word() for _ in range(rng.randint(4, 14))).capitalize() + "." for _ in range(rng.randint(1, 12)))
    junk = [lambda t: " | ".join(t.split()), lambda t: t.upper().replace(" ", "!! "), lambda t: " ".join(w + "###" for w in t.split()), lambda t: (t.split()[0] + " ") * 60]
    rows = [(k, junk[k % 4](plain()) if k % 5 == 0 else plain(), int(k % 5 != 0)) for k in range(600)]
    frame = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    got = score_lines(frame, labels).toPandas().merge(pd.DataFrame(rows, columns=["doc_id", "text", "quality"]), on="doc_id")
    unseen = got[got.held_out]
    assert len(unseen) > 100 and (unseen.predicted == unseen.quality).mean() > 0.97
    assert set(got[got.held_out].doc_id) == {k for k, *_ in rows if zlib.crc32(str(k).encode()) % 4 == 2}


def test_held_out_labels_are_not_read(spark):
    docs = documents(spark)
    labels = [(k, k % 2) for k in range(60)]
    turned = [(k, 1 - q if zlib.crc32(str(k).encode()) % 4 == 2 else q) for k, q in labels]
    a, b = (score_lines(docs, spark.createDataFrame([*x, (None, 1), (3, None), (7, 0)], "doc_id long, quality int")) for x in (labels, turned))
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    assert a.count() == docs.count() and a.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in score_lines(docs, none).collect()} == {0.5}
    assert score_lines(empty(spark), none).count() == 0
