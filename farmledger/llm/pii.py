"""Personal data by a semi-Markov conditional random field over candidate regions.

A region is a stretch of text that could hold personal data: around an ``@`` or a spelled ``at``, or digits with the marks
between them. It is a sequence of groups (runs of letters or digits, or single marks). A segmentation covers the region
with entities of at most ``MAX_GROUPS`` groups and with single groups outside. Features look at a whole span (its digits,
checksum, shape, borders, the word before it); boundaries and types are chosen jointly by dynamic programming. Weights
maximise the conditional likelihood of segmentations, with the sums over all segmentations from a forward and a backward
pass. The examples are regions of a bounded sample of documents with the spans of the base patterns, and the same regions
with a span written in ways that the base patterns miss (``rewrites``).
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farmledger.llm.registry import register, table

KINDS = ("email", "ip", "card", "phone")
MAX_GROUPS = 24  # groups of the longest entity
SAMPLE_DOCS, SAMPLE_REGIONS, SAMPLE_SPANS = 2000, 4000, 200_000  # bounds of the training sample: documents, pieces, candidate spans
PIECE_CHARS = 160  # a longer region is trained in pieces of about this size, parted outside wanted spans
ROUNDS, RATE, RIDGE = 80, 0.15, 1e-4
MARGIN = 1.0  # an entity that the base patterns do not have must beat the segmentation without it by this log-odds
WORD_COUNT = 40  # a word before a span is told apart when it stands before so many wanted spans of the sample
BEFORE, BEHIND = 24, 2  # characters around a piece that features look at

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A start inside a run of digits fails where the start of the run fails, so runs are tried once.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[+(0-9][] ()./+0-9[-]{5,}")
_SPELLED_AT = re.compile(r" ?[\[(]at[\])] ?| at | @ ", re.I)
_SPELLED_DOT = re.compile(r" ?[\[(](?:dot|\.)[\])] ?| dot | \. ", re.I)
_SPELLED_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?: ?[\[(]dot[\])] ?| dot | \. |\.)[A-Za-z0-9-]+)+", re.I)
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_GROUP = re.compile(r"[0-9]+|[A-Za-z]+|.", re.S)
_NOT_DIGIT = re.compile(r"[^0-9]")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    """Checksum of a card number."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost non-overlapping addresses: only an ``@`` can make one, so its surroundings are looked at."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
            done = m.end()
        else:
            done = max(done, at + 1)  # nothing that begins before this sign can hold it
        at = text.find("@", max(done, at + 1))
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the base patterns, each kind for itself, by start and then by kind."""
    out = _emails(text) if "@" in text else []
    out += [(m.start(), m.end(), "ip") for m in _IP.finditer(text) if all(_small(p) for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches that could hold personal data, in order and apart from each other."""
    found = []
    at = text.find("@")
    while at >= 0:
        start, end = at, at + 1
        while start > 0 and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        while end < len(text) and (text[end] in _LOCAL_CHARS or text[end] == "@"):
            end += 1
        found.append((start, end))
        at = text.find("@", end)
    for m in _SPELLED_AT.finditer(text):
        start = m.start()
        host = _SPELLED_HOST.match(text, m.end()) if start and text[start - 1] in _LOCAL_CHARS else None
        if host:
            while start > 0 and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            found.append((start, host.end()))
    for m in _DIGITS.finditer(text):
        if sum(c.isdigit() for c in m.group()) >= 7 or m.group().count(".") >= 3:
            found.append((m.start(), m.start() + len(m.group().rstrip(" (.+-[/"))))
    found.sort()
    merged: list[tuple[int, int]] = []
    for s, e in found:
        if merged and s < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    return merged


_MARKS = {c: c for c in "+-. ()@_%/[]"}


def _class(c: str) -> str:
    return "d" if "0" <= c <= "9" else "a" if c.isalpha() else _MARKS.get(c, "x")


def _word_before(text: str, start: int) -> str:
    """The word of letters before a position, at most three marks away."""
    k = start
    while k > 0 and start - k < 3 and not text[k - 1].isalnum():
        k -= 1
    end = k
    while k > 0 and start - k < BEFORE and text[k - 1].isalpha():
        k -= 1
    return text[k:end].lower()


def candidates(text: str, start: int, end: int) -> Iterator[tuple[int, int, str, tuple]]:
    """Spans of a region that may be an entity: first and last cut, kind and what features see of it.

    The last item holds values of few kinds each, so that equal ones can be scored once. Spans come by their end.
    """
    cuts = [m.start() for m in _GROUP.finditer(text, start, end)] + [end]
    groups = [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    classes = [_class(g[0]) for g in groups]
    words: dict[int, str] = {}
    around = [_class(text[c]) if c < len(text) else "" for c in (end, end + 1)]
    behind = ["." if g.lower() == "dot" else c for g, c in zip(groups, classes, strict=True)] + around
    for j in range(1, len(groups) + 1):
        if classes[j - 1] not in "ad":
            continue
        digits, mask, mail, dots = "", frozenset(), False, 0
        for i in range(j - 1, max(j - MAX_GROUPS, 0) - 1, -1):
            g, c = groups[i], classes[i]
            mask |= {c}
            dots += c == "."
            mail = mail or c == "@" or g.lower() == "at"
            if c == "d":
                digits = g + digits
            if c not in "ad+(":
                continue
            size = cuts[j] - cuts[i]
            if size < (5 if mail else 7) or (not mail and "a" in mask):
                continue
            n = len(digits)
            address = quad = passes = False
            if mail:
                plain = _SPELLED_DOT.sub(".", _SPELLED_AT.sub("@", text[cuts[i] : cuts[j]]))
                address = _ADDRESS.fullmatch(plain) is not None and not plain.rpartition(".")[2].isdigit()
            elif dots == 3:
                parts = _SPELLED_DOT.sub(".", text[cuts[i] : cuts[j]]).split(".")
                quad = all(p.isdigit() and _small(p) for p in parts)
            if not mail and 12 <= n <= 19:
                passes = luhn(digits)
            if i not in words:
                words[i] = _word_before(text, cuts[i])
            before = _class(text[cuts[i] - 1]) if cuts[i] else ""
            length = 0 if n < 7 else 1 if n < 9 else 2 if n < 12 else 3 if n < 16 else 4 if n < 20 else 5
            seen = (length, mask, c, before, behind[j], behind[j + 1] if behind[j] == " " else "", address, quad, passes, size > 40, words[i])
            for kind in ("email",) if mail else ("ip", "card", "phone"):
                yield i, j, kind, seen


def span_features(kind: str, seen: tuple, words: frozenset) -> list[str]:
    """Names of the features of a candidate entity, the same number for each; words that are not in ``words`` count as one."""
    length, mask, first, before, after, beyond, address, quad, passes, long, word = seen
    word = word if word in words or not word else "*"
    shape = "".join(sorted(mask))
    return [
        kind, f"{kind}:digits={length}", f"{kind}:shape={shape}", f"{kind}:first={first}", f"{kind}:before={before}", f"{kind}:after={after}{beyond}",
        f"{kind}:address={address}", f"{kind}:quad={quad}", f"{kind}:luhn={passes}:{length}", f"{kind}:long={long}", f"{kind}:word={word}",
    ]


class Segmenter:
    """A semi-Markov field: weights of span features; a group outside scores 0. An entity follows another one only after a group outside."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.words = frozenset(f.partition(":word=")[2] for f in weights if ":word=" in f)
        self.scores: dict[tuple, float] = {}

    def score(self, kind: str, seen: tuple) -> float:
        known = self.scores.get((kind, seen))
        if known is None:
            if len(self.scores) > 100_000:
                self.scores.clear()
            known = self.scores[kind, seen] = sum(self.weights.get(f, 0.0) for f in span_features(kind, seen, self.words))
        return known

    def decode(self, text: str, start: int, end: int) -> list[tuple[int, int, str, float]]:
        """Entities of the best segmentation of a region, each with its log-odds against leaving its groups outside."""
        cuts = [m.start() for m in _GROUP.finditer(text, start, end)] + [end]
        best, back = [0.0] * len(cuts), [None] * len(cuts)
        at = 0
        for i, j, kind, seen in candidates(text, start, end):
            while at < j:
                at += 1
                best[at] = best[at - 1]
            own = self.score(kind, seen)
            if own > 0 and best[max(i - 1, 0)] + own > best[j]:
                best[j], back[j] = best[max(i - 1, 0)] + own, (i, kind, own)
        out, j = [], at
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, kind, own = back[j]
                out.append((cuts[i], cuts[j], kind, own))
                j = max(i - 1, 0)
        return out[::-1]


def rewrites(span: str, kind: str) -> list[str]:
    """A span of a base pattern written in other ways."""
    digits = _NOT_DIGIT.sub("", span)
    if kind == "email":
        name, _, host = span.partition("@")
        return [name + at + host.replace(".", dot) for at, dot in ((" at ", " dot "), ("[at]", "[dot]"), (" (at) ", "."), (" @ ", " . "))]
    if kind == "ip":
        return [span.replace(".", dot) for dot in ("[.]", " . ", "(.)")]
    if kind == "card":
        fours = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        return [mark.join(fours) for mark in (".", "/", "  ", " - ")]
    head, middle, tail = digits[:-7], digits[-7:-4], digits[-4:]
    return [f"{head}-{middle}-{tail}", f"00{head} {middle} {tail}", f"({head[-3:]}) {middle}-{tail}", f"{head}.{middle}.{tail}", f"{head[-3:]}/{middle}{tail}"]


Example = tuple[str, int, int, list[Span]]


def examples(text: str, piece_chars: int = PIECE_CHARS) -> list[Example]:
    """The regions of a text in pieces, each cut out with the characters beside it: text, start, end and wanted spans in it.

    Wanted are base spans, and those that the base patterns find in what is left beside one of them. A region is parted at
    the first place from ``piece_chars`` on that lies in no wanted span, so all of it is used.
    """
    out = []
    base, k = _apart(base_spans(text)), 0
    for s, e in regions(text):
        while k < len(base) and base[k][1] <= s:
            k += 1
        wanted, done = [], s
        while k < len(base) and base[k][0] < e:
            wanted += _within(text, done, base[k][0])
            wanted.append(base[k])
            done = base[k][1]
            k += 1
        if wanted:
            wanted += _within(text, done, e)
        at = 0
        while s < e:
            stop, first = min(e, s + piece_chars), at
            while at < len(wanted) and wanted[at][0] < stop:
                stop = max(stop, wanted[at][1])
                at += 1
            low = max(s - BEFORE, 0)
            out.append((text[low : stop + BEHIND], s - low, stop - low, [(a - low, b - low, kind) for a, b, kind in wanted[first:at]]))
            s = stop
    return out


def _apart(spans: list[Span]) -> list[Span]:
    """Of spans that overlap the first and longest."""
    out: list[Span] = []
    for x in sorted(spans, key=lambda x: (x[0], -x[1], KINDS.index(x[2]))):
        if not out or x[0] >= out[-1][1]:
            out.append(x)
    return out


def _within(text: str, start: int, end: int) -> list[Span]:
    """Spans of a stretch beside a base span, judged as if it stood alone: what runs into its neighbour matches no pattern."""
    return [(start + a, start + b, kind) for a, b, kind in _apart(base_spans(text[start:end].rstrip()))] if end - start > 6 else []


def rewritten(example: Example) -> list[Example]:
    """The example with one of its spans written in each of the other ways, and with an address of a machine behind that span."""
    text, start, end, wanted = example
    if not wanted:
        return []
    turn = zlib.crc32(text.encode("utf-8", "replace"))
    a, b, kind = wanted[turn % len(wanted)]
    if not start <= a < b <= end:
        return []
    other = ".".join(str(turn // m % 256) for m in (3, 11, 101, 1009))
    forms = [(new, [(a, a + len(new), kind)]) for new in rewrites(text[a:b], kind)]
    forms.append((f"{text[a:b]} {other}", [(a, b, kind), (b + 1, b + 1 + len(other), "ip")]))
    out = []
    for new, spans in forms:
        grown = len(new) - (b - a)
        rest = [(x + grown, y + grown, k) if x >= b else (x, y, k) for x, y, k in wanted if (x, y) != (a, b)]
        out.append((text[:a] + new + text[b:], start, end + grown, sorted(rest + spans)))
    return out


def train(sample: list[Example], max_spans: int = SAMPLE_SPANS) -> dict[str, float]:
    """Weights that maximise the mean conditional log-likelihood of the wanted segmentations, less a ridge.

    Examples are taken in their order until their candidate spans number ``max_spans``. One whose wanted spans are not
    all candidates is left out.
    """
    names: dict[str, int] = {}
    beside = Counter(_word_before(text, a) for text, _, _, wanted in sample for a, _, _ in wanted)
    words = frozenset(w for w, n in beside.items() if n >= WORD_COUNT)
    owner, first, last, features, wanted_rows, sizes = [], [], [], [], [], []
    for text, s, e, wanted in sample:
        cuts = [m.start() for m in _GROUP.finditer(text, s, e)] + [e]
        rows, missing = [], set(wanted)
        for i, j, kind, seen in candidates(text, s, e):
            span = (cuts[i], cuts[j], kind)
            rows.append((i, j, [names.setdefault(f, len(names)) for f in span_features(kind, seen, words)], span in missing))
            missing.discard(span)
        if missing or not rows:
            continue
        if len(owner) + len(rows) > max_spans:
            break
        for i, j, f, hit in rows:
            owner.append(len(sizes))
            first.append(max(i - 1, 0))
            last.append(j)
            features.append(f)
            wanted_rows.append(hit)
        sizes.append(len(cuts) - 1)
    if not owner:
        return {}
    own, f_at, l_at = np.array(owner), np.array(first), np.array(last)
    feats, hits = np.array(features, dtype=np.int32), np.array(wanted_rows)
    n, width = len(sizes), max(sizes)
    by_end, by_start = np.argsort(l_at, kind="stable"), np.argsort(f_at, kind="stable")
    end_at = np.searchsorted(l_at[by_end], np.arange(width + 2))
    start_at = np.searchsorted(f_at[by_start], np.arange(width + 2))
    # beyond a region's end there are only groups outside, so all regions can be as long as the longest
    size = len(names)
    weights, one, two = np.zeros(size), np.zeros(size), np.zeros(size)
    told = np.bincount(feats[hits].ravel(), minlength=size).astype(float)
    for k in range(1, ROUNDS + 1):
        score = weights[feats].sum(axis=1)
        ahead, back = np.zeros((width + 1, n)), np.zeros((width + 1, n))
        for j in range(1, width + 1):
            ahead[j] = ahead[j - 1]
            rows = by_end[end_at[j] : end_at[j + 1]]
            np.logaddexp.at(ahead[j], own[rows], ahead[f_at[rows], own[rows]] + score[rows])
        # what is left from a border on, when the group behind it is outside; an entity starts one group later but at 0
        for j in range(width - 1, -1, -1):
            back[j] = back[j + 1]
            rows = by_start[start_at[j] : start_at[j + 1]]
            np.logaddexp.at(back[j], own[rows], back[l_at[rows], own[rows]] + score[rows])
        chance = np.exp(np.minimum(ahead[f_at, own] + score + back[l_at, own] - ahead[width][own], 0.0))
        slope = (told - np.bincount(feats.ravel(), weights=np.repeat(chance, feats.shape[1]), minlength=size)) / n - RIDGE * weights
        one, two = 0.9 * one + 0.1 * slope, 0.99 * two + 0.01 * slope**2
        weights = weights + RATE * (one / (1 - 0.9**k)) / (np.sqrt(two / (1 - 0.99**k)) + 1e-8)
    return {f: float(w) for f, w in zip(names, weights, strict=True) if abs(w) > 1e-3}


def added_spans(text: str, base: list[Span], model: Segmenter) -> list[Span]:
    """Entities that the model finds where no base span lies."""
    held: list[list[int]] = []  # what the base spans cover, as stretches apart from each other
    for a, b, _ in base:
        if held and a < held[-1][1]:
            held[-1][1] = max(held[-1][1], b)
        else:
            held.append([a, b])
    ends = [b for _, b in held]
    out = []
    for s, e in regions(text) if model.weights else ():
        for a, b, kind, score in model.decode(text, s, e):
            at = bisect_right(ends, a)
            if score >= MARGIN and (at == len(held) or held[at][0] >= b):
                out.append((a, b, kind))
    return out


def find_pii(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS, sample_regions: int = SAMPLE_REGIONS,
    sample_spans: int = SAMPLE_SPANS, piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """Personal data in every document.

    Returns (id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row for each input row. ``spans`` holds the
    spans of the base patterns and those that the trained model adds where no base span lies, as kind:start:end in code
    points. A null text is empty; a text without regions is only scanned. The model is trained on the documents with an
    ``@`` or a digit that come first in the order of a hash of their text, ``sample_docs`` at most and of any length. Their
    regions are parted into pieces of about ``piece_chars`` characters (one with a span four times as long is left out); of
    the distinct pieces those that come first by a hash are taken, ``sample_regions`` and ``sample_spans`` candidate spans
    at most. So the model does not depend on the order of rows; without regions it adds nothing. Repeated rows stay; other
    columns are not read.
    """
    source = docs.select(F.col(id_col), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    kind = dict(source.dtypes)[id_col]
    able = source.where(F.col("text").rlike("[@0-9]")).withColumn("turn", F.xxhash64("text"))
    turns = [r[0] for r in able.select("turn").distinct().orderBy("turn").limit(sample_docs).collect()]  # numbers only

    def cut(batches):
        for batch in batches:
            for t in batch.column(0).to_pylist():
                found = [x for x in examples(t, piece_chars) if len(x[0]) <= 4 * piece_chars]
                for low in range(0, len(found), 4096):
                    piece, start, end, wanted = zip(*found[low : low + 4096], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(piece, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array([_joined(w) for w in wanted], pa.string())],
                        ["piece", "start", "end", "wanted"],
                    )

    weights = {}
    if turns:
        chosen = able.where(F.col("turn") <= turns[-1]).select("text").mapInArrow(cut, "piece string, start int, end int, wanted string").distinct()
        order = [F.xxhash64("piece", "start", "end"), "piece", "start", "end", "wanted"]
        pieces = [(r.piece, r.start, r.end, _split(r.wanted)) for r in chosen.orderBy(*order).limit(sample_regions).collect()]
        weights = train([x for p in pieces for x in (p, *rewritten(p))], sample_spans)

    def found(batches):
        model = Segmenter(weights)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                rows = batch.slice(low, 512)
                counts: list[list[int]] = [[] for _ in KINDS]
                digests, everything = [], []
                for t in rows.column(1).to_pylist():
                    base = base_spans(t)
                    spans = base + added_spans(t, base, model)
                    for k, name in enumerate(KINDS):
                        counts[k].append(sum(b[2] == name for b in base))
                    digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                    everything.append(_joined(spans))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(everything, pa.string())],
                    [id_col, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
                )

    return source.mapInArrow(found, f"`{id_col}` {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(set(spans), key=lambda s: (s[0], KINDS.index(s[2]), s[1])))


def _split(spans: str) -> list[Span]:
    parts = [x.split(":") for x in spans.split(",") if x]
    return [(int(a), int(b), k) for k, a, b in parts]


@register("op9_pii")
def op9_pii(spark: SparkSession, directory: str) -> DataFrame:
    """Personal data in all documents."""
    return find_pii(table(spark, directory, "documents"))
