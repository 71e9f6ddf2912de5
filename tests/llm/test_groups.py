"""Operators over many documents against brute force: repeats, near copies, packing, sharding, links, toxicity, URLs."""

import hashlib
import itertools
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from farmledger.llm import suffix_dedup
from farmledger.llm.components import connected_components
from farmledger.llm import jaccard_join
from farmledger.llm.jaccard_join import counts_of, jaccard_groups, one_of_each_group, ranks_of
from farmledger.llm.packing import column_generation, knapsack, pack, plan, public_tokenizer
from farmledger.llm.scratch import DROP_SHUFFLES, keep
from farmledger.llm.sharding import schedule, shard_documents
from farmledger.llm.tokens import WordTokenizer
from farmledger.llm.toxicity import INSULT, NEGATION, OTHER, REPORT, TARGET, clause_score, drop_toxic, grammar, score_toxicity
from farmledger.llm.url_filter import filter_urls, rule_list
from tests.llm.common import UPPER_TO_LOWER, WORD, documents, empty, pairs

LOWEST = -(1 << 63)


def repeats_by_force(rows, length):
    seen, out = set(), {}
    for i, digest, t in sorted({(LOWEST if i is None else i, hashlib.sha256(t.encode()).hexdigest(), t) for i, t in rows}):
        b = t.encode()
        gone = np.zeros(len(b) + 1, dtype=bool)
        for k in range(len(b) - length + 1):
            if b[k : k + length] in seen:
                gone[k : k + length] = True
            else:
                seen.add(b[k : k + length])
        gone = gone[:-1]
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[i, digest] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("length", "seed", "hot"), [(100, 32, 4096), (20, 8, 2)])
def test_repeats(spark, monkeypatch, length, seed, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    docs = documents(spark)
    rows = pairs(docs)
    force = repeats_by_force(rows, length)
    want = Counter((i, *force[LOWEST if i is None else i, hashlib.sha256(t.encode()).hexdigest()]) for i, t in rows)
    got = suffix_dedup.remove_repeats(docs, length=length, seed=seed).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    assert all(sum(s.high - s.low for s in r.spans) == r.n_removed for r in got)
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def shuffle_files(spark) -> set:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(k).getName() for k in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_a_kept_table_leaves_no_shuffle_files(spark):
    setting = spark.conf.get(DROP_SHUFFLES, None)
    old = shuffle_files(spark)
    rows = spark.range(20_000).selectExpr("xxhash64(id) k", "id").groupBy("k").count()
    kept = keep(rows.repartition(3), "test")
    for _ in range(50):  # files are removed in the background
        if not (left := shuffle_files(spark) - old):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(DROP_SHUFFLES, None) == setting
    # the frame that was written can still be used
    assert kept.count() == rows.count() == 20_000 and rows.join(kept, "k").count() == 20_000


def test_interleave_agrees_with_sorting():
    rng = np.random.default_rng(4)
    pieces = [rng.choice([97, 98], rng.integers(1, 60)).astype(np.uint8) for _ in range(30)]
    shards, suffixes = [], []
    for low in range(0, 30, 10):
        part = pieces[low : low + 10]
        shard = suffix_dedup.Shard(np.concatenate(part), np.concatenate([[0], np.cumsum([len(p) for p in part])]))
        shards.append(shard)
        text = [s for k, p in enumerate(part) for s in [*p.tolist(), -1 - low - k]]
        suffixes += [tuple(text[o:]) for o in shard.order.tolist()]
    classes = np.concatenate(suffix_dedup.interleave(shards, 12))
    groups = defaultdict(set)
    for c, s in zip(classes.tolist(), suffixes, strict=True):
        groups[c].add(s[:12])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(s[:12] for s in suffixes))


def sets_by_force(rows, n):
    out = []
    for i, t in rows:
        w = WORD.findall(t.translate(UPPER_TO_LOWER))
        out.append((i, {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()))
    return out


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (1, 30)])
def test_near_copies(spark, n, percent):
    docs = documents(spark)
    rows = pairs(docs)
    sets = sets_by_force(rows, n)
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            parent[find(a)] = find(b)
    # rows with equal ids are one document
    by_id = {}
    for k, (i, s) in enumerate(sets):
        if i is not None and s:
            parent[find(k)] = find(by_id.setdefault(i, k))
    members = defaultdict(list)
    for k in range(len(sets)):
        members[find(k)].append(sets[k][0])
    want = Counter()
    for k, (i, s) in enumerate(sets):
        known = [x for x in members[find(k)] if x is not None]
        want[(i, len(s), min(known) if known and s else i)] += 1
    assert Counter(tuple(r) for r in jaccard_groups(docs, n, percent).collect()) == want
    if n == 5:
        kept = one_of_each_group(docs, n, percent)
        assert kept.columns == docs.columns
        assert {r[0] for r in want if r[0] == r[2]} == {r.doc_id for r in kept.select("doc_id").collect()}
        assert kept.count() == kept.select("doc_id", "text").distinct().count()
    assert jaccard_groups(empty(spark), n, percent).count() == 0


def test_rows_without_an_id_are_linked(spark):
    base = {c: " ".join(f"{c}{k}" for k in range(60)) for c in "abcd"}
    near = {c: t + f" {c}end" for c, t in base.items()}
    rows = [(None, base["a"]), (None, near["a"]), (7, base["b"]), (None, near["b"]), (None, base["c"]), (9, base["c"]), (None, base["d"]), (None, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(tuple(r) for r in jaccard_groups(docs, 5, 80).collect())
    assert got == Counter({(None, 56, None): 2, (None, 57, None): 1, (7, 56, 7): 1, (None, 57, 7): 1, (None, 56, 9): 1, (9, 56, 9): 1, (None, 0, None): 2})
    kept = pairs(one_of_each_group(docs, 5, 80))
    assert len([t for i, t in kept if i is None and t in (base["a"], near["a"])]) == 1
    assert sorted((repr(i), t) for i, t in kept if t not in (base["a"], near["a"])) == sorted([("7", base["b"]), ("9", base["c"]), ("None", base["d"]), ("None", "")])


def test_ids_near_the_largest_number(spark):
    text = " ".join(f"w{k}" for k in range(60))
    top = (1 << 63) - 1
    rows = [(top, text), (top - 5, text + " more"), (None, text + " end"), (None, "quite another text of seven words"), (-top, "a text by itself")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in jaccard_groups(docs, 5, 80).collect())
    assert got == Counter({(top, 56, top - 5): 1, (top - 5, 57, top - 5): 1, (None, 57, top - 5): 1, (None, 2, None): 1, (-top, 1, -top): 1})
    assert {r.doc_id for r in one_of_each_group(docs, 5, 80).collect()} == {top - 5, None, -top}


def test_columns_named_like_working_columns(spark):
    text = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(1, text, 5, 6, 7), (1, text, 5, 6, 7), (2, text, 8, 9, 10)], "doc_id long, text string, _copy long, _key long, _content long")
    kept = one_of_each_group(docs, 5, 80)
    assert [tuple(r) for r in kept.collect()] == [(1, text, 5, 6, 7)] and kept.columns == docs.columns


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """Every copy is met by few others: pairs inside a group are not formed."""
    monkeypatch.setattr(jaccard_join, "HOT", 256)
    compared = []
    whole = jaccard_join.verified
    monkeypatch.setattr(jaccard_join, "verified", lambda found, *rest: (compared.append(found.count()), whole(found, *rest))[1])
    base = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join([*base, f"odd{k}", f"end{k}"])) for k in range(1500)]
    rows += [(10_000 + k, " ".join(f"x{k}y{j}" for j in range(40))) for k in range(50)]
    got = {r.doc_id: r.component_id for r in jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 5, 80).collect()}
    assert all(got[k] == (0 if k < 1500 else k) for k, _ in rows)
    assert sum(compared) <= 1500 * 60, compared  # all pairs: 1,124,250


def test_codes_of_counts_keep_their_order():
    counts = np.array([0, 1, 5, 32767, 32768, 40000, 10**6, 10**12, 2**62])
    codes = ranks_of(counts)
    assert (np.diff(codes.astype(int)) > 0).all() and np.allclose(counts_of(codes), counts, rtol=0.002)


def test_components(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(100, 400)] + [(500, k) for k in range(501, 700)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)] + [(5, 5)]
    rng.shuffle(links)
    parent = {}

    def find(k):
        parent.setdefault(k, k)
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()}
    assert got == {k: find(k) for a, b in links if a != b for k in (a, b)}


def test_packing(spark):
    docs = documents(spark)
    pieces = pack(docs, public_tokenizer(), length=512)
    rows = pieces.collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(sequences) == set(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 512
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizer())
    want = Counter()
    for i, t in pairs(docs):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 2]
        for s in range(0, len(ids), 512):
            part = ids[s : s + 512]
            want[(i, s, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()), len(ids))] += 1
    assert Counter(tuple(r)[:5] for r in rows) == want
    used = sum(r.length for r in rows)
    assert len(sequences) <= 1.05 * used / 512 + 2
    assert pack(empty(spark), public_tokenizer()).count() == 0


def test_cutting_stock():
    widths, demand = np.array([3, 5, 7]), np.array([30.0, 20, 10])
    patterns, levels = column_generation(widths, demand, 15)
    assert np.allclose(patterns @ levels, demand) and (widths @ patterns <= 15).all()
    assert levels.sum() == pytest.approx((3 * 30 + 5 * 20 + 7 * 10) / 15, abs=0.7)
    assert knapsack(np.array([0.3, 0.5]), np.array([3, 4]), 11)[0] == pytest.approx(0.5 * 2 + 0.3)
    made = Counter()
    for w, c, times in plan({3: 31, 5: 19, 7: 11, 15: 2}, 15):
        assert (w * c).sum() <= 15
        for a, b in zip(w.tolist(), c.tolist(), strict=True):
            made[a] += b * times
    assert made == {3: 31, 5: 19, 7: 11, 15: 2}
    assert plan({}, 15) == []


def test_tokens():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizer())
    rng = random.Random(6)
    texts = ["it's 'tis don't I'LL '' 's's !'s", "x\x1cy a\x85b", "ΑΣ İ e\u0301 日本", "a<|endoftext|>b", "", " \n", "ÀÿŸẞß §1 ‘a’ — …", "a_b__c 12a3"]
    texts += ["".join(rng.choice("aB'1é ß.!\n\u00a0st") for _ in range(60)) for _ in range(300)]
    got = WordTokenizer(public_tokenizer()).encode(texts)
    for t, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_each_word_is_encoded_once():
    """Words go to the model alone, once each, also after the known words were forgotten."""

    class Counted:
        def __init__(self, inner):
            self.inner, self.seen = inner, []

        def tokenize(self, word):
            self.seen.append(word)
            return self.inner.tokenize(word)

        def encode(self, text, **options):
            self.seen.append(text)
            return self.inner.encode(text, **options)

    words = WordTokenizer(public_tokenizer())
    tokenizer, whole, model = words.tokenizer, Counted(words.tokenizer), Counted(words.tokenizer.model)
    words.tokenizer, words.model = whole, model
    texts = ["the élan of the Élan, it's 42 '' 's\x00\x7f", "", "of the — “élan” <| i'LL", "日本 the"]
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [np.frombuffer(i, "<u4").tolist() for i in words.encode(texts)] == expected
    assert whole.seen == ["日本 the"] * 2
    assert len(model.seen) == len(set(model.seen)) == 16
    words._forget()
    assert [np.frombuffer(i, "<u4").tolist() for i in words.encode(texts)] == expected
    assert words.encode([]) == []


def test_sharding(spark):
    docs = documents(spark)
    for grain in (256, 1):
        rows = shard_documents(docs, shards=4, grain=grain).collect()
        assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in pairs(docs))
        by_text = defaultdict(set)
        texts = dict(pairs(docs.where("doc_id <> 21")))
        slots, load = defaultdict(list), Counter()
        for r in rows:
            slots[r.shard].append(r.slot)
            load[r.shard] += r.size
            if r.doc_id in texts:
                assert r.size == len(texts[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
                by_text[texts[r.doc_id]].add(r.shard)
        assert all(len(s) == 1 for s in by_text.values())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard_documents(empty(spark)).count() == 0


def test_schedule_levels():
    rng = random.Random(7)
    classes = [(c, rng.randint(1, 500), 0) for c in range(20)]
    classes = [(c, n, n * (c + 5)) for c, n, _ in classes]
    placed, dealt = schedule([("big", 4000), ("other", 900)], classes, 7)
    load = Counter({placed["big"]: 4000})
    load[placed["other"]] += 900
    taken = Counter()
    for c, _, width, rounds, place, shard in dealt:
        assert place < width
        load[shard] += rounds * (c + 5)
        taken[c] += rounds
    assert taken == {c: n for c, n, _ in classes}
    assert max(load.values()) - min(load[s] for s in range(7)) <= 30


def test_grammar():
    machine = grammar()

    def score(*symbols):
        return clause_score(machine, list(symbols), [2.0 if s == INSULT else 0.0 for s in symbols])

    plain = score(OTHER, INSULT)
    assert plain == 2.0
    assert score(TARGET, OTHER, INSULT) > plain
    assert score(NEGATION, OTHER, INSULT) < plain
    assert score(NEGATION, OTHER, OTHER, OTHER, OTHER, INSULT) == plain
    assert score(REPORT, TARGET, INSULT) < score(TARGET, INSULT)


def test_toxicity(spark):
    rng = random.Random(8)
    words = [f"w{k}ord"[::-1] + "aeiou"[k % 5] for k in range(300)]
    rows, labels = [], []
    for k in range(1500):
        w = [rng.choice(words) for _ in range(40)]
        bad = k % 6 == 0
        if bad:
            w[rng.randrange(40)] = rng.choice(["grobbel", "snurfa"]) if k % 2 else "zlemp" + rng.choice("abcdefgh")
        rows.append((k, " ".join(w)))
        labels.append((k, int(bad)))
    rows += [(2000, None), (2001, ""), (None, "plain"), (5, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([*labels, (7, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    got = score_toxicity(docs, known).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held) and len(held) > 200
    wrong = [r for r in held if r.doc_id in truth and r.predicted != truth[r.doc_id]]
    assert len(wrong) <= 0.02 * len(held)
    flipped = spark.createDataFrame([(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels], "doc_id long, toxic int")
    again = {r.doc_id: r.score for r in score_toxicity(docs, flipped).collect()}
    assert all(again[r.doc_id] == r.score for r in got)  # held-out labels are not looked at
    kept = drop_toxic(documents(spark), known)
    assert kept.columns == documents(spark).columns
    assert score_toxicity(docs, known.limit(0)).count() == len(rows)
    assert score_toxicity(empty(spark), known).count() == 0


def test_urls(spark):
    rng = random.Random(9)
    hosts = ["example.org", "A.Example.ORG", "org", "notexample.org", "x.com", "example.net", "com", "myorg", "b.example.org:80"]
    paths = ["", "/", "/es/", "/es/1", "/en/1", "/en/12?x=/de/", "/fr/9#top", "/de/", "/de", "/en/2"]
    urls = [f"https://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(150)] + [None, "", "no scheme", "://", "http://?q", "http://example.org#/es/", "a://b://org/"]
    pages = spark.createDataFrame([(k % 120, u, "h", "p") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    want = Counter()
    for k, u in enumerate(urls):
        host = path = ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
            host, path = rest[:cut].translate(UPPER_TO_LOWER), rest[cut:]
            path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
        fits = [(len(h + p), h + p, v) for v, h, p in rules if path.startswith(p) and (host == h or host.endswith("." + h))]
        best = max(fits, default=None)
        want[(k % 120, host, path, best[1] if best else None, best[2] if best else "allow")] += 1
    assert Counter(tuple(r) for r in filter_urls(pages, rule_list(spark)).collect()) == want
    assert filter_urls(pages.limit(0), rule_list(spark)).count() == 0
    assert filter_urls(pages, rule_list(spark).limit(0)).where("verdict = 'allow'").count() == len(urls)
