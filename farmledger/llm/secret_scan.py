"""Secret scan with a trigram inverted index, in DataFrame expressions only.

From each rule's pattern a Boolean query over trigrams is derived: every match contains, for each part of the query, all
trigrams of one alternative. The inverted index is written once: for each segment (an input split) and each trigram that
some rule asks for, the list of the documents that hold it. Each rule intersects and unites the lists of its query, shortest
first, segment by segment; only the documents that are left are verified with its pattern. A rule without mandatory trigrams
verifies every document.

A text can only be a candidate of a rule if it holds one of the rarest trigrams of the rule's rarest part, as the lengths
of the lists tell. Texts without any of these stay where they are; the others meet the candidates' numbers.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _constants as node
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farmledger.llm.registry import register, table
from farmledger.llm.scratch import keep


@dataclass(frozen=True)
class Rule:
    """A kind of secret: pattern, the group whose length counts (0: the match), and its least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules. Letters in either case are written out, so that all engines read them alike.
BASE_RULES = [
    Rule(
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
]
# Further secrets with a fixed mark.
MORE_RULES = [
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("code_host_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
]
RULES = BASE_RULES + MORE_RULES

# A query is a conjunction of parts, a part a set of alternatives, an alternative a set of trigrams that must all occur.
Query = list[frozenset[frozenset[str]]]
MAX_STRINGS, MAX_CLASS = 64, 8
RUN = 256  # spans that are appended to one array; longer lists are made of such runs, so their cost grows with their length


def _part(strings: set[str]) -> Query:
    """What a set of strings, one of which must occur, asks for."""
    if any(len(s) < 3 for s in strings):
        return []
    alternatives = {frozenset(s[k : k + 3] for k in range(len(s) - 2)) for s in strings}
    return [frozenset(a for a in alternatives if not any(b < a for b in alternatives))]  # who holds more also holds less


def _product(left: set[str], right: set[str]) -> set[str] | None:
    return {a + b for a in left for b in right} if len(left) * len(right) <= MAX_STRINGS else None


def _walk(items) -> tuple[set[str] | None, Query]:
    """Of a parsed sequence: all strings it can match (None: unbounded) and its query apart from these."""
    exact: set[str] | None = {""}
    whole, query = True, []
    for op, value in items:
        strings, inner = _item(op, value)
        query += inner
        joined = _product(exact, strings) if strings is not None else None
        if joined is not None:
            exact = joined
            continue
        query += _part(exact)
        whole = False
        exact = strings if strings is not None else {""}
    if whole:
        return exact, query
    return None, query + _part(exact)


def _item(op, value) -> tuple[set[str] | None, Query]:
    if op is node.LITERAL:
        return {chr(value).lower()}, []
    if op is node.IN:
        chars: set[str] = set()
        for kind, v in value:
            if kind is node.LITERAL:
                chars.add(chr(v).lower())
            elif kind is node.RANGE and v[1] - v[0] < 2 * MAX_CLASS:
                chars |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None, []
        return (chars, []) if len(chars) <= MAX_CLASS else (None, [])
    if op is node.SUBPATTERN:
        return _walk(value[3])
    if op is node.BRANCH:
        found = [_walk(b) for b in value[1]]
        if all(e is not None for e, _ in found):
            return set().union(*(e for e, _ in found)), []
        return None, []
    if op in (node.MAX_REPEAT, node.MIN_REPEAT):
        low, high, body = value
        strings, inner = _walk(body)
        if low == 0:
            return (strings | {""}, []) if high == 1 and strings is not None and not inner else (None, [])
        if strings is not None and low == high:
            out: set[str] | None = {""}
            for _ in range(low):
                out = _product(out, strings) if out is not None else None
            return out, inner
        return None, inner + (_part(strings) if strings is not None else [])
    return None, []


def trigram_query(pattern: str) -> Query:
    """Trigrams, in lower case, that every match of a pattern contains; empty when there is none for sure."""
    strings, query = _walk(parser.parse(pattern))
    return query + (_part(strings) if strings is not None else [])


def postings(docs: DataFrame, id_col: str, text: str, asked: list[str]) -> DataFrame:
    """The inverted index (segment, trigram, numbers): sorted out by input split, so a list is bounded by a split's documents.

    A document's number is a hash of its id. Documents of one number, should there be any, share their postings.
    """
    low = docs.select(F.spark_partition_id().alias("segment"), F.xxhash64(id_col).alias("number"), F.lower(text).alias("_low"))
    present = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in asked]))
    each = low.select("segment", "number", F.explode(present).alias("trigram"))
    return each.groupBy("segment", "trigram").agg(F.collect_set("number").alias("numbers"))


def answer(query: Query, lists: Column, sizes: dict[str, int]) -> Column:
    """Numbers that satisfy a query: the intersection, over its parts, of the unions of their alternatives' intersections."""

    def both(a: Column, b: Column) -> Column:
        return F.array_intersect(a, b)

    def posting(t: str) -> Column:
        return F.coalesce(F.try_element_at(lists, F.lit(t)), F.array().cast("array<bigint>"))

    parts = []
    for part in sorted(query, key=lambda p: part_size(p, sizes)):
        held = [reduce(both, map(posting, sorted(a, key=lambda t: (sizes.get(t, 0), t)))) for a in sorted(part, key=sorted)]
        parts.append(reduce(F.array_union, held))
    return reduce(both, parts)


def part_size(part: frozenset[frozenset[str]], sizes: dict[str, int]) -> int:
    """No more documents than this can satisfy a part."""
    return sum(min(sizes.get(t, 0) for t in alternative) for alternative in part)


def anchors(queries: dict[int, Query], sizes: dict[str, int]) -> list[str]:
    """Trigrams one of which every candidate holds: of each rule's rarest part the rarest of each alternative."""
    found = set()
    for query in queries.values():
        for alternative in min(query, key=lambda p: part_size(p, sizes)):
            t = min(sorted(alternative), key=lambda t: sizes.get(t, 0))
            found |= {t} if sizes.get(t, 0) else set()
    return sorted(found)


def candidates(docs: DataFrame, id_col: str, text: str, queries: dict[int, Query]) -> tuple[DataFrame, list[str]]:
    """(_number, _rules): the rules whose query each document satisfies, documents without any left out; and the anchors."""
    asked = sorted({t for q in queries.values() for part in q for alternative in part for t in alternative})
    index = keep(postings(docs, id_col, text, asked), "secret-postings")
    lengths = index.groupBy("trigram").agg(F.sum(F.size("numbers")).alias("n")).collect()  # a row an asked trigram at most
    sizes = {r["trigram"]: r["n"] for r in lengths}
    segments = index.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "numbers"))).alias("lists"))
    answers = [F.struct(F.lit(k).alias("rule"), answer(q, F.col("lists"), sizes).alias("numbers")) for k, q in queries.items()]
    each = segments.select(F.explode(F.array(*answers)).alias("a")).select("a.rule", F.explode("a.numbers").alias("_number"))
    return each.groupBy("_number").agg(F.collect_set("rule").alias("_rules")), anchors(queries, sizes)


def _spans(text: Column, rule: Rule, number: int, wanted: Column) -> Column:
    """Array of (start, kind number, end) of a rule's matches, in code points.

    The matches and the stretches between them alternate, so each start is the sum of the lengths before it.
    """
    pattern = F.lit(rule.pattern)
    nothing = F.array().cast("array<string>")
    on = wanted & F.rlike(text, pattern)
    found = F.when(on, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(nothing)
    counted = F.when(on, F.regexp_extract_all(text, pattern, F.lit(rule.group))).otherwise(nothing) if rule.group else found
    between = F.when(on, F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(found))).otherwise(nothing)
    triples = F.arrays_zip(between.alias("b"), found.alias("m"), counted.alias("c"))
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")

    def step(acc, x):
        start = acc["at"] + F.length(x["b"])
        end = start + F.length(x["m"])
        span = F.struct(start.alias("s"), F.lit(number).alias("k"), end.alias("e"))
        return F.struct(end.alias("at"), F.when(F.length(x["c"]) >= rule.least, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<s:int,k:int,e:int>>>").alias("out"))

    def runs_of(all_: Column) -> Column:
        def run(acc, k):
            part = F.aggregate(F.slice(all_, k * RUN + 1, F.lit(RUN)), F.struct(acc["at"].alias("at"), none.alias("out")), step)
            return F.struct(part["at"].alias("at"), F.array_append(acc["out"], part["out"]).alias("out"))

        count = F.ceil(F.size(all_) / RUN).cast("int")
        return F.aggregate(F.sequence(F.lit(0), count), empty, run, lambda acc: F.flatten(acc["out"]))

    return F.flatten(F.transform(F.array(triples), runs_of))  # an array of one, so that the matches are found once


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """Secrets of every document: (all columns of the documents, _found).

    ``_found`` is an array of (s, k, e): start and end in code points and the place of the rule in ``rules``, in order of
    start, then rule. A pattern's matches are leftmost and do not overlap; a match that is too short is dropped and not
    tried again. A null text is empty. Rows with equal ids share their postings, so they may be verified for more rules
    than needed, never for fewer; a null id is an id like others. Columns of the documents keep their names, whatever
    they are, except that names beginning with ``_`` are reserved. The documents are read three times: for the index,
    for the texts with an anchor and for those without.
    """
    rules = RULES if rules is None else rules
    named = docs.withColumn("_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    queries = {k: q for k, r in enumerate(rules) if (q := trigram_query(r.pattern))}

    def found(rows: DataFrame, wanted: dict[int, Column]) -> DataFrame:
        spans = [_spans(F.col("_text"), r, k, wanted.get(k, F.lit(True))) for k, r in enumerate(rules) if wanted or k not in queries]
        every = F.array_sort(F.flatten(F.array(*spans))) if spans else F.array().cast("array<struct<s:int,k:int,e:int>>")
        return rows.withColumn("_found", every).drop("_text", "_number", "_rules")

    if not queries:
        return found(named, {})
    hit, marks = candidates(named, id_col, "_text", queries)
    if not marks:
        return found(named, {})
    marked = F.rlike(F.lower("_text"), F.lit("|".join(re.escape(t) for t in marks)))
    met = named.where(marked).withColumn("_number", F.xxhash64(id_col)).join(hit, "_number", "left")
    wanted = {k: F.coalesce(F.array_contains("_rules", F.lit(k)), F.lit(False)) for k in queries}
    return found(met, wanted).unionAll(found(named.where(~marked), {}))


def span_text(found: Column, rules: list[Rule]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(kinds, x["k"] + 1), x["s"], x["e"])), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rules: list[Rule] | None = None, mark: str = "[secret]") -> DataFrame:
    """The documents with every found span replaced by a mark; other columns, and texts without a secret, as they are.

    Spans that overlap are replaced together.
    """
    found = scan_secrets(docs, id_col, text, rules)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    code_points = F.col(text)

    def step(acc, x):
        gap = F.substring(code_points, acc["at"] + 1, x["s"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], x["e"]).alias("at"),
            F.when(x["s"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], gap, F.lit(mark))).alias("out"),
        )

    clean = F.aggregate("_found", start, step, lambda acc: F.concat(acc["out"], F.substring(code_points, acc["at"] + 1, F.length(code_points))))
    return found.withColumn(text, F.when(F.size("_found") > 0, clean).otherwise(F.col(text))).select(*docs.columns)


def _sql(rules: list[Rule]) -> str:
    parts = []
    for k, r in enumerate(rules):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""SELECT doc_id, {k} AS k, '{r.kind}' AS kind, len(p[i]) AS own, s, s + length(m[i]) AS e FROM (
            SELECT doc_id, m, v, p, i, list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s FROM (
            SELECT doc_id, m, v, p, unnest(range(1, len(m) + 1)) AS i FROM (
            SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {r.group}) AS v, regexp_split_to_array(t, '{pattern}') AS p
            FROM d WHERE regexp_matches(t, '{pattern}')))) WHERE length(v[i]) >= {r.least}""")
    return (
        "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS (" + " UNION ALL ".join(parts) + """),
        a AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
            string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3) AS base, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
            FROM f GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
            sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (doc_id)"""
    )


@register("op7_secret_scans", _sql(RULES))
def op7_secret_scans(spark: SparkSession, directory: str) -> DataFrame:
    """Secrets in all documents."""
    found = scan_secrets(table(spark, directory, "documents").select("doc_id", "text"))
    base = F.filter("_found", lambda x: x["k"] < len(BASE_RULES))

    def count(k: int) -> Column:
        return F.size(F.filter("_found", lambda x: x["k"] == k)).cast("long").alias(f"n_{BASE_RULES[k].kind}")

    counts = [count(k) for k in range(len(BASE_RULES))]
    return found.select(
        "doc_id", *counts, F.sha2(span_text(base, RULES), 256).alias("base_sha256"), span_text(F.col("_found"), RULES).alias("spans")
    )
