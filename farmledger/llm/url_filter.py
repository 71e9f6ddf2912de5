"""URL filter: a blocked Bloom filter over listed canonical URLs, then an exact join.

A listed URL is a host and a path prefix. It fits its host and every subdomain when the path of a URL starts with the
prefix. Each URL is expanded into the canonical keys that could be listed for it: every suffix of its host that begins at
a label, times every listed prefix length. A blocked Bloom filter (one 512-bit block a key, eight bits set in it)
discards almost all keys; the remaining ones meet the list in an exact hash join, which removes false positives.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farmledger.llm.registry import register, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS_A_BLOCK = 8
MAX_FILTER_BLOCKS = 1 << 17  # 8 MB: the largest filter that is sent to the executors; a larger list gets less of a filter

# The rules that the query applies.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def host_and_path(url: str) -> tuple:
    """Columns (host, path) of a URL column; both empty without ``://`` or for null.

    The host runs from the first ``://`` to the next ``/``, ``?`` or ``#``, with A-Z lower-cased; the path from there to
    the next ``?`` or ``#``. A user name or a port stays part of the host.
    """
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _bits(key):
    """Eight bit positions in 0..511 of a key: nine bits each of two further hashes."""
    first, second = F.xxhash64(F.lit(1), key), F.xxhash64(F.lit(2), key)
    return F.array(*[F.shiftrightunsigned(h, 9 * k).bitwiseAND(F.lit(511)) for h in (first, second) for k in range(4)])


def _block(key, blocks: int):
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(blocks))


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> np.ndarray:
    """Blocked Bloom filter as an array of ``blocks`` x 8 words; its size is fixed before any key is read."""
    # the bits of a key that fall into the same word of its block are set by bit_or, one row for each word that is not zero
    bit = keys.select(_block(F.col(key), blocks).alias("block"), F.explode(_bits(F.col(key))).alias("bit"))
    words = (
        bit.select("block", F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 AS int))").alias("mask"))
        .groupBy("block", "word")
        .agg(F.bit_or("mask").alias("mask"))
    )
    out = np.zeros((blocks, WORDS_A_BLOCK), dtype=np.int64)
    for row in words.toLocalIterator():
        out[row.block, row.word] = row.mask
    return out


def may_contain(bloom: np.ndarray, key):
    """Boolean column: false only for keys that are surely not in the filter."""

    @F.pandas_udf(T.BooleanType())
    def probe(block: pd.Series, bits: pd.Series) -> pd.Series:
        if len(block) == 0:
            return pd.Series([], dtype=bool)
        at = np.stack(bits.to_numpy())
        word = bloom[block.to_numpy()[:, None], at >> 6]
        return pd.Series((((word >> (at & 63)) & 1) == 1).all(axis=1))

    return probe(_block(key, len(bloom)), _bits(key))


def filter_urls(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", max_blocks: int = MAX_FILTER_BLOCKS) -> DataFrame:
    """Judge every URL by the longest listed entry that fits it.

    ``listed`` has (verdict, host, path). Returns (id_col, host, path, rule, verdict), one row for each input row:
    ``rule`` is the entry as host and path written together, null where none fits, and then the verdict is ``default``.
    Ties in length go to the entry that sorts first. A repeated entry counts once; of two verdicts for one entry
    ``block`` holds. Null, empty and unparsable URLs have an empty host and path and get the default. Repeated ids and
    rows stay as they are. Other columns of ``pages`` are not read, so their names cannot clash.
    """
    spark = pages.sparkSession
    rules = (
        listed.select(F.concat(F.col("host"), F.col("path")).alias("rule"), F.col("host"), F.col("path").alias("prefix"), F.col("verdict"))
        .where("rule IS NOT NULL")
        .groupBy("rule", "host", "prefix")
        .agg(F.max("verdict").alias("verdict"))
    )
    lengths = [r[0] for r in rules.select(F.length("prefix").alias("n")).distinct().collect()] or [0]  # at most one for each prefix length
    count = rules.count()
    blocks = min(max_blocks, 1 << max(4, math.ceil(math.log2(max(count, 1) / 32 + 1))))
    bloom = bloom_filter(rules, "rule", blocks)

    host, path = host_and_path(url_col)
    urls = pages.select(F.col(id_col), F.col(url_col).alias("_url"), host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels)))
    )
    sized = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    keys = F.flatten(
        F.transform(suffixes, lambda s: F.transform(sized, lambda n: F.concat(s, F.col("path").substr(F.lit(1), n))))
    )
    # one key for each distinct (host, path): repeated URLs are looked up once
    distinct = urls.where("host <> ''").select("host", "path").distinct()
    candidates = distinct.select("host", "path", F.explode(keys).alias("key"))
    hits = candidates.where(may_contain(bloom, F.col("key"))).withColumnRenamed("host", "u_host").withColumnRenamed("path", "u_path")
    exact = hits.join(rules, F.col("key") == F.col("rule")).where(
        F.col("u_path").startswith(F.col("prefix"))
        & ((F.col("u_host") == F.col("host")) | F.col("u_host").endswith(F.concat(F.lit("."), F.col("host"))))
    )
    best = exact.groupBy("u_host", "u_path").agg(
        F.min(F.struct((-F.length("rule")).alias("n"), "rule", "verdict")).alias("best")
    )
    joined = urls.join(best, (urls.host == best.u_host) & (urls.path == best.u_path), "left")
    return joined.select(id_col, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def rule_list(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


@register(
    "op8_url_filters",
    r"""WITH u AS (
        SELECT page_id, coalesce(url, '') AS url, position('://' IN coalesce(url, '')) AS pos FROM pages
    ), s AS (
        SELECT page_id, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM u
    ), p AS (
        SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s
    ), r(verdict, host, path) AS (
        VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
    ), m AS (
        SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict AS verdict,
               row_number() OVER (PARTITION BY p.page_id, p.host, p.path ORDER BY length(r.host || r.path) DESC NULLS LAST, r.host || r.path) AS k
        FROM p LEFT JOIN r ON starts_with(p.path, r.path) AND (p.host = r.host OR ends_with(p.host, '.' || r.host))
    ) SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE k = 1""",
)
def op8_url_filters(spark: SparkSession, directory: str) -> DataFrame:
    """Every row of ``pages`` judged by the listed rules."""
    return filter_urls(table(spark, directory, "pages"), rule_list(spark))
